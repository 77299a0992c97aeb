"""python -m quillgraph --config settings.yaml [--pipelines works authors ...]"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from quillgraph.config import STAGES, load
from quillgraph.plans.runner import run


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quillgraph")
    parser.add_argument("--config", required=True)
    parser.add_argument("--pipelines", nargs="+", choices=STAGES)
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    settings = load(args.config)
    options = settings.object_store_options() | {"spark.sql.session.timeZone": "UTC"}
    spark = SparkSession.builder.appName("quillgraph").config(map=options).getOrCreate()
    run(spark, settings, args.pipelines)


if __name__ == "__main__":
    main()
