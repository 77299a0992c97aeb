"""A corpus pipeline of four stages: toxic documents go, duplicate lines go, one document of each near-copy group stays, the rest is packed.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet in the shared folder and read
again as the next one's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillgraph.llm import harmonic, line_dedup, ngram_join, toxicity
from quillgraph.llm.common import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among docs, doesn't reject."""
    return toxicity.filter_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occurred before; those that lose every line go."""
    return line_dedup.dedup_lines(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.dedup_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A bin and a slot for every piece of every document."""
    return harmonic.pack(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("ngram_jaccard", drop_copies), ("harmonic_packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier has no SQL; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None
