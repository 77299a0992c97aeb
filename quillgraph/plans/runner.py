"""The five stages, each from stored tables to stored tables; every stage's result is a complete folder before the next one reads it."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quillgraph.config import Settings
from quillgraph.operators import dedup, generators, graph, metrics
from quillgraph.schemas import TABLES, raw_author, raw_work, stored
from quillgraph.sources import shards, sinks

log = logging.getLogger(__name__)
INDEX = "abstract_inverted_index string"
Build = Callable[[DataFrame], dict[str, DataFrame]]


def _schema(table: str, settings: Settings):
    return stored(table, INDEX) if table == "works" and settings.include_abstract_inverted else stored(table)


def read_stored(spark: SparkSession, settings: Settings, kind: str, table: str) -> DataFrame:
    path = f"{settings.root(kind)}/{table}"
    sinks.require(spark, path)
    return shards.read_table(spark, path, _schema(table, settings))


def committed(spark: SparkSession, settings: Settings, kind: str) -> list[str]:
    """Folders of the batches of shards that are in as a whole."""
    done = f"{settings.root('shards')}/_done_{kind}"
    return [x for x in sinks.folders(spark, done) if sinks.complete(spark, f"{done}/{x}")]


def write_batch(spark: SparkSession, settings: Settings, kind: str, name: str, lines: DataFrame, paths: list[str], build: Build, schema: StructType) -> None:
    """Parses a batch once, into a table that all others are made from, each in its own folder of the batch; at last the list of its files, which commits it. A batch that is
    tried again overwrites what it left."""
    root = settings.root("shards")
    stage = f"{root}/_parsed_{kind}/{name}"
    sinks.write_table(shards.staged(shards.parse(lines, schema)), stage, settings.parquet_compression)
    parsed = spark.read.parquet(stage)
    tables = build(parsed)
    for table, df in tables.items():
        sinks.write_table(df.select(*_schema(table, settings).names), f"{root}/{table}/{name}", settings.parquet_compression)
    sinks.write_failures(shards.failures(parsed), f"{root}/_failures_{kind}/{name}")
    sinks.remove(spark, stage)
    done = f"{root}/_done_{kind}/{name}"
    sinks.write_table(spark.createDataFrame([(x,) for x in paths], "path string").coalesce(1), done, settings.parquet_compression)
    sinks.write_manifest(spark, done, {"tables": sorted(tables)})


def _ingest(spark: SparkSession, settings: Settings, kind: str, path: str, build: Build, schema: StructType, tables: set[str]) -> None:
    """The shards that no committed batch has read are a new batch; the others aren't opened. What an interrupted run left, and batches made for other tables, go first."""
    root = settings.root("shards")
    done = f"{root}/_done_{kind}"
    good = []
    for name in committed(spark, settings, kind):
        if sinks.read_manifest(spark, f"{done}/{name}") == {"tables": sorted(tables)}:
            good.append(name)
        else:
            log.warning("batch %s was made for other tables and is made again", name)
            sinks.remove(spark, f"{done}/{name}")
    for table in sinks.folders(spark, root):
        of_kind = table in tables or table in (f"_parsed_{kind}", f"_failures_{kind}", f"_done_{kind}")
        for name in sinks.folders(spark, f"{root}/{table}") if of_kind else ():
            if name not in good and name.removeprefix("batch=").isdigit():
                sinks.remove(spark, f"{root}/{table}/{name}")
    files = shards.list_files(spark, path)
    if good:
        files = files.join(spark.read.schema("path string").parquet(*(f"{done}/{x}" for x in good)), "path", "left_anti")
    fresh = sorted(r.path for r in files.collect())  # names only, which the driver lists to read them anyway
    log.info("%s: %d new shards", kind, len(fresh))
    if fresh:
        number = max((int(x.removeprefix("batch=")) for x in good if x.removeprefix("batch=").isdigit()), default=-1) + 1
        write_batch(spark, settings, kind, f"batch={number:06d}", shards.read_lines(spark, fresh), fresh, build, schema)


def tables_of_works(parsed: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    records = shards.works_in_range(parsed, settings.min_publication_year, settings.max_publication_year)
    return generators.all_tables(records, settings.concept_score_threshold, settings.selected_concepts, settings.include_abstract_inverted)


def works_tables(settings: Settings) -> set[str]:
    return set(TABLES) - {"authors"} - (set() if settings.selected_concepts.enabled else {"selected_scores"})


def works(spark: SparkSession, settings: Settings) -> None:
    _ingest(spark, settings, "works", settings.works_input, lambda p: tables_of_works(p, settings), raw_work(), works_tables(settings))


def authors(spark: SparkSession, settings: Settings) -> None:
    _ingest(spark, settings, "authors", settings.authors_input, lambda p: {"authors": generators.author_rows(shards.authors(p))}, raw_author(), {"authors"})


def deduplication(spark: SparkSession, settings: Settings) -> None:
    """Every table that has shards, unless it was made by the same spec from the same batches. The result is read again and checked for NULL and repeated keys."""
    for table in TABLES:
        target = f"{settings.root('tables')}/{table}"
        batches = [x for x in committed(spark, settings, "authors" if table == "authors" else "works") if sinks.complete(spark, f"{settings.root('shards')}/{table}/{x}")]
        made_by = dedup.SPECS[table].manifest() | {"batches": batches, "columns": _schema(table, settings).names}
        if not batches:
            log.info("no shards of %s", table)
        elif sinks.up_to_date(spark, target, made_by):
            log.info("%s is up to date", table)
        else:
            source = shards.read_table(spark, [f"{settings.root('shards')}/{table}/{x}" for x in batches], _schema(table, settings))
            sinks.write_table(dedup.dedup(source, table), target, settings.parquet_compression)
            dedup.assert_valid(read_stored(spark, settings, "tables", table), table)
            sinks.write_manifest(spark, target, made_by)


def graph_filtering(spark: SparkSession, settings: Settings) -> None:
    """Edges first, then node ids, then the tables: each is read again as written, so nothing is computed twice."""
    seeds = settings.seeds()
    root = settings.root("filtered_tables")

    def stage(name: str, df: DataFrame) -> DataFrame:
        sinks.write_table(df, f"{root}/{name}", settings.parquet_compression)
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    names = ("scores", "citation_edges", "works", *graph.RELATIONS, *graph.REFERENCES)
    tables = {name: read_stored(spark, settings, "tables", name) for name in names if sinks.complete(spark, f"{settings.root('tables')}/{name}")}
    graph.neighbourhood(tables, seeds, stage)


def metrics_stage(spark: SparkSession, settings: Settings) -> None:
    seeds, root = settings.seeds(), settings.root("metrics")
    t = {name: read_stored(spark, settings, "filtered_tables", name) for name in ("citation_edges", "works", "authorships", "affiliations", "scores")}
    per_work = metrics.works_metrics(t, seeds, read_stored(spark, settings, "tables", "concepts"))
    sinks.write_table(per_work, f"{root}/works_metrics", settings.parquet_compression)
    per_work = spark.read.schema(per_work.schema).parquet(f"{root}/works_metrics")
    for name, build in (("authors", metrics.authors_metrics), ("sources", metrics.sources_metrics), ("institutions", metrics.institutions_metrics), ("concepts", metrics.concepts_metrics)):
        if sinks.complete(spark, f"{settings.root('filtered_tables')}/{name}"):
            t[name] = read_stored(spark, settings, "filtered_tables", name)
            sinks.write_table(build(t, per_work), f"{root}/{name}_metrics", settings.parquet_compression)


RUN: dict[str, Callable[[SparkSession, Settings], None]] = {"works": works, "authors": authors, "deduplication": deduplication, "graph_filtering": graph_filtering, "metrics": metrics_stage}


def run(spark: SparkSession, settings: Settings, stages: list[str] | None = None) -> None:
    for name in stages or settings.enabled_pipelines:
        log.info("stage %s", name)
        RUN[name](spark, settings)
