"""Ingestion of shards as they arrive: a file stream whose checkpoint remembers what was read, and one write of every table for each batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillgraph.config import Settings
from quillgraph.plans.runner import tables_of_works, write_batch
from quillgraph.schemas import raw_work
from quillgraph.sources import shards


def works_stream(spark: SparkSession, settings: Settings, files_per_batch: int = 1000) -> DataFrame:
    lines = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", shards.LINES).option("maxFilesPerTrigger", files_per_batch).format("text").load(settings.works_input)
    return shards.with_shard(lines)


def start(spark: SparkSession, settings: Settings, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Every batch overwrites its own folder (batch=sN) of each table, so a batch that is tried again leaves no second copy; deduplication reads it once it is committed."""

    def write(batch: DataFrame, number: int) -> None:
        write_batch(spark, settings, "works", f"batch=s{number:06d}", batch, [], lambda p: tables_of_works(p, settings), raw_work())

    writer = works_stream(spark, settings).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
