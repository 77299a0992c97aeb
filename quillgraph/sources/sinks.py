"""Writing tables. Spark's committer publishes a folder as a whole and marks it with _SUCCESS; a manifest says what made it."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def _hadoop(spark: SparkSession, path: str) -> tuple[Any, Any]:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def write_table(df: DataFrame, path: str, compression: str = "zstd", mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """With partition_by rows of a folder come together first, in pieces of AQE's advisory size: the writer sorts each task's rows by folder, so a task holds no more than such a piece,
    and there is a file for each, not one of every folder for each task of df."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).option("compression", compression).partitionBy(*partition_by).parquet(path)


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int, compression: str = "zstd") -> None:
    """A folder for each bucket of a key, with one file, or more where the bucket is larger than AQE's advisory size; for readers that want co-located files. Deduplication itself
    doesn't need it."""
    from quillgraph.functions.ids import bucket

    write_table(df.withColumn("bucket", bucket(keys, buckets)), path, compression, partition_by=("bucket",))


def write_failures(df: DataFrame, path: str) -> None:
    """JSON lines."""
    df.write.mode("overwrite").json(path)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; none if it isn't there."""
    fs, where = _hadoop(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(where) if x.isDirectory()) if fs.exists(where) else []


def complete(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, f"{path}/_SUCCESS")
    return fs.exists(where)


def require(spark: SparkSession, path: str) -> None:
    if not complete(spark, path):
        raise FileNotFoundError(f"no complete table at {path}")


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    fs, where = _hadoop(spark, f"{path}/_manifest.json")
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_manifest(spark: SparkSession, path: str, spec: dict) -> None:
    """The spec that a table was made by; a table with another spec has to be made again."""
    fs, where = _hadoop(spark, f"{path}/_manifest.json")
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(json.dumps(spec, sort_keys=True).encode()))
    finally:
        stream.close()


def up_to_date(spark: SparkSession, path: str, spec: dict) -> bool:
    return complete(spark, path) and read_manifest(spark, path) == spec


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)
