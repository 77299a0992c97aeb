"""Reading snapshot shards: JSON lines, plain or gzip, and dated Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgraph.functions.ids import file_name, shard_name, snapshot_date, strip_id

#: Files with other endings are not shards.
LINES = "*.{gz,json,jsonl}"
_BAD = "_bad_record"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, shard, snapshot_date) of all lines that aren't blank, from all folders below the path."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", LINES).text(path if isinstance(path, list) else [path])
    return with_shard(lines)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of the shards below a path. Only folders are listed; no file is opened."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", LINES).load(path).select("path")


def with_shard(lines: DataFrame) -> DataFrame:
    where = F.col("_metadata.file_path")
    return lines.select("value", F.coalesce(shard_name(where), file_name(where)).alias("shard"), snapshot_date(where_date(where)).alias("snapshot_date")).where(F.trim("value") != "")


def where_date(path: F.Column) -> F.Column:
    """The file's name if it has a date, else the name of its folder (shards often lie in dated folders)."""
    name, folder = file_name(path), F.element_at(F.split(path, "/"), -2)
    return F.when(name.rlike(r"\d{4}-\d{2}-\d{2}"), name).otherwise(folder)


def parse(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """lines with ``record`` and ``state``: ok, malformed (no JSON: to be skipped) or failed (JSON of another shape).

    Whether a record that doesn't fit is JSON at all is only asked for such records. The record stands behind a generator of one row: else Spark would parse the line anew for
    every filter on a field of it.
    """
    wide = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    record = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    out = lines.select("*", F.explode(F.array(record)).alias("record"))
    whole = F.trim("value").startswith("{") & F.col(f"record.{_BAD}").isNull()
    state = F.when(whole, "ok").when(F.get_json_object("value", "$").isNull(), "malformed").otherwise("failed")
    return out.withColumn("state", state)


def staged(parsed: DataFrame) -> DataFrame:
    """What is stored of parsed lines so that they are parsed once for all tables: the text only of those that failed."""
    return parsed.select("shard", "snapshot_date", "state", "record", F.when(F.col("state") == "failed", F.col("value")).alias("value")).where("state <> 'malformed'")


def failures(parsed: DataFrame, stage: str = "parse") -> DataFrame:
    """Records that are JSON but don't fit, with their id where it can be read."""
    return parsed.where("state = 'failed'").select(
        "shard",
        F.lit(stage).alias("stage"),
        strip_id(F.get_json_object("value", "$.id")).alias("record_id"),
        F.when(F.trim("value").startswith("{"), "TypeMismatch").otherwise("NotAnObject").alias("error_type"),
        F.concat(F.lit("record doesn't fit the schema: "), F.substring("value", 1, 200)).alias("error"),
    )


def publication_year(text: F.Column | str) -> F.Column:
    """2010, "2010" and 2010.7 are 2010; anything else NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return text.try_cast("double").try_cast("int")


def works_in_range(parsed: DataFrame, first: int, last: int) -> DataFrame:
    """Good records of the years asked for: shard, snapshot_date, the record's fields, ``year``."""
    year = publication_year("publication_year")
    return parsed.where("state = 'ok'").select("shard", "snapshot_date", "record.*").drop(_BAD).withColumn("year", year).where(F.col("year").between(first, last))


def authors(parsed: DataFrame) -> DataFrame:
    return parsed.where("state = 'ok'").select("shard", "snapshot_date", "record.*").drop(_BAD)


def read_dated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet files with a date in their name, with snapshot_date; other files are left out. The filter on the file's name prunes files, not rows."""
    files = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]*.parquet").parquet(path)
    return files.select(*schema.names, snapshot_date(F.col("_metadata.file_name")).alias("snapshot_date"))


def read_table(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """A table's folder or folders; with a schema an empty folder is an empty table, and partition folders below are found."""
    paths = [path] if isinstance(path, str) else path
    if schema is None:
        return spark.read.parquet(*paths)
    return spark.read.schema(schema).parquet(*paths).select(*schema.names)
