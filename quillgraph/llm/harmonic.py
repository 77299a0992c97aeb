"""Operator 4: harmonic packing.

With capacity C, a piece of n tokens falls into class k = floor(C / n), so that C/(k+1) < n <= C/k, and every bin of
class k holds exactly k pieces (the last bin of a class in a shard fewer). No bin can overflow, and no bin depends on
the content of another: a bin number is the piece's number within its class divided by k. Classes are numbered
independently in shards of about ``SHARD_ROWS`` documents, by the hash of their ids, so no window covers more than a shard, however large the table.

A document longer than C is cut without loss: full pieces of C tokens (class 1, a bin each) and a remainder.

Defined results: length is the number of words between white space; a NULL text has no row; an empty or blank text has
length 0 and class 0, bin -1 (nothing to pack); pieces of one class, ties and repeated rows too, each get their own place, in order of doc_id,
words, text hash and piece, so the result is the same on every run; a NULL doc_id is put in a shard by its text; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAPACITY = 2048
SHARD_ROWS = 65536


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, class, shard, bin, slot): a place for every piece of every document."""
    lengths = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.when(F.trim(F.translate(text_col, "\t\n\r\f", "    ")) == "", 0).otherwise(F.size(F.split(F.trim(F.translate(text_col, "\t\n\r\f", "    ")), " +"))).alias("n"),
        F.xxhash64(text_col).alias("tie"),
        F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("long").cast("string"), text_col)), 1, 8), 16, 10).cast("long").alias("spread"),
    ).where(F.col(text_col).isNotNull())
    return place(lengths, max(1, math.ceil(docs.count() / shard_rows)), capacity)


def place(lengths: DataFrame, shards: int, capacity: int) -> DataFrame:
    """pack() for a table (doc_id, n, tie, spread); spread is a number that documents are put in shards by."""
    piece = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n") / capacity).cast("int") - 1)))
    pieces = (
        lengths.select("doc_id", "n", "tie", "spread", piece.alias("piece"))
        .withColumn("start", F.col("piece") * capacity)
        .withColumn("length", F.least(F.lit(capacity), F.col("n") - F.col("start")))
        .withColumn("class", F.when(F.col("length") > 0, F.floor(F.lit(capacity) / F.col("length"))).otherwise(0).cast("int"))
        .withColumn("shard", (F.col("spread") % shards).cast("int"))
    )
    number = F.row_number().over(Window.partitionBy("shard", "class").orderBy("doc_id", "n", "tie", "piece")) - 1
    k = F.greatest(F.col("class"), F.lit(1))
    return pieces.withColumn("at", number).select(
        "doc_id",
        F.col("piece").cast("int"),
        F.col("start").cast("int"),
        F.col("length").cast("int"),
        "class",
        "shard",
        F.when(F.col("class") > 0, F.floor(F.col("at") / k)).otherwise(-1).cast("int").alias("bin"),
        F.when(F.col("class") > 0, F.col("at") % k).otherwise(0).cast("int").alias("slot"),
    )


SQL = f"""
WITH base AS (
  SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text)), 1, 8) AS BIGINT) AS spread, CASE WHEN trim(translate(text, chr(9) || chr(10) || chr(13) || chr(12), '    ')) = '' THEN 0
    ELSE len(regexp_split_to_array(trim(translate(text, chr(9) || chr(10) || chr(13) || chr(12), '    ')), ' +')) END AS n
  FROM {{docs}} WHERE text IS NOT NULL),
pieces AS (
  SELECT doc_id, n, spread, piece, piece * {CAPACITY} AS start, least({CAPACITY}, n - piece * {CAPACITY}) AS length
  FROM (SELECT doc_id, n, spread, unnest(range(0, greatest(1, CAST(ceil(n / {CAPACITY}.0) AS BIGINT)))) AS piece FROM base)),
classed AS (
  SELECT *, CASE WHEN length > 0 THEN {CAPACITY} // length ELSE 0 END AS class,
    spread % (SELECT greatest(1, CAST(ceil(count(*) / {SHARD_ROWS}.0) AS BIGINT)) FROM {{docs}}) AS shard FROM pieces),
numbered AS (SELECT *, row_number() OVER (PARTITION BY shard, class ORDER BY doc_id, n, piece) - 1 AS num FROM classed)
SELECT doc_id, CAST(piece AS INT) AS piece, CAST(start AS INT) AS start, CAST(length AS INT) AS length, CAST(class AS INT) AS class,
  CAST(shard AS INT) AS shard, CAST(CASE WHEN class > 0 THEN num // class ELSE -1 END AS INT) AS bin,
  CAST(CASE WHEN class > 0 THEN num % class ELSE 0 END AS INT) AS slot
FROM numbered
"""
