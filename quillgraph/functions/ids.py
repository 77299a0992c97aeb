"""Identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_id(url: Column | str) -> Column:
    """What stands behind the last slash; text without one as it is; NULL stays."""
    return F.substring_index(url, "/", -1)


def snapshot_date(file_name: Column | str) -> Column:
    """The first yyyy-MM-dd of a file name, NULL if there is none."""
    return F.nullif(F.regexp_extract(file_name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def file_name(path: Column | str) -> Column:
    return F.substring_index(path, "/", -1)


def shard_name(path: Column | str) -> Column:
    """Folders and file behind the last ``works`` (else ``authors``) folder joined by _, without .gz; NULL for other paths."""
    tail = F.coalesce(*(F.nullif(F.regexp_extract(path, rf"^(?:.*/)?{kind}/(.+)$", 1), F.lit("")) for kind in ("works", "authors")))
    return F.regexp_replace(F.translate(tail, "/", "_"), r"\.gz$", "")


def bucket(keys: list[str], buckets: int) -> Column:
    """A stable bucket number of a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
