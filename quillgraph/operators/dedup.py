"""One row a key across snapshots, and the checks of the result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Rank = Callable[[], Column]


def _down(name: str) -> Rank:
    return lambda: F.desc_nulls_last(name)


def _named(name: str) -> list[Rank]:
    """A given name before none, then the longest."""
    return [_down("snapshot_date"), lambda: F.col(name).isNull().asc(), lambda: F.desc_nulls_last(F.length(name))]


def _position() -> Column:
    return F.when(F.col("author_position") == "first", 1).when(F.col("author_position") == "last", 2).when(F.col("author_position") == "middle", 3).otherwise(4).asc()


@dataclass(frozen=True)
class Spec:
    """How a table is deduplicated. Without rank the whole row is the key and the latest date is kept. files: buckets of the stored layout, for readers that want one."""

    key: tuple[str, ...]
    rank: list[Rank] = field(default_factory=list)
    rank_name: str = "max(snapshot_date)"
    files: int = 8

    def manifest(self) -> dict:
        return {"key": list(self.key), "rank": self.rank_name, "files": self.files}


SPECS: dict[str, Spec] = {
    "works": Spec(("work_id",), [_down("snapshot_date"), _down("cited_by_count")], "latest, most cited", 256),
    "citation_edges": Spec(("citing_work_id", "cited_work_id"), files=64),
    "authorships": Spec(("work_id", "author_id"), [_down("snapshot_date"), _down("is_corresponding"), _position], "latest, corresponding, position"),
    "affiliations": Spec(("work_id", "author_id", "institution_id")),
    "institutions": Spec(("institution_id",), _named("institution_name"), "latest, longest name"),
    "sources": Spec(("source_id",), _named("source_name"), "latest, longest name"),
    "concepts": Spec(("concept_id",), _named("concept_name"), "latest, longest name", 16),
    "scores": Spec(("work_id", "concept_id"), [_down("snapshot_date"), _down("concept_score")], "latest, highest", 64),
    "selected_scores": Spec(("work_id", "concept_id"), [_down("snapshot_date"), _down("concept_score")], "latest, highest", 32),
    "authors": Spec(("author_id",), _named("author_name"), "latest, longest name"),
}


def dedup_by_key(df: DataFrame, key: tuple[str, ...], rank: list[Rank]) -> DataFrame:
    """The first row of each key by rank; further ties by all other columns, so the result is the same on every run. Rows with a NULL in the key go.

    The plan limits each key to one row on the map side already (WindowGroupLimit), so copies from many snapshots don't cross the shuffle.
    """
    rest = [F.asc_nulls_last(c) for c in df.columns if c not in key]
    window = Window.partitionBy(*key).orderBy(*(r() for r in rank), *rest)
    return df.dropna(subset=list(key)).withColumn("__n", F.row_number().over(window)).where("__n = 1").drop("__n")


def dedup_rows(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """The distinct keys with their latest date; partial aggregation on the map side."""
    return df.dropna(subset=list(key)).groupBy(*key).agg(F.max("snapshot_date").alias("snapshot_date"))


def dedup(df: DataFrame, table: str) -> DataFrame:
    spec = SPECS[table]
    return dedup_by_key(df, spec.key, spec.rank) if spec.rank else dedup_rows(df, spec.key)


def duplicate_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """(key, rows) of keys that occur more than once."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def null_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows with a NULL in the key."""
    return df.where(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in key)))


def check(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """One row: rows, rows with a NULL in the key, keys that occur more than once. One pass, one shuffle on the key."""
    bad = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in key))
    by = df.groupBy(*key).agg(F.count("*").alias("__n"))
    return by.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(bad, F.col("__n"))), F.lit(0)).alias("null_keys"), F.count_if((F.col("__n") > 1) & ~bad).alias("duplicate_keys"))


def assert_valid(df: DataFrame, table: str) -> None:
    """Raises ValueError for an empty table, NULL keys, or repeated keys."""
    found = check(df, SPECS[table].key).head()
    if not found["rows"] or found["null_keys"] or found["duplicate_keys"]:
        raise ValueError(f"{table}: {found.asDict()}")
