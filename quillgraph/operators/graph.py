"""The citation neighbourhood, one step around the works of the seed concepts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.config import valid_seeds

#: Reference table -> (its key, the table that must mention the key).
REFERENCES = {"authors": ("author_id", "authorships"), "concepts": ("concept_id", "scores"), "institutions": ("institution_id", "affiliations"), "sources": ("source_id", "works")}
RELATIONS = ("affiliations", "authorships", "scores", "selected_scores")


def seed_scores(scores: DataFrame, seeds: list[str]) -> DataFrame:
    """Scores of the seed concepts. The list reaches the Parquet scan as a pushed filter."""
    return scores.where(F.col("concept_id").isin(*valid_seeds(seeds)))


def filtered_edges(edges: DataFrame, seed_works: DataFrame) -> DataFrame:
    """Edges with a seed at either end, each once. Two semi-joins and a union: an OR of two memberships would keep Spark from a hash join on either."""
    ids = seed_works.select("work_id").distinct()
    by_citing = edges.join(ids, edges["citing_work_id"] == ids["work_id"], "left_semi")
    by_cited = edges.join(ids, edges["cited_work_id"] == ids["work_id"], "left_semi")
    return by_citing.unionByName(by_cited).distinct()


def work_ids(seed_works: DataFrame, edges: DataFrame) -> DataFrame:
    """Seeds and both ends of the filtered edges."""
    ends = seed_works.select("work_id").union(edges.select("citing_work_id")).union(edges.select("cited_work_id"))
    return ends.where(F.col("work_id").isNotNull()).distinct()


def by_work(table: DataFrame, ids: DataFrame) -> DataFrame:
    return table.join(ids, "work_id", "left_semi")


def by_reference(table: DataFrame, key: str, mentions: DataFrame) -> DataFrame:
    """Rows whose key is mentioned. The key column alone is shuffled from the other side; a semi-join needs no distinct."""
    return table.join(mentions.select(key), key, "left_semi")


def neighbourhood(
    tables: dict[str, DataFrame], seeds: list[str], keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df, of_works: dict[str, Callable[[DataFrame], DataFrame]] | None = None
) -> dict[str, DataFrame]:
    """All filtered tables, with seed_scores and work_ids. keep sees each table once it is defined, in order of use, and may return a stored copy for what builds on it.

    of_works: by name of a table that isn't stored, what makes the rows of given works (of edges, those with such a work at either end), from their distinct ids; so that its source
    is filtered before it is joined and deduplicated.
    """
    of_works = of_works or {}
    seeded = keep("seed_scores", seed_scores(tables["scores"], seeds))
    edges = keep("citation_edges", of_works["citation_edges"](seeded.select("work_id").distinct()) if "citation_edges" in of_works else filtered_edges(tables["citation_edges"], seeded))
    ids = keep("work_ids", work_ids(seeded, edges))
    out = {"seed_scores": seeded, "citation_edges": edges, "work_ids": ids}
    for name in ("works", *RELATIONS):
        if name in tables:
            out[name] = keep(name, of_works[name](ids) if name in of_works else by_work(tables[name], ids))
    for name, (key, base) in REFERENCES.items():
        if name in tables and base in out:
            out[name] = keep(name, by_reference(tables[name], key, out[base]))
    return out
