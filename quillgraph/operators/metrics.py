"""Metrics by work, author, source, institution and concept over the filtered tables.

Aggregates are built before joins, so a join's sides are one row a key and share the shuffle of their aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _zero(name: str, zero: float | int = 0) -> Column:
    return F.coalesce(name, F.lit(zero)).alias(name)


def degrees(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(work_id, local_in_citations) and (work_id, local_out_citations)."""
    cited = edges.groupBy(F.col("cited_work_id").alias("work_id")).agg(F.count("*").alias("local_in_citations"))
    citing = edges.groupBy(F.col("citing_work_id").alias("work_id")).agg(F.count("*").alias("local_out_citations"))
    return cited, citing


def seed_concept_metrics(scores: DataFrame, seeds: list[str]) -> DataFrame:
    own = scores.where(F.col("concept_id").isin(*seeds))
    return own.groupBy("work_id").agg(F.max("concept_score").alias("seed_concept_max_score"), F.sum("concept_score").alias("seed_concept_sum_score"), F.countDistinct("concept_id").alias("seed_concept_count"))


def entity_counts(authorships: DataFrame, affiliations: DataFrame, scores: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct authors, institutions and concepts of each work; NULL ids don't count."""
    return tuple(df.groupBy("work_id").agg(F.countDistinct(key).alias(name)) for df, key, name in ((authorships, "author_id", "authors_count"), (affiliations, "institution_id", "institutions_count"), (scores, "concept_id", "concepts_count")))


def top_concept(scores: DataFrame, concepts: DataFrame) -> DataFrame:
    """The best scored concept of each work with its name; ties by concept_id, then name.

    The best row is chosen before names are looked up, so only one row a work meets the concepts (ids are unique there).
    """
    window = Window.partitionBy("work_id").orderBy(F.desc_nulls_last("concept_score"), F.asc_nulls_last("concept_id"))
    best = scores.select("work_id", "concept_id", "concept_score").withColumn("n", F.row_number().over(window)).where("n = 1")
    return best.join(concepts.select("concept_id", "concept_name"), "concept_id", "left").select(
        "work_id", F.col("concept_name").alias("top_concept_name"), F.col("concept_id").alias("top_concept_id"), F.col("concept_score").alias("top_concept_score")
    )


def works_metrics(t: dict[str, DataFrame], seeds: list[str], concepts: DataFrame) -> DataFrame:
    """t: filtered tables; concepts: the unfiltered ones, for names. One row a filtered work."""
    cited, citing = degrees(t["citation_edges"])
    out = t["works"].select("work_id")
    for part in (cited, citing, seed_concept_metrics(t["scores"], seeds), *entity_counts(t["authorships"], t["affiliations"], t["scores"]), top_concept(t["scores"], concepts)):
        out = out.join(part, "work_id", "left")
    return out.select(
        "work_id",
        _zero("local_in_citations"),
        _zero("local_out_citations"),
        _zero("seed_concept_max_score", 0.0),
        _zero("seed_concept_sum_score", 0.0),
        _zero("seed_concept_count"),
        _zero("authors_count"),
        _zero("institutions_count"),
        _zero("concepts_count"),
        "top_concept_name",
        "top_concept_id",
        _zero("top_concept_score", 0.0),
    )


def citation_rollup(facts: DataFrame, key: str, per_work: DataFrame) -> DataFrame:
    """Of each key: sum, mean and maximum of its works' local citations. A work without metrics counts as 0 in the mean only."""
    joined = facts.where(F.col(key).isNotNull()).join(per_work.select("work_id", "local_in_citations"), "work_id", "left")
    value = F.col("local_in_citations")
    return joined.groupBy(key).agg(F.sum(value).alias("local_citation_count"), F.avg(F.coalesce(value, F.lit(0))).alias("mean_local_in_citations"), F.max(value).alias("max_local_in_citations"))


def years(facts: DataFrame, key: str, works: DataFrame) -> DataFrame:
    """First and last year of each key's works; NULL where no year is known."""
    dated = works.where(F.col("publication_year").isNotNull()).select("work_id", "publication_year")
    joined = facts.where(F.col(key).isNotNull()).select(key, "work_id").join(dated, "work_id")
    return joined.groupBy(key).agg(F.min("publication_year").alias("first_publication_year"), F.max("publication_year").alias("last_publication_year"))


_ROLLUP = (("local_citation_count", 0), ("mean_local_in_citations", 0.0), ("max_local_in_citations", 0))


def _assembled(entities: DataFrame, key: str, parts: list[DataFrame], zeros: list[str], plain: list[str]) -> DataFrame:
    """Entities with their parts: counts are 0 where nothing is known, years stay NULL."""
    out = entities.select(key)
    for part in parts:
        out = out.join(part, key, "left")
    return out.select(key, *(_zero(c) for c in zeros), *plain, *(_zero(c, z) for c, z in _ROLLUP))


def author_facts(authorships: DataFrame) -> DataFrame:
    own = authorships.where(F.col("author_id").isNotNull())
    position = F.col("author_position")
    return own.groupBy("author_id").agg(
        F.countDistinct("work_id").alias("local_works_count"),
        F.count_if(position == "first").alias("first_author_count"),
        F.count_if(position == "last").alias("last_author_count"),
        F.count_if("is_corresponding").alias("corresponding_author_count"),
    )


def authors_metrics(t: dict[str, DataFrame], per_work: DataFrame) -> DataFrame:
    facts = t["authorships"]
    span = years(facts, "author_id", t["works"]).withColumn("years_active", F.col("last_publication_year") - F.col("first_publication_year") + 1)
    return _assembled(
        t["authors"],
        "author_id",
        [author_facts(facts), span, citation_rollup(facts, "author_id", per_work)],
        ["local_works_count", "first_author_count", "last_author_count", "corresponding_author_count"],
        ["first_publication_year", "last_publication_year", "years_active"],
    )


def source_facts(works: DataFrame) -> DataFrame:
    return works.where(F.col("source_id").isNotNull()).groupBy("source_id").agg(
        F.countDistinct("work_id").alias("local_works_count"),
        F.min("publication_year").alias("first_publication_year"),
        F.max("publication_year").alias("last_publication_year"),
        F.countDistinct(F.when(F.col("is_open_access"), F.col("work_id"))).alias("open_access_works_count"),
        F.countDistinct(F.when(F.col("is_retracted"), F.col("work_id"))).alias("retracted_works_count"),
    )


def sources_metrics(t: dict[str, DataFrame], per_work: DataFrame) -> DataFrame:
    out = _assembled(
        t["sources"],
        "source_id",
        [source_facts(t["works"]), citation_rollup(t["works"].select("source_id", "work_id"), "source_id", per_work)],
        ["local_works_count", "open_access_works_count", "retracted_works_count"],
        ["first_publication_year", "last_publication_year"],
    )
    return out.select("source_id", "local_works_count", "first_publication_year", "last_publication_year", "open_access_works_count", "retracted_works_count", *(c for c, _ in _ROLLUP))


def institution_facts(affiliations: DataFrame) -> DataFrame:
    own = affiliations.where(F.col("institution_id").isNotNull())
    return own.groupBy("institution_id").agg(F.countDistinct("work_id").alias("local_works_count"), F.countDistinct("author_id").alias("local_authors_count"))


def institutions_metrics(t: dict[str, DataFrame], per_work: DataFrame) -> DataFrame:
    """A work counts once for an institution, however many of its authors belong there."""
    pairs = t["affiliations"].select("institution_id", "work_id").distinct()
    return _assembled(
        t["institutions"],
        "institution_id",
        [institution_facts(t["affiliations"]), years(pairs, "institution_id", t["works"]), citation_rollup(pairs, "institution_id", per_work)],
        ["local_works_count", "local_authors_count"],
        ["first_publication_year", "last_publication_year"],
    )


def concept_facts(scores: DataFrame) -> DataFrame:
    own = scores.where(F.col("concept_id").isNotNull())
    return own.groupBy("concept_id").agg(F.countDistinct("work_id").alias("local_works_count"), F.avg("concept_score").alias("mean_concept_score"), F.max("concept_score").alias("max_concept_score"))


def concepts_metrics(t: dict[str, DataFrame], per_work: DataFrame) -> DataFrame:
    facts = t["scores"]
    out = _assembled(
        t["concepts"],
        "concept_id",
        [concept_facts(facts), years(facts, "concept_id", t["works"]), citation_rollup(facts, "concept_id", per_work)],
        ["local_works_count"],
        [F.coalesce("mean_concept_score", F.lit(0.0)).alias("mean_concept_score"), F.coalesce("max_concept_score", F.lit(0.0)).alias("max_concept_score"), "first_publication_year", "last_publication_year"],
    )
    return out


def all_metrics(t: dict[str, DataFrame], seeds: list[str], concepts: DataFrame, per_work: DataFrame | None = None) -> dict[str, DataFrame]:
    """All five; per_work: works_metrics if it has been written already, so it isn't made five times."""
    per_work = per_work if per_work is not None else works_metrics(t, seeds, concepts)
    return {"works": per_work, "authors": authors_metrics(t, per_work), "sources": sources_metrics(t, per_work), "institutions": institutions_metrics(t, per_work), "concepts": concepts_metrics(t, per_work)}
