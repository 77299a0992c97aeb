"""From one nested record to the rows of the flat tables. All but text cleaning is built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.config import SelectedConcepts
from quillgraph.functions.ids import strip_id
from quillgraph.functions.text import clean_text, invert_abstract



def _work() -> Column:
    return strip_id("id").alias("work_id")


def works(records: DataFrame, with_index: bool = False) -> DataFrame:
    # a Python function can't be planned over a lambda expression, so a generator of one row stands between them
    base = records.select("*", F.explode(F.array(invert_abstract("abstract_inverted_index"))).alias("__raw"))
    base = base.withColumns({"__title": clean_text("title"), "__abstract": clean_text("__raw")})
    place, access = "primary_location", "open_access"
    out = base.select(
        _work(),
        F.col("year").alias("publication_year"),
        "publication_date",
        F.col("__title").alias("title"),
        F.col("__abstract").alias("abstract_text"),
        F.coalesce(F.length("__title"), F.lit(0)).alias("title_length"),
        F.length("__abstract").alias("abstract_length"),
        "cited_by_count",
        "referenced_works_count",
        "fwci",
        strip_id(f"{place}.source.id").alias("source_id"),
        F.col("type").alias("work_type"),
        "is_retracted",
        "is_paratext",
        "language",
        "doi",
        F.coalesce(F.to_json("ids"), F.lit("{}")).alias("ids"),
        F.col(f"{access}.is_oa").alias("is_open_access"),
        F.col(f"{access}.oa_url").alias("open_access_url"),
        F.col(f"{place}.landing_page_url"),
        F.col(f"{place}.pdf_url"),
        "created_date",
        "updated_date",
        "snapshot_date",
        *([F.to_json("abstract_inverted_index").alias("abstract_inverted_index")] if with_index else []),
    )
    return out


def citation_edges(records: DataFrame) -> DataFrame:
    return records.select(_work().alias("citing_work_id"), F.explode("referenced_works").alias("r"), "snapshot_date").select(strip_id("r").alias("cited_work_id"), "citing_work_id", "snapshot_date")


def authorships(records: DataFrame) -> DataFrame:
    return records.select(_work(), F.posexplode("authorships").alias("author_sequence", "a"), "snapshot_date").select(
        "work_id", strip_id("a.author.id").alias("author_id"), "a.author_position", "author_sequence", "a.is_corresponding", "snapshot_date"
    )


def _institution_rows(records: DataFrame) -> DataFrame:
    rows = records.select(_work(), F.explode("authorships").alias("a"), "snapshot_date")
    return rows.select("work_id", strip_id("a.author.id").alias("author_id"), F.explode("a.institutions").alias("i"), "snapshot_date")


def affiliations(records: DataFrame) -> DataFrame:
    return _institution_rows(records).select("work_id", "author_id", strip_id("i.id").alias("institution_id"), "snapshot_date")


def institutions(records: DataFrame) -> DataFrame:
    return _institution_rows(records).select(strip_id("i.id").alias("institution_id"), clean_text("i.display_name").alias("institution_name"), F.col("i.country_code").alias("country"), "snapshot_date")


def sources(records: DataFrame) -> DataFrame:
    s = records.select(F.col("primary_location.source").alias("s"), "snapshot_date")
    given = F.coalesce(*(F.col(f"s.{c}").cast("string") for c in ("id", "display_name", "type", "issn_l", "host_organization", "is_oa")), F.to_json("s.issn"))
    return s.where(given.isNotNull()).select(
        strip_id("s.id").alias("source_id"),
        clean_text("s.display_name").alias("source_name"),
        F.col("s.type").alias("source_type"),
        F.col("s.issn_l").alias("linking_issn"),
        F.coalesce(F.to_json("s.issn"), F.lit("[]")).alias("issn_list"),
        strip_id("s.host_organization").alias("host_organization_id"),
        "s.is_oa",
        "snapshot_date",
    )


def _scored(records: DataFrame, threshold: float) -> DataFrame:
    """A score that is missing counts as 0 for the threshold and stays NULL in the row."""
    return records.select(_work(), F.explode("concepts").alias("c"), "snapshot_date").where(F.coalesce("c.score", F.lit(0.0)) >= threshold)


def concepts(records: DataFrame, threshold: float) -> DataFrame:
    return _scored(records, threshold).select(strip_id("c.id").alias("concept_id"), clean_text("c.display_name").alias("concept_name"), F.col("c.level").alias("concept_level"), "snapshot_date")


def scores(records: DataFrame, threshold: float) -> DataFrame:
    return _scored(records, threshold).select("work_id", strip_id("c.id").alias("concept_id"), F.col("c.score").alias("concept_score"), "snapshot_date")


def selected_scores(records: DataFrame, chosen: SelectedConcepts) -> DataFrame:
    """All concepts: a row for each id, the last one of repeated ids. Listed concepts: a row for each of them and work, 0 where the work lacks it. No threshold."""
    listed = F.coalesce("concepts", F.array().cast(records.schema["concepts"].dataType))
    named = F.transform(listed, lambda c: F.struct(strip_id(c["id"]).alias("id"), c["score"].alias("score")))
    base = records.select(_work(), named.alias("c"), "snapshot_date")
    if chosen.get_all_concepts:
        # sorted by id and place, the last of an id stands before another id or the end: n log n, and no row carries the list
        placed = F.array_sort(F.transform("c", lambda x, at: F.struct(x["id"].alias("id"), at.alias("at"), x["score"].alias("score"))))
        rows = base.select("work_id", F.explode(F.array(placed)).alias("c"), "snapshot_date")
        after = F.concat(F.slice("c", F.lit(2), F.size("c")), F.array(F.lit(None).cast(rows.schema["c"].dataType.elementType)))
        last = F.zip_with("c", after, lambda e, n: F.when(n.isNull() | ~n["id"].eqNullSafe(e["id"]), e))
        rows = rows.select("work_id", F.explode(F.filter(last, lambda e: e.isNotNull())).alias("one"), "snapshot_date")
        return rows.select("work_id", F.col("one.id").alias("concept_id"), F.col("one.score").alias("concept_score"), "snapshot_date")
    wanted = F.array(*(F.lit(x) for x in chosen.concept_ids)) if chosen.concept_ids else F.array().cast("array<string>")
    rows = base.select("work_id", F.explode(wanted).alias("concept_id"), "c", "snapshot_date").withColumn("hits", F.expr("filter(c, x -> x.id = concept_id)"))
    score = F.when(F.size("hits") == 0, F.lit(0.0)).otherwise(F.expr("try_element_at(hits, -1).score"))
    return rows.select("work_id", "concept_id", score.alias("concept_score"), "snapshot_date")


def author_rows(records: DataFrame) -> DataFrame:
    """Publication years aren't in the records; the metrics have them."""
    year = F.lit(None).cast("int")
    return records.select(
        strip_id("id").alias("author_id"),
        clean_text("display_name").alias("author_name"),
        year.alias("first_publication_year"),
        year.alias("last_publication_year"),
        "works_count",
        "cited_by_count",
        F.col("summary_stats.h_index").alias("h_index"),
        "snapshot_date",
    )


def all_tables(records: DataFrame, threshold: float, chosen: SelectedConcepts, with_index: bool = False) -> dict[str, DataFrame]:
    """Every table of the works' records."""
    out = {
        "works": works(records, with_index),
        "citation_edges": citation_edges(records),
        "authorships": authorships(records),
        "affiliations": affiliations(records),
        "institutions": institutions(records),
        "sources": sources(records),
        "concepts": concepts(records, threshold),
        "scores": scores(records, threshold),
    }
    return out | ({"selected_scores": selected_scores(records, chosen)} if chosen.enabled else {})
