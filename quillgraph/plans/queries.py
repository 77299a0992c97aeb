"""Registered queries of the bibliographic operators, each over whole tables, and the SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.functions.ids import strip_id
from quillgraph.functions.text import clean_text, invert_abstract
from quillgraph.operators import dedup, generators, graph, metrics
from quillgraph.plans import ingestqueries
from quillgraph.plans.testmodel import SEEDS, Model, sql
from quillgraph.scratch import written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _add(name: str, query: Query, text: str | None = None) -> None:
    QUERIES[f"q_{name}"] = query
    if text:
        SQL[f"q_{name}"] = text


def _model(f: Callable[[Model], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(Model(spark, sf_dir))


#: What several tables build on; stored, so that it is made once, for all queries of a session.
_BASES = {"seed_scores", "citation_edges", "work_ids"}
_FACTS = _BASES | {"works", "authorships", "affiliations", "scores"}
_stored: dict[tuple[str, str, str], DataFrame] = {}


def _once(m: Model, name: str, df: DataFrame) -> DataFrame:
    key = m.spark.sparkContext.applicationId, m.sf_dir, name
    if key not in _stored:
        _stored[key] = written(df, name)
    return _stored[key]


def _filtered(m: Model, stored: set[str] = _BASES) -> dict[str, DataFrame]:
    return graph.neighbourhood(m.tables(), SEEDS, lambda name, df: _once(m, name, df) if name in stored else df, m.of_works(lambda name, df: _once(m, name, df)))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.round(f.name, 6) for f in df.schema if f.dataType.typeName() == "double"})


def _per_work(m: Model) -> tuple[dict[str, DataFrame], DataFrame]:
    t = _filtered(m, _FACTS)
    return t, metrics.works_metrics(t, SEEDS, m.concepts())


def _by_entity(build: Callable[[dict[str, DataFrame], DataFrame], DataFrame]) -> Query:
    def query(m: Model) -> DataFrame:
        t, per_work = _per_work(m)
        return _rounded(build(t, _once(m, "works_metrics", per_work)))

    return _model(query)


_add("seed_scores", _model(lambda m: graph.seed_scores(m.scores(), SEEDS)), sql("SELECT * FROM seeded"))
for _t, _name in (("scores", "dedup_scores"), ("authorships", "dedup_authorships"), ("edges", "dedup_edges"), ("affiliations", "dedup_affiliations")):
    _add(_name, _model(lambda m, t=_t: getattr(m, t)()), sql(f"SELECT * FROM {_t}"))
_add("duplicate_keys", _model(lambda m: dedup.duplicate_keys(m.scores_raw(), ("work_id", "concept_id"))), sql('SELECT work_id, concept_id, count(*) AS "rows" FROM scores_raw GROUP BY ALL HAVING count(*) > 1'))


def _with_nulls(m: Model) -> DataFrame:
    """Scores whose concept is unknown for every 7th part."""
    return m.scores_raw().withColumn("concept_id", F.when(F.substring("work_id", 2, 20).cast("long") % 7 != 0, F.col("concept_id")))


_NULLS = "SELECT work_id, CASE WHEN CAST(substr(work_id, 2) AS BIGINT) % 7 <> 0 THEN concept_id END AS concept_id, concept_score, snapshot_date FROM scores_raw"
_add("null_keys", _model(lambda m: dedup.null_keys(_with_nulls(m), ("work_id", "concept_id"))), sql(f"SELECT * FROM ({_NULLS}) WHERE work_id IS NULL OR concept_id IS NULL"))
_add(
    "table_check",
    _model(lambda m: dedup.check(_with_nulls(m), ("work_id", "concept_id"))),
    sql(f"""SELECT CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(CASE WHEN work_id IS NULL OR concept_id IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_keys,
      count(*) FILTER (WHERE n > 1 AND work_id IS NOT NULL AND concept_id IS NOT NULL) AS duplicate_keys
      FROM (SELECT work_id, concept_id, count(*) AS n FROM ({_NULLS}) GROUP BY ALL)"""),
)
_add("filtered_edges", _model(lambda m: _filtered(m)["citation_edges"]), sql("SELECT * FROM f_edges"))
_add("work_ids", _model(lambda m: _filtered(m)["work_ids"]), sql("SELECT * FROM ids"))
for _t in ("works", "authorships", "affiliations", "scores", "selected_scores", "authors", "concepts", "institutions", "sources"):
    _add(f"filtered_{_t}", _model(lambda m, t=_t: _filtered(m)[t]), sql(f"SELECT * FROM f_{_t}"))


def _degrees(m: Model) -> DataFrame:
    cited, citing = metrics.degrees(_filtered(m)["citation_edges"])
    both = cited.join(citing, "work_id", "full")
    return both.select("work_id", F.coalesce("local_in_citations", F.lit(0)).alias("local_in_citations"), F.coalesce("local_out_citations", F.lit(0)).alias("local_out_citations"))


_add("degrees", _model(_degrees), sql("SELECT work_id, coalesce(local_in_citations, 0) AS local_in_citations, coalesce(local_out_citations, 0) AS local_out_citations FROM in_deg FULL JOIN out_deg USING (work_id)"))
_add(
    "seed_concept_metrics",
    _model(lambda m: _rounded(metrics.seed_concept_metrics(_filtered(m)["scores"], SEEDS))),
    sql("SELECT work_id, seed_concept_max_score, round(seed_concept_sum_score, 6) AS seed_concept_sum_score, seed_concept_count FROM seed_m"),
)


def _entity_counts(m: Model) -> DataFrame:
    t = _filtered(m)
    out = t["works"].select("work_id")
    for part in metrics.entity_counts(t["authorships"], t["affiliations"], t["scores"]):
        out = out.join(part, "work_id", "left")
    return out.fillna(0)


_add("work_entity_counts", _model(_entity_counts), sql("SELECT work_id, authors_count, institutions_count, concepts_count FROM works_m"))
_add("top_concept", _model(lambda m: metrics.top_concept(_filtered(m)["scores"], m.concepts())), sql("SELECT * FROM top_c"))
_add("works_metrics", _model(lambda m: _rounded(_per_work(m)[1])), sql("SELECT * FROM works_m"))

_ROLL = """coalesce(r.s, 0) AS local_citation_count, round(coalesce(r.a, 0.0), 6) AS mean_local_in_citations, coalesce(r.m, 0) AS max_local_in_citations"""


def _roll(facts: str, key: str) -> str:
    return f"""(SELECT {key}, CAST(sum(local_in_citations) AS BIGINT) AS s, avg(coalesce(local_in_citations, 0)) AS a, max(local_in_citations) AS m
      FROM {facts} LEFT JOIN works_m USING (work_id) WHERE {key} IS NOT NULL GROUP BY 1) r"""


def _span(facts: str, key: str) -> str:
    return f"(SELECT {key}, min(publication_year) AS y1, max(publication_year) AS y2 FROM {facts} JOIN f_works USING (work_id) WHERE publication_year IS NOT NULL GROUP BY 1) y"


_YEARS = "y1 AS first_publication_year, y2 AS last_publication_year"
_add(
    "authors_metrics",
    _by_entity(metrics.authors_metrics),
    sql(f"""SELECT author_id, coalesce(n, 0) AS local_works_count, coalesce(f, 0) AS first_author_count, coalesce(l, 0) AS last_author_count, coalesce(c, 0) AS corresponding_author_count,
      {_YEARS}, y2 - y1 + 1 AS years_active, {_ROLL}
      FROM f_authors LEFT JOIN (SELECT author_id, count(DISTINCT work_id) AS n, count(*) FILTER (WHERE author_position = 'first') AS f, count(*) FILTER (WHERE author_position = 'last') AS l,
        count(*) FILTER (WHERE is_corresponding) AS c FROM f_authorships GROUP BY 1) USING (author_id)
      LEFT JOIN {_span('f_authorships', 'author_id')} USING (author_id) LEFT JOIN {_roll('f_authorships', 'author_id')} USING (author_id)"""),
)
_add(
    "sources_metrics",
    _by_entity(metrics.sources_metrics),
    sql(f"""SELECT source_id, coalesce(n, 0) AS local_works_count, {_YEARS}, coalesce(o, 0) AS open_access_works_count, coalesce(d, 0) AS retracted_works_count, {_ROLL}
      FROM f_sources LEFT JOIN (SELECT source_id, count(DISTINCT work_id) AS n, min(publication_year) AS y1, max(publication_year) AS y2,
        count(DISTINCT work_id) FILTER (WHERE coalesce(is_open_access, false)) AS o, count(DISTINCT work_id) FILTER (WHERE coalesce(is_retracted, false)) AS d FROM f_works GROUP BY 1) USING (source_id)
      LEFT JOIN {_roll('f_works', 'source_id')} USING (source_id)"""),
)
_add(
    "institutions_metrics",
    _by_entity(metrics.institutions_metrics),
    sql(f"""SELECT institution_id, coalesce(n, 0) AS local_works_count, coalesce(p, 0) AS local_authors_count, {_YEARS}, {_ROLL}
      FROM f_institutions LEFT JOIN (SELECT institution_id, count(DISTINCT work_id) AS n, count(DISTINCT author_id) AS p FROM f_affiliations GROUP BY 1) USING (institution_id)
      LEFT JOIN {_span('f_affiliations', 'institution_id')} USING (institution_id)
      LEFT JOIN {_roll('(SELECT DISTINCT institution_id, work_id FROM f_affiliations)', 'institution_id')} USING (institution_id)"""),
)
_add(
    "concepts_metrics",
    _by_entity(metrics.concepts_metrics),
    sql(f"""SELECT concept_id, coalesce(n, 0) AS local_works_count, round(coalesce(ca, 0.0), 6) AS mean_concept_score, coalesce(cm, 0.0) AS max_concept_score, {_YEARS}, {_ROLL}
      FROM f_concepts LEFT JOIN (SELECT concept_id, count(DISTINCT work_id) AS n, avg(concept_score) AS ca, max(concept_score) AS cm FROM f_scores GROUP BY 1) USING (concept_id)
      LEFT JOIN {_span('f_scores', 'concept_id')} USING (concept_id) LEFT JOIN {_roll('f_scores', 'concept_id')} USING (concept_id)"""),
)


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the seeds for every part, 0 where the part lacks one; the latest of repeated ones by date, then score."""
    from quillgraph.config import SelectedConcepts

    raw = Model(spark, sf_dir).scores_raw()
    entry = F.struct("snapshot_date", F.col("concept_score").alias("score"), F.col("concept_id").alias("id"))
    records = raw.groupBy(F.col("work_id").alias("id")).agg(F.array_sort(F.collect_list(entry)).alias("c"))
    shaped = F.transform("c", lambda x: F.struct(x["id"].alias("id"), F.lit(None).cast("string").alias("display_name"), F.lit(None).cast("int").alias("level"), x["score"].alias("score")))
    records = records.select("id", shaped.alias("concepts"), F.lit(None).cast("string").alias("snapshot_date"))
    return generators.selected_scores(records, SelectedConcepts(concept_ids=tuple(SEEDS))).drop("snapshot_date")


_add(
    "selected_scores",
    _selected,
    sql("""SELECT work_id, concept_id, coalesce(concept_score, 0.0) AS concept_score
      FROM (SELECT DISTINCT work_id FROM scores_raw) CROSS JOIN (VALUES ('C1'), ('C2')) v(concept_id)
      LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY work_id, concept_id ORDER BY snapshot_date DESC, concept_score DESC) AS n FROM scores_raw) WHERE n = 1) USING (work_id, concept_id)"""),
)
_add(
    "strip_id",
    lambda spark, d: spark.read.parquet(f"{d}/pages.parquet").select("page_id", strip_id("url").alias("tail")),
    "SELECT page_id, string_split(url, '/')[-1] AS tail FROM pages",
)
_add(
    "json_extract",
    lambda spark, d: spark.read.parquet(f"{d}/events.parquet").select("event_id", F.from_json("props", "k int").getField("k").alias("k")),
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
)


def _posexplode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as works, their lines in order as authorships."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey", "l_shipdate"))).alias("a"))
    author = F.transform("a", lambda x: F.struct(F.struct(F.concat(F.lit("x/A"), x["l_suppkey"]).alias("id")).alias("author"), F.lit("middle").alias("author_position"), F.lit(False).alias("is_corresponding")))
    records = lines.select(F.concat(F.lit("x/W"), F.col("l_orderkey")).alias("id"), author.alias("authorships"), F.lit(None).cast("string").alias("snapshot_date"))
    return generators.authorships(records).select("work_id", "author_id", "author_sequence")


_add(
    "posexplode_authors",
    _posexplode,
    """SELECT 'W' || l_orderkey AS work_id, 'A' || l_suppkey AS author_id,
      CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_shipdate) - 1 AS INT) AS author_sequence FROM lineitem""",
)
_add(
    "text_clean",
    lambda spark, d: spark.read.parquet(f"{d}/pages.parquet").select("page_id", clean_text("html").alias("clean")),
    """SELECT page_id, trim(nfc_normalize(replace(replace(replace(replace(html, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')), ' ' || chr(10) || chr(9)) AS clean FROM pages""",
)


def _inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of the benchmark items, turned into a map of words to places, and back."""
    words = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", F.posexplode(F.split("text", r"\s+")).alias("p", "w"))
    entries = words.groupBy("item_id", "w").agg(F.array_sort(F.collect_list("p")).alias("ps")).groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "ps"))).alias("m"))
    return entries.select("item_id", invert_abstract("m").alias("abstract"))


_add("invert_abstract", _inverted, r"SELECT item_id, array_to_string(regexp_split_to_array(text, '\s+'), ' ') AS abstract FROM benchmark")

QUERIES |= ingestqueries.QUERIES
SQL |= ingestqueries.SQL
