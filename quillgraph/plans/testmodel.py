"""The bibliographic model over the benchmark tables, for queries that have a SQL oracle.

Parts are works, suppliers concepts, customers authors, nations institutions, brands sources. The same projection stands in SQL below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgraph.operators import dedup, graph

SEEDS = ["C1", "C2"]
THRESHOLD = 0.9


def _id(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


class Model:
    """Lazily read tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.read: Callable[[str], DataFrame] = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def scores_raw(self) -> DataFrame:
        return self.read("lineitem").select(_id("W", "l_partkey").alias("work_id"), _id("C", "l_suppkey").alias("concept_id"), F.round(F.col("l_discount") * 10, 2).alias("concept_score"), _day("l_shipdate").alias("snapshot_date"))

    def scored(self) -> DataFrame:
        return self.scores_raw().where(F.col("concept_score") >= THRESHOLD)

    def scores(self) -> DataFrame:
        return dedup.dedup(self.scored(), "scores")

    def edges_raw(self, lines: DataFrame | None = None) -> DataFrame:
        """Consecutive returned lines of an order cite each other."""
        lines = (lines or self.read("lineitem")).where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_linestatus", "l_partkey", "l_shipdate")
        a, b = lines.alias("a"), lines.withColumn("l_linenumber", F.col("l_linenumber") - 1).alias("b")
        pairs = a.join(b, ["l_orderkey", "l_linenumber", "l_linestatus"])
        return pairs.select(_id("W", "b.l_partkey").alias("cited_work_id"), _id("W", "a.l_partkey").alias("citing_work_id"), _day("a.l_shipdate").alias("snapshot_date"))

    def edges(self) -> DataFrame:
        return dedup.dedup(self.edges_raw(), "citation_edges")

    def works(self, lines: DataFrame | None = None) -> DataFrame:
        year = (lines or self.read("lineitem")).groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min(F.year("l_shipdate")).alias("publication_year"))
        return self.read("part").join(year, "p_partkey", "left").select(
            _id("W", "p_partkey").alias("work_id"), "publication_year", F.col("p_brand").alias("source_id"), (F.col("p_size") % 2 == 0).alias("is_open_access"), (F.col("p_size") % 10 == 0).alias("is_retracted")
        )

    def authorships_raw(self, lines: DataFrame | None = None) -> DataFrame:
        """lines: all of each order that has one among them."""
        last = F.max("l_linenumber").over(Window.partitionBy("l_orderkey"))
        lines = (lines or self.read("lineitem")).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", last.alias("last"))
        joined = lines.join(self.read("orders").select("o_orderkey", "o_custkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
        position = F.when(F.col("l_linenumber") == 1, "first").when(F.col("l_linenumber") == F.col("last"), "last").otherwise("middle")
        return joined.select(
            _id("W", "l_partkey").alias("work_id"),
            _id("A", "o_custkey").alias("author_id"),
            position.alias("author_position"),
            (F.col("l_linenumber") - 1).alias("author_sequence"),
            (F.col("o_orderpriority") == "1-URGENT").alias("is_corresponding"),
            _day("l_shipdate").alias("snapshot_date"),
        )

    def authorships(self) -> DataFrame:
        return dedup.dedup(self.authorships_raw(), "authorships")

    def affiliations_raw(self, authorships: DataFrame | None = None) -> DataFrame:
        home = self.read("customer").select(_id("A", "c_custkey").alias("author_id"), _id("I", "c_nationkey").alias("institution_id"))
        return (authorships or self.authorships_raw()).select("work_id", "author_id", "snapshot_date").join(home, "author_id").select("work_id", "author_id", "institution_id", "snapshot_date")

    def affiliations(self) -> DataFrame:
        return dedup.dedup(self.affiliations_raw(), "affiliations")

    def institutions(self) -> DataFrame:
        return self.read("nation").select(_id("I", "n_nationkey").alias("institution_id"), F.col("n_name").alias("institution_name"))

    def authors(self) -> DataFrame:
        return self.read("customer").select(_id("A", "c_custkey").alias("author_id"), F.col("c_name").alias("author_name"))

    def concepts(self) -> DataFrame:
        return self.read("supplier").select(_id("C", "s_suppkey").alias("concept_id"), F.col("s_name").alias("concept_name"))

    def sources(self) -> DataFrame:
        return self.read("part").select(F.col("p_brand").alias("source_id")).distinct()

    def tables(self) -> dict[str, DataFrame]:
        scores = self.scores()
        return {
            "scores": scores,
            "selected_scores": self.scores_raw().where(F.col("concept_id").isin(*SEEDS)).groupBy("work_id", "concept_id").agg(F.max("concept_score").alias("concept_score")),
            "citation_edges": self.edges(),
            "works": self.works(),
            "authorships": self.authorships(),
            "affiliations": self.affiliations(),
            "institutions": self.institutions(),
            "authors": self.authors(),
            "concepts": self.concepts(),
            "sources": self.sources(),
        }

    def of_works(self, keep: Callable[[str, DataFrame], DataFrame]) -> dict[str, Callable[[DataFrame], DataFrame]]:
        """For graph.neighbourhood: the same rows as those of tables() that belong to given works, from the lines of these works or of the orders that have one of them. keep stores
        the orders, so that Spark knows whether they are few."""
        lines = self.read("lineitem")

        def own(ids: DataFrame) -> DataFrame:
            return lines.withColumn("work_id", _id("W", "l_partkey")).join(ids, "work_id", "left_semi")

        def whole_orders(name: str, ids: DataFrame) -> DataFrame:
            return lines.join(keep(name, own(ids).select("l_orderkey").distinct()), "l_orderkey", "left_semi")

        def authorships(ids: DataFrame) -> DataFrame:
            return graph.by_work(self.authorships_raw(whole_orders("orders", ids)), ids)

        return {
            "scores": lambda ids: dedup.dedup(graph.by_work(self.scored(), ids), "scores"),
            "citation_edges": lambda ids: dedup.dedup(graph.filtered_edges(self.edges_raw(whole_orders("seed_orders", ids)), ids), "citation_edges"),
            "works": lambda ids: graph.by_work(self.works(own(ids)), ids),
            "authorships": lambda ids: dedup.dedup(authorships(ids), "authorships"),
            "affiliations": lambda ids: dedup.dedup(self.affiliations_raw(authorships(ids)), "affiliations"),
        }


_DAY = "strftime({}, '%Y-%m-%d')"
_SEEDS = ", ".join(f"'{s}'" for s in SEEDS)

#: The model as SQL, one common table expression after another.
CTE: dict[str, str] = {
    "scores_raw": f"SELECT 'W' || l_partkey AS work_id, 'C' || l_suppkey AS concept_id, round(l_discount * 10, 2) AS concept_score, {_DAY.format('l_shipdate')} AS snapshot_date FROM lineitem",
    "scores": f"""SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY work_id, concept_id ORDER BY snapshot_date DESC NULLS LAST, concept_score DESC NULLS LAST) AS n
      FROM scores_raw WHERE concept_score >= {THRESHOLD}) WHERE n = 1""",
    "edges_raw": f"""SELECT 'W' || b.l_partkey AS cited_work_id, 'W' || a.l_partkey AS citing_work_id, {_DAY.format('a.l_shipdate')} AS snapshot_date
      FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber AND a.l_linestatus = b.l_linestatus
      WHERE a.l_returnflag = 'R' AND b.l_returnflag = 'R'""",
    "edges": "SELECT cited_work_id, citing_work_id, max(snapshot_date) AS snapshot_date FROM edges_raw GROUP BY ALL",
    "works": """SELECT 'W' || p_partkey AS work_id, y AS publication_year, p_brand AS source_id, p_size % 2 = 0 AS is_open_access, p_size % 10 = 0 AS is_retracted
      FROM part LEFT JOIN (SELECT l_partkey, CAST(min(year(l_shipdate)) AS INT) AS y FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""",
    "authorships_raw": f"""SELECT 'W' || l_partkey AS work_id, 'A' || o_custkey AS author_id,
      CASE WHEN l_linenumber = 1 THEN 'first' WHEN l_linenumber = last THEN 'last' ELSE 'middle' END AS author_position, CAST(l_linenumber - 1 AS INT) AS author_sequence,
      o_orderpriority = '1-URGENT' AS is_corresponding, {_DAY.format('l_shipdate')} AS snapshot_date
      FROM (SELECT *, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS last FROM lineitem) JOIN orders ON l_orderkey = o_orderkey""",
    "authorships": """SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY work_id, author_id ORDER BY snapshot_date DESC NULLS LAST, is_corresponding DESC NULLS LAST,
      coalesce(list_position(['first', 'last', 'middle'], author_position), 4), author_position NULLS LAST, author_sequence NULLS LAST) AS n FROM authorships_raw) WHERE n = 1""",
    "affiliations": """SELECT work_id, author_id, institution_id, max(snapshot_date) AS snapshot_date FROM authorships_raw
      JOIN (SELECT 'A' || c_custkey AS author_id, 'I' || c_nationkey AS institution_id FROM customer) USING (author_id) GROUP BY ALL""",
    "institutions": "SELECT 'I' || n_nationkey AS institution_id, n_name AS institution_name FROM nation",
    "authors": "SELECT 'A' || c_custkey AS author_id, c_name AS author_name FROM customer",
    "concepts": "SELECT 'C' || s_suppkey AS concept_id, s_name AS concept_name FROM supplier",
    "sources": "SELECT DISTINCT p_brand AS source_id FROM part",
    "selected_scores": f"SELECT work_id, concept_id, max(concept_score) AS concept_score FROM scores_raw WHERE concept_id IN ({_SEEDS}) GROUP BY ALL",
    "seeded": f"SELECT * FROM scores WHERE concept_id IN ({_SEEDS})",
    "f_edges": "SELECT * FROM edges WHERE citing_work_id IN (SELECT work_id FROM seeded) UNION SELECT * FROM edges WHERE cited_work_id IN (SELECT work_id FROM seeded)",
    "ids": "SELECT work_id FROM seeded UNION SELECT citing_work_id FROM f_edges UNION SELECT cited_work_id FROM f_edges",
    **{f"f_{t}": f"SELECT * FROM {t} WHERE work_id IN (SELECT work_id FROM ids)" for t in ("works", "authorships", "affiliations", "scores", "selected_scores")},
    "f_authors": "SELECT * FROM authors WHERE author_id IN (SELECT author_id FROM f_authorships)",
    "f_concepts": "SELECT * FROM concepts WHERE concept_id IN (SELECT concept_id FROM f_scores)",
    "f_institutions": "SELECT * FROM institutions WHERE institution_id IN (SELECT institution_id FROM f_affiliations)",
    "f_sources": "SELECT * FROM sources WHERE source_id IN (SELECT source_id FROM f_works)",
    "in_deg": "SELECT cited_work_id AS work_id, count(*) AS local_in_citations FROM f_edges GROUP BY 1",
    "out_deg": "SELECT citing_work_id AS work_id, count(*) AS local_out_citations FROM f_edges GROUP BY 1",
    "seed_m": f"""SELECT work_id, max(concept_score) AS seed_concept_max_score, sum(concept_score) AS seed_concept_sum_score, count(DISTINCT concept_id) AS seed_concept_count
      FROM f_scores WHERE concept_id IN ({_SEEDS}) GROUP BY 1""",
    "top_c": """SELECT work_id, concept_name AS top_concept_name, concept_id AS top_concept_id, concept_score AS top_concept_score FROM (
      SELECT s.work_id, s.concept_id, s.concept_score, c.concept_name, row_number() OVER (PARTITION BY s.work_id ORDER BY s.concept_score DESC NULLS LAST, s.concept_id, coalesce(c.concept_name, '')) AS n
      FROM f_scores s LEFT JOIN concepts c USING (concept_id)) WHERE n = 1""",
    "works_m": """SELECT w.work_id, coalesce(local_in_citations, 0) AS local_in_citations, coalesce(local_out_citations, 0) AS local_out_citations,
      coalesce(seed_concept_max_score, 0.0) AS seed_concept_max_score, round(coalesce(seed_concept_sum_score, 0.0), 6) AS seed_concept_sum_score, coalesce(seed_concept_count, 0) AS seed_concept_count,
      coalesce(authors_count, 0) AS authors_count, coalesce(institutions_count, 0) AS institutions_count, coalesce(concepts_count, 0) AS concepts_count,
      top_concept_name, top_concept_id, coalesce(top_concept_score, 0.0) AS top_concept_score
      FROM f_works w LEFT JOIN in_deg USING (work_id) LEFT JOIN out_deg USING (work_id) LEFT JOIN seed_m USING (work_id)
      LEFT JOIN (SELECT work_id, count(DISTINCT author_id) AS authors_count FROM f_authorships GROUP BY 1) USING (work_id)
      LEFT JOIN (SELECT work_id, count(DISTINCT institution_id) AS institutions_count FROM f_affiliations GROUP BY 1) USING (work_id)
      LEFT JOIN (SELECT work_id, count(DISTINCT concept_id) AS concepts_count FROM f_scores GROUP BY 1) USING (work_id) LEFT JOIN top_c USING (work_id)""",
}


def sql(select: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in CTE.items()) + f"\n{select}"
