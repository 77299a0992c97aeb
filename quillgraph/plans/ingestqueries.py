"""Registered queries of ingestion: shards of JSON lines are made of the benchmark tables, written, and read, parsed and flattened as any snapshot; and the SQL for the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.config import SelectedConcepts
from quillgraph.functions.ids import bucket, file_name
from quillgraph.operators import generators
from quillgraph.schemas import raw_author, raw_work
from quillgraph.scratch import scratch_path
from quillgraph.sources import shards, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
FIRST, LAST, THRESHOLD = 2005, 2024, 0.3

#: Every order as a work, every customer as an author. Some lines are broken, of another shape, or of a year that can't be used.
_WORK = (
    '{"id": "https://x.org/W%d", "publication_year": %s, "publication_date": "2010-01-01", "title": " %s &amp; %s\\u0301 ", "abstract_inverted_index": {"three": [2, 9], "one": [0], "two": [1, 5], "none": null, "clash": [1]}, '
    '"cited_by_count": %s, "referenced_works_count": 2, "fwci": 0.5, "type": "article", "is_retracted": false, "is_paratext": false, "language": "en", "doi": "10.1/%d", "ids": {"doi": "10.1/%d"}, '
    '"open_access": {"is_oa": %s, "oa_url": "u"}, "primary_location": %s, "referenced_works": ["https://x.org/W%d", "W%d"], '
    '"authorships": [{"author": {"id": "https://x.org/A%d"}, "author_position": "first", "is_corresponding": true, "institutions": [{"id": "https://x.org/I%d", "display_name": "U &lt;%d&gt;", "country_code": "DE"}, {"id": "I0"}]}, '
    '{"author": null, "author_position": "last", "institutions": []}], '
    '"concepts": [{"id": "https://x.org/C%d", "display_name": " c ", "level": 1, "score": %s}, {"id": "C7", "score": null}, {"id": "C%d", "display_name": "d", "level": 2, "score": 0.25}], "created_date": "2011-01-01"}'
)
_SOURCE = '{"landing_page_url": "l", "pdf_url": null, "source": {"id": "https://x.org/S%d", "display_name": "JÃ© ", "type": "journal", "issn_l": "1", "issn": ["1", "2"], "host_organization": "https://x.org/P1", "is_oa": true}}'


def _add(name: str, query: Query, text: str) -> None:
    QUERIES[f"q_{name}"] = query
    SQL[f"q_{name}"] = text


def _cases(of: Column, *values: str) -> Column:
    out = F.lit(values[-1])
    for i, v in reversed(list(enumerate(values[:-1]))):
        out = F.when(of == i, v).otherwise(out)
    return out


def _filled(template: str, *values: Column | str) -> Column:
    """format_string() of a template with %s and %d only, without a formatter for each row."""
    first, *rest = re.split("%[sd]", template)
    out = [F.lit(first)]
    for value, text in zip(values, rest, strict=True):
        out += [F.coalesce((F.col(value) if isinstance(value, str) else value).cast("string"), F.lit("null")), F.lit(text)]
    return F.concat(*out)


def _dated(df: DataFrame, key: str) -> DataFrame:
    """df with its rows' dates, in their order: the writer of dated folders wants it, and would sort the long lines if the rows that they are made of weren't sorted before."""
    date = F.coalesce(F.concat(F.lit("2024-05-0"), F.col(key) % 3 + 1), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return df.withColumn("updated_date", date).sortWithinPartitions("updated_date")


def work_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, updated_date)"""
    o = _dated(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"), "o_orderkey")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    place = F.when(c % 7 == 0, "null").when(c % 7 == 1, '{"source": {}}').otherwise(_filled(_SOURCE, c % 100))
    year = _cases(k % 6, "2010", '"2011"', "2012.7", '"soon"', "null", "1990")
    many = F.when(k % 50 == 15, '"many"').otherwise(c.cast("string"))
    whole = _filled(_WORK, k, year, "o_orderpriority", "o_orderstatus", many, k, k, F.when(k % 2 == 0, "true").otherwise("false"), place, k + 1, k * 2, c, c % 25, c % 25, c % 50, F.when(k % 3 == 0, "0.125").otherwise("0.75"), c % 50)
    value = F.when(k % 50 == 13, "{broken").when(k % 50 == 14, "[1, 2]").when(k % 50 == 16, " ").otherwise(whole)
    return o.select(value.alias("value"), "updated_date")


def author_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _dated(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name"), "c_custkey")
    k = F.col("c_custkey")
    line = _filled('{"id": "https://x.org/A%d", "display_name": " %s ", "works_count": %d, "cited_by_count": %d, "summary_stats": %s}', k, "c_name", k % 10, k % 100, F.when(k % 4 == 0, "null").otherwise(_filled('{"h_index": %d}', k % 5)))
    return c.select(line.alias("value"), "updated_date")


def _read(lines: DataFrame, kind: str) -> DataFrame:
    """Written as gzip shards in dated folders and read again."""
    root = scratch_path(lines.sparkSession, "shards")
    lines.write.partitionBy("updated_date").option("compression", "gzip").text(f"{root}/{kind}")
    return shards.read_lines(lines.sparkSession, f"{root}/{kind}")


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Numbers and truth values that may be NULL, as text: readers of results show missing ones in different ways."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def parsed_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.parse(_read(work_lines(spark, sf_dir), "works"), raw_work())


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.works_in_range(parsed_works(spark, sf_dir), FIRST, LAST)


_MADE = """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, 'W' || o_orderkey AS work_id, 'A' || o_custkey AS author_id, '2024-05-0' || (o_orderkey % 3 + 1) AS snapshot_date,
    CASE o_orderkey % 6 WHEN 0 THEN 2010 WHEN 1 THEN 2011 WHEN 2 THEN 2012 END AS y, o_orderpriority || ' & ' || CASE o_orderstatus WHEN 'O' THEN 'Ó' WHEN 'P' THEN 'Ṕ' ELSE o_orderstatus || chr(769) END AS title
  FROM orders),
r AS (SELECT * FROM o WHERE y IS NOT NULL AND k % 50 NOT IN (13, 14, 15, 16))
"""
_add(
    "ingest_works",
    lambda spark, d: generators.works(_records(spark, d), True),
    _MADE
    + """SELECT work_id, CAST(y AS INT) AS publication_year, '2010-01-01' AS publication_date, title, 'one two three two three' AS abstract_text, CAST(length(title) AS INT) AS title_length,
  23 AS abstract_length, CAST(c AS INT) AS cited_by_count, 2 AS referenced_works_count, CAST(0.5 AS DOUBLE) AS fwci, CASE WHEN c % 7 > 1 THEN 'S' || (c % 100) END AS source_id,
  'article' AS work_type, false AS is_retracted, false AS is_paratext, 'en' AS language, '10.1/' || k AS doi, '{"doi":"10.1/' || k || '"}' AS ids, k % 2 = 0 AS is_open_access, 'u' AS open_access_url,
  CASE WHEN c % 7 > 1 THEN 'l' END AS landing_page_url, CAST(NULL AS VARCHAR) AS pdf_url, '2011-01-01' AS created_date, CAST(NULL AS VARCHAR) AS updated_date, snapshot_date,
  '{"three":[2,9],"one":[0],"two":[1,5],"none":null,"clash":[1]}' AS abstract_inverted_index FROM r""",
)
_add("ingest_edges", lambda spark, d: generators.citation_edges(_records(spark, d)), _MADE + "SELECT 'W' || unnest([k + 1, k * 2]) AS cited_work_id, work_id AS citing_work_id, snapshot_date FROM r")
_add(
    "ingest_authorships",
    lambda spark, d: _as_text(generators.authorships(_records(spark, d)), "is_corresponding"),
    _MADE + """SELECT work_id, author_id, 'first' AS author_position, 0 AS author_sequence, 'true' AS is_corresponding, snapshot_date FROM r
UNION ALL SELECT work_id, NULL, 'last', 1, NULL, snapshot_date FROM r""",
)
_add("ingest_affiliations", lambda spark, d: generators.affiliations(_records(spark, d)), _MADE + "SELECT work_id, author_id, 'I' || unnest([c % 25, 0]) AS institution_id, snapshot_date FROM r")
_add(
    "ingest_institutions",
    lambda spark, d: generators.institutions(_records(spark, d)),
    _MADE + """SELECT 'I' || (c % 25) AS institution_id, 'U <' || (c % 25) || '>' AS institution_name, 'DE' AS country, snapshot_date FROM r
UNION ALL SELECT 'I0', NULL, NULL, snapshot_date FROM r""",
)
_add(
    "ingest_sources",
    lambda spark, d: generators.sources(_records(spark, d)),
    _MADE + """SELECT 'S' || (c % 100) AS source_id, 'Jé' AS source_name, 'journal' AS source_type, '1' AS linking_issn, '["1","2"]' AS issn_list, 'P1' AS host_organization_id, true AS is_oa, snapshot_date
FROM r WHERE c % 7 > 1""",
)
_add(
    "ingest_concepts",
    lambda spark, d: generators.concepts(_records(spark, d), THRESHOLD),
    _MADE + "SELECT 'C' || (c % 50) AS concept_id, 'c' AS concept_name, 1 AS concept_level, snapshot_date FROM r WHERE k % 3 <> 0",
)
_add(
    "ingest_scores",
    lambda spark, d: generators.scores(_records(spark, d), 0.0),
    _MADE + """SELECT work_id, 'C' || (c % 50) AS concept_id, unnest([CASE WHEN k % 3 = 0 THEN 0.125 ELSE 0.75 END, 0.25])::DOUBLE AS concept_score, snapshot_date FROM r
UNION ALL SELECT work_id, 'C7', NULL, snapshot_date FROM r""",
)
_add(
    "ingest_selected_scores",
    lambda spark, d: generators.selected_scores(_records(spark, d), SelectedConcepts(get_all_concepts=True)),
    _MADE + """SELECT work_id, 'C' || (c % 50) AS concept_id, CAST(0.25 AS DOUBLE) AS concept_score, snapshot_date FROM r
UNION ALL SELECT work_id, 'C7', NULL, snapshot_date FROM r WHERE c % 50 <> 7""",
)
_add(
    "ingest_authors",
    lambda spark, d: _as_text(generators.author_rows(shards.authors(shards.parse(_read(author_lines(spark, d), "authors"), raw_author()))), "first_publication_year", "last_publication_year", "h_index"),
    """SELECT 'A' || c_custkey AS author_id, c_name AS author_name, CAST(NULL AS VARCHAR) AS first_publication_year, CAST(NULL AS VARCHAR) AS last_publication_year, CAST(c_custkey % 10 AS INT) AS works_count,
  CAST(c_custkey % 100 AS INT) AS cited_by_count, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 5 AS VARCHAR) END AS h_index, '2024-05-0' || (c_custkey % 3 + 1) AS snapshot_date FROM customer""",
)
_add(
    "ingest_failures",
    lambda spark, d: shards.failures(parsed_works(spark, d)).select("stage", "record_id", "error_type", F.substring("error", 1, 50).alias("error")),
    _MADE + """SELECT 'parse' AS stage, CASE WHEN k % 50 = 15 THEN work_id END AS record_id, CASE WHEN k % 50 = 15 THEN 'TypeMismatch' ELSE 'NotAnObject' END AS error_type,
  substr('record doesn''t fit the schema: ' || CASE WHEN k % 50 = 15 THEN '{"id": "https://x.org/W' || k || '", "publication_year"' ELSE '[1, 2]' END, 1, 50) AS error FROM o WHERE k % 50 IN (14, 15)""",
)


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_works(spark, sf_dir).groupBy("state", F.substring_index("shard", "_part", 1).alias("folder"), "snapshot_date").agg(F.count("*").alias("lines"))


_add(
    "ingest_states",
    _states,
    _MADE + """SELECT CASE WHEN k % 50 = 13 THEN 'malformed' WHEN k % 50 IN (14, 15) THEN 'failed' ELSE 'ok' END AS state, 'updated_date=' || snapshot_date AS folder, snapshot_date, count(*) AS lines
FROM o WHERE k % 50 <> 16 GROUP BY ALL""",
)


def _buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose rows are in one bucket each, of as many buckets as are asked for."""
    b = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey", bucket(["l_partkey"], 16).alias("b"))
    return b.groupBy("l_partkey").agg(F.count("*").alias("rows"), F.countDistinct("b").alias("buckets"), (F.min("b").between(0, 15) & F.max("b").between(0, 15)).alias("inside"))


_add("buckets", _buckets, 'SELECT l_partkey, count(*) AS "rows", CAST(1 AS BIGINT) AS buckets, true AS inside FROM lineitem GROUP BY l_partkey')
_add("file_names", lambda spark, d: spark.read.parquet(f"{d}/pages.parquet").select("page_id", file_name("url").alias("name")), "SELECT page_id, regexp_extract(url, '[^/]*$') AS name FROM pages")


def _partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written in a folder for each bucket of a key and read again, the folders' number as a column."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    root = scratch_path(spark, "partitioned")
    sinks.write_bucketed(lines, f"{root}/bucketed", ["l_orderkey"], 8)
    sinks.write_table(shards.read_table(spark, f"{root}/bucketed").where(F.col("bucket") == bucket(["l_orderkey"], 8)).drop("bucket"), f"{root}/flags", partition_by=("l_returnflag",))
    schema = lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag").schema
    return shards.read_table(spark, f"{root}/flags", schema).groupBy("l_returnflag", "l_orderkey").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))


_add("partitioned", _partitioned, "SELECT l_returnflag, l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL")
