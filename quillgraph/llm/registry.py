"""The queries of the corpus operators, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillgraph.llm import harmonic, license_scan, line_dedup, ngram_join, pieces, token_pack, topk, toxicity, vptree, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_pack.pack_tokens(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic.pack(table(spark, sf_dir, "documents"))


def op5_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.duplicate_lines(table(spark, sf_dir, "documents")).drop("tie")


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages are written as archives, the record of every 97th page is damaged, and the archives are read again."""
    return warc.read(warc.write_archives(table(spark, sf_dir, "pages"), damage_every=97))


def op9_ann_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query set is every vector whose id is divisible by 100; all vectors are indexed."""
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.ann(vectors.where("vec_id % 100 = 0"), vectors)


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query set is every vector whose id is divisible by 100, against all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_topk(vectors.where("vec_id % 100 = 0"), vectors)


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_license_scan, op2_token_packing, op3_ngram_jaccard_join, op4_harmonic_packing, op5_piece_encoding, op6_toxicity, op7_line_dedup, op8_warc_salvage, op9_ann_vptree, op10_exact_topk)}

_TOPK_SQL = """
WITH e AS (SELECT vec_id, min(CAST(embedding AS DOUBLE[])) AS v FROM embeddings WHERE vec_id IS NOT NULL GROUP BY vec_id),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, round(list_dot_product(a.v, b.v), 9) AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, neighbor_id, score FROM r WHERE rank <= 10
"""

SQL: dict[str, str] = {
    "op1_license_scan": license_scan.sql(),
    "op3_ngram_jaccard_join": ngram_join.sql(),
    "op4_harmonic_packing": harmonic.SQL.format(docs="documents"),
    "op7_line_dedup": line_dedup.SQL.format(docs="documents"),
    "op10_exact_topk": _TOPK_SQL,
}
