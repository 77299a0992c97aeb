"""Operator 10: exact top-k search by tiled matrix products.

Queries and base vectors are cut into tiles by the hash of their id: of up to TILE_BYTES, and not under LEAST_BYTES while there are fewer tiles
than partitions. Each pair of tiles is a float64 matrix product in strips of about STRIP scores, a partial selection of the best k of each row, and a
list of k for each query. The lists of one query tile are merged in a tree of fixed fan-in, so no task reads more than ``FAN_IN`` lists, whatever the
number of tiles. What is shuffled of a query tile is a copy for every base tile; a pair of full tiles is 64 MB for 5 * 10^11 operations (64 numbers).

Defined results: score is the inner product (or cosine), rounded to 9 decimals; order is score descending, then id
ascending; a row is never its own neighbour (equal ids); rows with a NULL id, NULL vector, a NULL, NaN or infinite component or
another length than ``dim`` are left out on both sides; of rows with one id the one with the least vector (by its first number, then the next) counts,
on both sides; fewer than k base rows give fewer neighbours; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import fitting_partitions

TILE_BYTES = 32 << 20
LEAST_BYTES = 2 << 20
FAN_IN = 16
STRIP = 1 << 22
DECIMALS = 9
_LISTS = "q_tile int, part int, q binary, ids binary, scores binary"


def usable(df: DataFrame, id_col: str, vec_col: str, dim: int | None) -> DataFrame:
    """(id, vec) of the rows that can be compared."""
    v = F.col("vec")
    good = F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).where(good)
    return out.where(F.size("vec") == dim) if dim else out


def shape(df: DataFrame, vec_col: str, dim: int | None = None) -> tuple[int, int]:
    """(length, rows): the length of the most vectors, the larger one of equals, or dim; and how many vectors have it. 0, 0 for none. Counted over all rows."""
    sizes = df.where(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("n")).count()
    top = (sizes if dim is None else sizes.where(F.col("n") == dim)).orderBy(F.desc("count"), F.desc("n")).head()
    return (top["n"], top["count"]) if top else (dim or 0, 0)


def tiled(df: DataFrame, tiles: int, name: str) -> DataFrame:
    """One row a tile: (name, <name>_ids, <name>_vecs)."""
    return (
        df.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int"))
        .groupBy(name)
        .agg(F.collect_list(F.struct("id", "vec")).alias("rows"))
        .select(name, F.col("rows.id").alias(f"{name}_ids"), F.flatten("rows.vec").alias(f"{name}_vecs"))
    )


def tile_count(rows: int, dim: int, partitions: int) -> int:
    size = rows * max(dim, 1) * 8
    return max(1, math.ceil(size / TILE_BYTES), min(math.ceil(size / LEAST_BYTES), partitions))


def matrix(batch: pa.RecordBatch, i: int, name: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """A tile's ids, each once, and their vectors. Rows of one id are always in one tile."""
    ids = batch.column(f"{name}_ids")[i].values.to_numpy(zero_copy_only=False)
    vecs = batch.column(f"{name}_vecs")[i].values.to_numpy(zero_copy_only=False).reshape(-1, dim)
    order = np.argsort(ids, kind="stable")
    again = ids[order[1:]] == ids[order[:-1]]
    if again.any():
        several = np.isin(ids, ids[order[1:]][again])
        some = np.flatnonzero(several)
        some = some[np.lexsort((*vecs[some].T[::-1], ids[some]))]
        first = some[np.r_[True, ids[some][1:] != ids[some][:-1]]]
        keep = np.concatenate([np.flatnonzero(~several), first])
        ids, vecs = ids[keep], vecs[keep]
    return ids, vecs


def best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row number, by score descending and id ascending."""
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    first = np.r_[True, rows[1:] != rows[:-1]] if len(rows) else np.empty(0, bool)
    start = np.flatnonzero(first)
    rank = np.arange(len(rows)) - np.repeat(start, np.diff(np.r_[start, len(rows)]))
    keep = rank < k
    return rows[keep], ids[keep], scores[keep]


def product_lists(q_ids: np.ndarray, q: np.ndarray, b_ids: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best base rows of one tile for each query of another: (query ids, base ids, scores)."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    strip = max(1, STRIP // max(1, len(b)))
    for at in range(0, len(q), strip):
        s = q[at : at + strip] @ b.T
        s[q_ids[at : at + strip, None] == b_ids[None, :]] = -np.inf
        n = s.shape[1]
        cut = np.full(len(s), -np.inf) if n <= k else -np.partition(-s, k - 1, axis=1)[:, k - 1]
        row, col = np.nonzero((s >= (cut - 2 * 10.0**-DECIMALS)[:, None]) & (s > -np.inf))
        r, ids, scores = best(row, b_ids[col], np.round(s[row, col], DECIMALS) + 0.0, k)
        out.append((q_ids[at + r], ids, scores))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def list_batch(q_tile: int, part: int, lists: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([q_tile], pa.int32()), pa.array([part], pa.int32()), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in lists)],
        names=["q_tile", "part", "q", "ids", "scores"],
    )


def merged(lists: DataFrame, parts: int, k: int) -> DataFrame:
    """Merges the lists of each query tile in a tree; one row for each neighbour."""

    def merge(table: pa.Table) -> pa.Table:
        q, ids, scores = (np.concatenate([np.frombuffer(x.as_py(), dtype=t) for x in table.column(c)]) for c, t in (("q", np.int64), ("ids", np.int64), ("scores", np.float64)))
        return pa.Table.from_batches([list_batch(table.column("q_tile")[0].as_py(), table.column("part")[0].as_py(), best(q, ids, scores, k))])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q, ids, scores = (np.frombuffer(batch.column(c)[i].as_py(), dtype=t) for c, t in (("q", np.int64), ("ids", np.int64), ("scores", np.float64)))
                q, ids, scores = best(q, ids, scores, k)
                start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.empty(0, np.int64)
                rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)])) + 1
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(rank.astype(np.int32)), pa.array(ids), pa.array(scores)], names=["query_id", "rank", "neighbor_id", "score"])

    while parts > 1:
        parts = math.ceil(parts / FAN_IN)
        lists = lists.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("q_tile", "part").applyInArrow(merge, _LISTS)
    return lists.mapInArrow(unpack, "query_id long, rank int, neighbor_id long, score double")


def tile_pairs(queries: DataFrame, base: DataFrame, q_tiles: int, b_tiles: int) -> DataFrame:
    """One row for each pair of tiles, with both matrices, spread over as many tasks as there are pairs."""
    left = tiled(queries, q_tiles, "q_tile").withColumn("b_tile", F.explode(F.sequence(F.lit(0), F.lit(b_tiles - 1))))
    return left.join(tiled(base, b_tiles, "b_tile").hint("shuffle_hash"), "b_tile")


def tile_counts(queries: DataFrame, base: DataFrame, vec_col: str) -> tuple[int, int, int]:
    """(tiles of queries, tiles of base, length of the vectors)"""
    partitions = fitting_partitions(base.sparkSession)
    dim, rows = shape(base, vec_col)
    return tile_count(shape(queries, vec_col, dim)[1], dim, partitions), tile_count(rows, dim, partitions), dim


def exact_topk(queries: DataFrame, base: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", cosine: bool = False) -> DataFrame:
    """(query_id, rank, neighbor_id, score): the k base rows of largest inner product for every query row."""
    q_tiles, b_tiles, dim = tile_counts(queries, base, vec_col)
    q, b = usable(queries, id_col, vec_col, dim), usable(base, id_col, vec_col, dim)
    if cosine:
        unit = F.expr("transform(vec, x -> x / sqrt(aggregate(vec, 0D, (a, y) -> a + y * y)))")
        q, b = (x.where(F.exists("vec", lambda y: y != 0)).withColumn("vec", unit) for x in (q, b))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield list_batch(batch.column("q_tile")[i].as_py(), batch.column("b_tile")[i].as_py(), product_lists(*matrix(batch, i, "q_tile", dim), *matrix(batch, i, "b_tile", dim), k))

    lists = tile_pairs(q, b, q_tiles, b_tiles).mapInArrow(cells, _LISTS)
    return merged(lists, b_tiles, k)
