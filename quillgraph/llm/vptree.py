"""Operator 9: approximate nearest neighbours by vantage-point trees, one tree for each shard of the base.

A tree halves its shard again and again at the median distance from a vantage point. A search goes down the nearer half
first and visits the other one only if ``|d - radius| <= worst / factor``, where worst is the distance of the k-th best so
far. By the triangle inequality factor 1 loses nothing; a larger factor prunes more and may lose neighbours. Queries go
through a tree together: a node handles all queries that reach it with one matrix product.

Every query meets every shard; the lists of the shards are merged in a tree (see topk). Trees are built
once for a shard and travel with it.

Defined results: Euclidean distance rounded to 9 decimals, ties by id; a row is not its own neighbour; rows that can't be
compared are left out and of rows with one id one counts, both as in topk; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.topk import DECIMALS, _LISTS, best, list_batch, matrix, merged, tile_counts, tiled, usable

LEAF = 256
FACTOR = 2.0  # 4 falls under a recall of 0.9 on vectors of low intrinsic dimension
BLOCK = 1024
_NODE = "b_tile int, b_tile_ids array<long>, b_tile_vecs array<double>, vantage array<int>, radius array<double>"


def build(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the points, vantage points, radii); node i has the children 2i+1 (inside) and 2i+2, by halves of the order."""
    order = np.arange(len(points))
    vantage: dict[int, int] = {}
    radius: dict[int, float] = {}
    todo = [(0, 0, len(points))]
    while todo:
        node, lo, hi = todo.pop()
        if hi - lo <= LEAF:
            continue
        part = order[lo:hi]
        centre = points[part].mean(axis=0)
        v = part[np.argmax(((points[part] - centre) ** 2).sum(axis=1))]  # a point at the rim cuts better than one inside
        d = np.sqrt(((points[part] - points[v]) ** 2).sum(axis=1))
        by = np.argsort(d, kind="stable")
        mid = (hi - lo) // 2
        order[lo:hi] = part[by]
        vantage[node], radius[node] = int(v), float((d[by[mid - 1]] + d[by[mid]]) / 2)
        todo += [(2 * node + 1, lo, lo + mid), (2 * node + 2, lo + mid, hi)]
    size = max(vantage, default=-1) + 1
    v, r = np.full(size, -1, dtype=np.int32), np.zeros(size)
    for node, x in vantage.items():
        v[node], r[node] = x, radius[node]
    position = np.empty(len(order), dtype=np.int32)
    position[order] = np.arange(len(order), dtype=np.int32)
    v[v >= 0] = position[v[v >= 0]]
    return order, v, r


class Search:
    """One block of queries in one tree. Points are in the tree's order."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, points: np.ndarray, vantage: np.ndarray, radius: np.ndarray, k: int, factor: float) -> None:
        self.q_ids, self.q, self.ids, self.points, self.vantage, self.radius, self.k, self.factor = q_ids, q, ids, points, vantage, radius, k, factor
        self.q2, self.p2 = (q**2).sum(axis=1), (points**2).sum(axis=1)
        self.dist = np.full((len(q), k), np.inf)
        self.near = np.full((len(q), k), np.iinfo(np.int64).max)
        self.visited = 0

    def leaf(self, rows: np.ndarray, lo: int, hi: int) -> None:
        self.visited += len(rows) * (hi - lo)
        d2 = self.q2[rows, None] + self.p2[None, lo:hi] - 2 * (self.q[rows] @ self.points[lo:hi].T)
        d = np.sqrt(np.maximum(d2, 0))
        d[self.q_ids[rows, None] == self.ids[None, lo:hi]] = np.inf
        worst = self.dist[rows, -1] + 1e-9
        open_ = np.flatnonzero(np.isinf(worst))
        if len(open_) and d.shape[1] > self.k:
            worst[open_] = np.partition(d[open_], self.k - 1, axis=1)[:, self.k - 1]
        r, c = np.nonzero((d <= worst[:, None]) & np.isfinite(d))
        if not len(r):
            return
        hit = np.unique(r)
        old_row, old_slot = np.nonzero(np.isfinite(self.dist[rows[hit]]))
        old_row = hit[old_row]
        row, found, minus = best(
            np.concatenate([r, old_row]),
            np.concatenate([self.ids[lo + c], self.near[rows[old_row], old_slot]]),
            -np.concatenate([d[r, c], self.dist[rows[old_row], old_slot]]),
            self.k,
        )
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        slot = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
        self.dist[rows[row], slot] = -minus
        self.near[rows[row], slot] = found

    def go(self, rows: np.ndarray, node: int, lo: int, hi: int) -> None:
        if not len(rows):
            return
        if hi - lo <= LEAF:
            self.leaf(rows, lo, hi)
            return
        v, mid = self.vantage[node], lo + (hi - lo) // 2
        d = np.sqrt(np.maximum(self.q2[rows] + self.p2[v] - 2 * (self.q[rows] @ self.points[v]), 0))
        gap = d - self.radius[node]
        inside = gap < 0
        halves = ((2 * node + 1, lo, mid), (2 * node + 2, mid, hi))
        self.go(rows[inside], *halves[0])
        self.go(rows[~inside], *halves[1])
        open_ = np.abs(gap) <= self.dist[rows, -1] / self.factor + 1e-7
        self.go(rows[inside & open_], *halves[1])
        self.go(rows[~inside & open_], *halves[0])

    def lists(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """With distances computed anew by differences: those by products lose digits near 0."""
        self.go(np.arange(len(self.q)), 0, 0, len(self.points))
        row, slot = np.nonzero(np.isfinite(self.dist))
        found = self.near[row, slot]
        by = np.argsort(self.ids, kind="stable")
        at = by[np.searchsorted(self.ids[by], found)]
        exact = np.sqrt(((self.q[row] - self.points[at]) ** 2).sum(axis=1))
        return self.q_ids[row], found, -np.round(exact, DECIMALS)


def ann(queries: DataFrame, base: DataFrame, k: int = 10, factor: float = FACTOR, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, neighbor_id, distance) of every query."""
    q_tiles, b_tiles, dim = tile_counts(queries, base, vec_col)
    q, b = usable(queries, id_col, vec_col, dim), usable(base, id_col, vec_col, dim)

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, points = matrix(batch, i, "b_tile", dim)
                order, vantage, radius = build(points)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("b_tile").slice(i, 1), *(pa.array([x], t) for x, t in ((ids[order], pa.list_(pa.int64())), (points[order].ravel(), pa.list_(pa.float64())), (vantage, pa.list_(pa.int32())), (radius, pa.list_(pa.float64()))))],
                    names=["b_tile", "b_tile_ids", "b_tile_vecs", "vantage", "radius"],
                )

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, qs = matrix(batch, i, "q_tile", dim)
                ids, points = matrix(batch, i, "b_tile", dim)
                vantage, radius = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("vantage", "radius"))
                found = [Search(q_ids[at : at + BLOCK], qs[at : at + BLOCK], ids, points, vantage, radius, k, factor).lists() for at in range(0, len(qs), BLOCK)]
                lists = tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
                yield list_batch(batch.column("q_tile")[i].as_py(), batch.column("b_tile")[i].as_py(), best(*lists, k))

    left = tiled(q, q_tiles, "q_tile").withColumn("b_tile", F.explode(F.sequence(F.lit(0), F.lit(b_tiles - 1))))
    pairs = left.join(tiled(b, b_tiles, "b_tile").mapInArrow(trees, _NODE).hint("shuffle_hash"), "b_tile")
    return merged(pairs.mapInArrow(cells, _LISTS), b_tiles, k).select("query_id", "rank", "neighbor_id", (-F.col("score") + 0.0).alias("distance"))
