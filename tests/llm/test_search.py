import inspect

import numpy as np
import pytest

from quillgraph.llm import registry, topk, vptree

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec int, q_tile int"


def brute(vectors, k, euclid):
    ids = sorted(vectors)
    out = {}
    for i in ids:
        score = {j: (float(np.sqrt(((vectors[i] - vectors[j]) ** 2).sum())) if euclid else -float(vectors[i] @ vectors[j])) for j in ids if j != i}
        out[i] = sorted(((round(s, 9), j) for j, s in score.items()))[:k]
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    v = {i: np.float32(x).astype(float) for i, x in enumerate(rng.normal(size=(300, 6)))}
    v[300], v[301] = v[0].copy(), v[0].copy()
    rows = [(i, [float(y) for y in x], 0, "a", 1, 2) for i, x in v.items()]
    rows += [(None, [1.0] * 6, 0, "a", 1, 2), (900, None, 0, "a", 1, 2), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0, "a", 1, 2), (902, [1.0], 0, "a", 1, 2), (903, [float("nan")] * 6, 0, "a", 1, 2)]
    return v, spark.createDataFrame(rows, SCHEMA)


def listed(df, value):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r[value], r.neighbor_id))
    return out


def test_exact_topk(vectors, monkeypatch):
    v, df = vectors
    monkeypatch.setattr(topk, "STRIP", 100)
    monkeypatch.setattr(topk, "TILE_BYTES", 6 * 8 * 20)  # 16 tiles: the lists of 16 tiles are merged, and tiles differ in size
    monkeypatch.setattr(topk, "FAN_IN", 4)
    got = listed(topk.exact_topk(df, df, 5), "score")
    want = brute(v, 5, False)
    assert {i: [(pytest.approx(-s, abs=1e-9), j) for s, j in x] for i, x in want.items()} == got
    cosine = listed(topk.exact_topk(df, df, 1, cosine=True), "score")
    assert cosine[0] == [(1.0, 300)] and cosine[300] == [(1.0, 0)]


def test_vptree_is_exact_at_factor_one(vectors, monkeypatch):
    v, df = vectors
    monkeypatch.setattr(topk, "TILE_BYTES", 6 * 8 * 100)
    monkeypatch.setattr(vptree, "LEAF", 8)
    want = brute(v, 5, True)
    got = listed(vptree.ann(df, df, 5, 1.0), "distance")
    assert {i: [(pytest.approx(s, abs=1e-9), j) for s, j in x] for i, x in want.items()} == got
    rough = listed(vptree.ann(df, df, 5, 1.5), "distance")
    hits = sum(len({j for _, j in want[i]} & {j for _, j in rough[i]}) for i in want)
    assert hits >= 0.9 * 5 * len(want)


def test_pruning_saves_work():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(4096, 3))
    order, vantage, radius = vptree.build(points)
    seen = []
    for factor in (1.0, 3.0):
        s = vptree.Search(np.arange(4096), points, order, points[order], vantage, radius, 5, factor)
        s.lists()
        seen.append(s.visited)
    assert seen[1] < seen[0] < 0.5 * 4096**2


@pytest.mark.parametrize("dim", [2, 4, 8, 16])
def test_recall_of_the_default_factor(dim):
    """Vectors of 64 numbers and low intrinsic dimension, of which the tree prunes a good part."""
    rng = np.random.default_rng(dim)
    points = rng.normal(size=(4096, dim)) @ np.linalg.qr(rng.normal(size=(64, dim)))[0].T
    order, vantage, radius = vptree.build(points)
    s = vptree.Search(np.arange(150), points[:150], order, points[order], vantage, radius, 10, inspect.signature(vptree.ann).parameters["factor"].default)
    rows, found, _ = s.lists()
    d = np.sqrt(((points[:150, None] - points[None]) ** 2).sum(axis=2))
    d[np.arange(150), np.arange(150)] = np.inf
    want = np.argsort(d, axis=1)[:, :10]
    hits = sum(len(set(found[rows == i]) & set(want[i])) for i in range(150))
    assert hits >= 0.95 * want.size and s.visited < 0.9 * 150 * 4096


def test_few_rows_and_empty_tables(spark, vectors):
    _, df = vectors
    for search in (topk.exact_topk, vptree.ann):
        assert search(df.limit(0), df.limit(0), 3).count() == 0
        two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
        assert {(r.query_id, r.neighbor_id) for r in search(two, two, 3).collect()} == {(1, 2), (2, 1)}
        assert search(two, two.limit(0), 3).count() == 0


def test_repeated_ids_count_once(spark):
    rows = [(1, [0.0, 1.0]), (1, [-1.0, 1.0]), (1, [-1.0, 2.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 0.5]), (5, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = {1: np.array([-1.0, 1.0]), 2: np.array([1.0, 1.0]), 3: np.array([0.0, 0.5]), 5: np.array([2.0, 2.0])}
    want = brute(v, 3, False)
    assert listed(topk.exact_topk(df, df, 3), "score") == {i: [(-s + 0.0, j) for s, j in x] for i, x in want.items()}
    assert listed(vptree.ann(df, df, 3, 1.0), "distance") == brute(v, 3, True)


@pytest.mark.parametrize("name", ["op9_ann_vptree", "op10_exact_topk"])
def test_registered_queries_against_brute_force(spark, name):
    folder = "/root/testdata/sf0.001"
    given = {r.vec_id: np.array(r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    euclid = name.startswith("op9")
    got = listed(registry.QUERIES[name](spark, folder), "distance" if euclid else "score")
    want = {i: x for i, x in brute(given, 10, euclid).items() if i % 100 == 0}
    assert set(got) == set(want) and all(len(x) == 10 for x in got.values())
    hits = sum(len({j for _, j in want[i]} & {j for _, j in got[i]}) for i in want)
    assert hits >= (0.9 if euclid else 1) * 10 * len(want)
