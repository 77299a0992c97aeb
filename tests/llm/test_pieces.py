import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillgraph.llm import pieces


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(pieces.MODEL)


def best_score(p, text):
    """Plain search over all segmentations."""
    best = [0] + [pieces.LOW] * len(text)
    for s in range(len(text)):
        for n, score, _ in p.options(text, s, len(text)):
            best[s + n] = max(best[s + n], best[s] + score)
    return best[-1]


def chunked(e, text, chunk):
    parts = [(text[at : at + min(chunk, len(text) - at) + e.p.longest - 1], min(chunk, len(text) - at)) for at in range(0, len(text), chunk)]
    states = pieces.boundary_states([e.transfer(t, n) for t, n in parts])
    got = [e.trace(t, n, i, j) for (t, n), i, j in zip(parts, states, states[1:])]
    return np.concatenate([x for x, _ in got]), sum(s for _, s in got)


@given(st.text(alphabet="aabcdetheinr   \nñé▁x€", max_size=50), st.sampled_from([3, 7, 20, 64]))
@settings(max_examples=150, deadline=None)
def test_chunks_reach_the_best_score(text, chunk):
    e = _held()
    text = " " + text
    want = best_score(e.p, text)
    raw, score = e.units(text)
    assert score == want and e.p.decode(np.frombuffer(raw, np.int32)) == text
    ids, score = chunked(e, text, chunk)
    assert score == want and e.p.decode(ids) == text


def _held(kept=[]):  # noqa: B006
    if not kept:
        kept.append(pieces.Encoder(pieces.Pieces(pieces.MODEL)))
    return kept[0]


def test_product_is_associative():
    rng = np.random.default_rng(0)
    a, b, c = (rng.integers(-100, 0, (5, 5)) for _ in range(3))
    assert (pieces.product(pieces.product(a, b), c) == pieces.product(a, pieces.product(b, c))).all()
    m = [rng.integers(-100, 0, (4, 4)) for _ in range(7)]
    one = m[0]
    for x, got in zip(m[1:], pieces.scan(m)[1:]):
        one = pieces.product(one, x)
        assert (one == got).all()


def test_encode_and_decode(spark, docs):
    texts = [(1, "Plain words here"), (2, ""), (3, None), (4, "giant " * 80 + "x" * 300 + " é€▁ tail"), (5, "unbroken" * 60), (None, "no id"), (6, "  two  spaces \n"), (6, "  two  spaces \n")]
    rows = pieces.encode(docs(texts), chunk=64).collect()
    assert all(r.exact for r in rows) and len([r for r in rows if r.doc_id == 4]) > 5
    one = pieces.encode(docs([t for t in texts if t[0] != 6]), chunk=64)
    back = {r.doc_id: r.text for r in pieces.decode(one).collect()}
    assert back == {i: t for i, t in texts if t is not None and i != 6}
    e = _held()
    for i, t in texts:
        if t is not None and i not in (None, 6):
            assert sum(r.score for r in rows if r.doc_id == i) == best_score(e.p, " " + t)
    assert pieces.encode(docs([])).count() == 0
