import hashlib
import re

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from quillgraph.llm import harmonic, token_pack


def test_harmonic_bins(docs):
    pairs = [(i, "w " * n) for i, n in enumerate([10, 10, 5, 5, 5, 4, 1, 25, 0, 3])] + [(None, "w w"), (50, None), (51, "\n \t"), (3, "w " * 5)]
    rows = harmonic.pack(docs(pairs), capacity=10).collect()
    bins = {}
    for r in rows:
        assert r["class"] == (10 // r.length if r.length else 0)
        if r["class"]:
            bins.setdefault((r.shard, r["class"], r.bin), []).append(r)
    for (_, k, _), members in bins.items():
        assert len(members) <= k and sum(m.length for m in members) <= 10 and sorted(m.slot for m in members) == list(range(len(members)))
    long = sorted((r.start, r.length) for r in rows if r.doc_id == 7)
    assert long == [(0, 10), (10, 10), (20, 5)]
    assert [r.bin for r in rows if r.doc_id in (8, 51)] == [-1, -1] and not [r for r in rows if r.doc_id == 50]
    fives = [r for r in rows if r["class"] == 2]
    assert len(fives) == 6 and len({r.bin for r in fives}) == 3  # lengths 5 and 4, two to a bin
    assert harmonic.pack(docs([])).count() == 0
    again = harmonic.pack(docs(pairs).repartition(5), capacity=10).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_harmonic_shards(docs):
    rows = harmonic.pack(docs([(i, "w w") for i in range(30)]), capacity=4, shard_rows=10).collect()
    of = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 3 for i in range(30)}
    assert {r.doc_id: r.shard for r in rows} == of
    for s in range(3):
        own = sorted(i for i in of if of[i] == s)
        assert [(r.bin, r.slot) for i in own for r in rows if r.doc_id == i] == [(k // 2, k % 2) for k in range(len(own))]
    same = harmonic.pack(docs([(3 * i, "w") for i in range(60)] + [(None, f"w {i}") for i in range(60)]), shard_rows=40).collect()
    assert {r.shard for r in same if r.doc_id is None} == {r.shard for r in same if r.doc_id is not None} == {0, 1, 2}


@given(st.lists(st.integers(1, 20), max_size=60), st.just(20))
@settings(max_examples=60, deadline=None)
def test_best_fit_decreasing(lengths, capacity):
    """Against a plain search of all bins."""
    bins = token_pack.best_fit(np.array(lengths, int), capacity)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(capacity - n)
    assert sorted(capacity - sum(lengths[i] for i in b) for b in bins) == sorted(free)


TEXTS = [(1, "Hello  world, it's me.\nNew line"), (2, ""), (3, "x " * 300), (4, None), (None, "no id"), (5, "tab\tand  é  \n \n end "), (6, "a" * 500), (7, " lead")]


def test_token_packing_round_trip(docs):
    full = tiktoken.Encoding("t", pat_str=OLD, mergeable_ranks=token_pack.read_ranks(token_pack.VOCABULARY), special_tokens={})
    rows = [r.asDict() for r in token_pack.pack_tokens(docs(TEXTS), seq_len=64).collect()]
    got = token_pack.unpack(rows)
    want = {i: [*full.encode_ordinary(t), token_pack.END_OF_TEXT] for i, t in TEXTS if t is not None}
    assert {i: x.tolist() for i, x in got.items()} == want
    for r in rows:
        ids, pos = np.frombuffer(r["input_ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2")
        assert len(ids) == len(pos) == 64 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["used"] <= 64
        for a, b in zip(r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert pos[a:b].tolist() == list(range(b - a))
        assert (ids[r["used"] :] == token_pack.END_OF_TEXT).all() and not pos[r["used"] :].any()
    assert token_pack.pack_tokens(docs([])).count() == 0


OLD = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@given(st.text(alphabet="ab '.,1\n\t é\u2003 '", max_size=40))
@settings(max_examples=300, deadline=None)
def test_long_runs_of_white_space_change_nothing(text):
    encode, plain = _encoders()
    assert encode(text)[:-1].tolist() == plain(text)
    run, long = token_pack._RUN, token_pack.LONG
    try:
        token_pack._RUN, token_pack.LONG = re.compile(run.pattern.replace("1024", "2")), 2
        assert encode(text)[:-1].tolist() == plain(text)
    finally:
        token_pack._RUN, token_pack.LONG = run, long


def _encoders(held=[]):  # noqa: B006
    if not held:
        ranks = token_pack.read_ranks(token_pack.VOCABULARY)
        held += [token_pack.Encoder(ranks), tiktoken.Encoding("t", pat_str=OLD, mergeable_ranks=ranks, special_tokens={}).encode_ordinary]
    return held


def test_very_long_runs():
    encode, plain = _encoders()
    for text in (" " * 500_000 + "x", "a" * 500_000, "x" + "\n \t" * 200_000, "?!" * 100_000):
        assert encode.bpe.decode(encode(text)[:-1].tolist()) == text
    assert encode("a<|end|>b<|endoftext|>")[:-1].tolist() == plain("a<|end|>b<|endoftext|>")


def test_pools_are_packed_each(docs):
    """Every sequence holds pieces of one pool only, and a pool isn't larger than its bound and one document."""
    pairs = [(i, "word " * (i * 7 % 40)) for i in range(200)]
    frame = docs(pairs).coalesce(1)
    encode, _ = _encoders()
    lengths = {i: len(encode(t)) for i, t in pairs}
    rows = [r.asDict() for r in token_pack.pack_tokens(frame, seq_len=64, pool_tokens=300).collect()]
    assert {i: len(x) for i, x in token_pack.unpack(rows).items()} == lengths
    pools, held = [[]], 0
    for i, _ in pairs:
        pools[-1].append(i)
        held += lengths[i]
        if held >= 300:
            pools.append([])
            held = 0
    of = {i: k for k, p in enumerate(pools) for i in p}
    assert all(len({of[d] for d in r["doc_ids"]}) == 1 for r in rows) and len(pools) > 5
    for k, p in enumerate(pools):
        pieces = np.array([n for i in p for n in [64] * (lengths[i] // 64) + [lengths[i] % 64] if n])
        got = sorted(r["used"] for r in rows if of[r["doc_ids"][0]] == k)
        assert got == sorted(int(pieces[b].sum()) for b in token_pack.best_fit(pieces, 64))


def test_bad_length(docs):
    with pytest.raises(ValueError):
        token_pack.pack_tokens(docs([]), seq_len=0)
