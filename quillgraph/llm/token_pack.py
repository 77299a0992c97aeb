r"""Operator 2: token ids packed by best fit decreasing, in binary rows.

Texts are encoded with a byte-level BPE vocabulary (a tiktoken rank file; its path is a parameter) and closed with the
end-of-text id. A document longer than the sequence length is split without loss into full sequences and a rest. The pieces
of a pool of documents are packed by best fit decreasing: longest first, each into the fullest sequence that still has room,
found in a segment tree over free capacities.

Every task packs the rows it read on its own, in pools of about POOL_TOKENS tokens: nothing is shuffled, memory is bounded, and each pool
leaves only a few sequences that aren't full. The same input splits give the same rows.

One row is one sequence of the packed id matrix: ``input_ids`` and ``position_ids`` hold ``seq_len`` little-endian numbers
(``id_bytes`` bytes each), padded with the end-of-text id and position 0; ``cu_seqlens`` holds the cumulative segment lengths, from 0 to ``used``; positions start at 0 in every segment.
``doc_ids`` and ``doc_starts`` say which document and which token of it a segment begins with, so that every document can be put together again.

Defined results: pieces of one length are packed in the order of their documents; a NULL text yields nothing; an empty text yields its end-of-text id; a NULL doc_id is kept as NULL in doc_ids;
repeated rows are packed each; an empty table gives no sequences; further columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern of the vocabulary's tokenizer, in the equal form without backtracking into runs.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
LONG = 1024
_RUN = re.compile(f"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG},}}")
END_OF_TEXT = 50256
SEQ_LEN = 2048
POOL_TOKENS = 1 << 21
SCHEMA = "input_ids binary, position_ids binary, id_bytes int, used int, cu_seqlens array<int>, doc_ids array<long>, doc_starts array<int>"


class Encoder:
    """Encodes whole texts. A run of LONG or more white-space characters, for which the tokenizer's regular expression would run out of stack, is one match
    by itself, but for its last character if a word follows, which the match behind begins with."""

    def __init__(self, ranks: dict[bytes, int], end: int = END_OF_TEXT) -> None:
        import tiktoken

        # a special token that is never allowed: with none the library looks for an empty text at every place
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={"<|end|>": max(max(ranks.values()), end) + 1})
        self.dtype = np.dtype("<u2" if max(max(ranks.values()), end) < 1 << 16 else "<u4")
        self.end = np.array([end], np.uint32)

    def parts(self, text: str) -> Iterator[np.ndarray]:
        begin = 0
        for run in _RUN.finditer(text) if len(text) >= LONG else ():
            stop = run.end() if run.end() == len(text) else run.end() - 1
            yield self.plain(text[begin : run.start()])
            yield np.array(self.bpe._encode_single_piece(text[run.start() : stop]), np.uint32)
            begin = stop
        yield self.plain(text[begin:] if begin else text)

    def plain(self, text: str) -> np.ndarray:
        return self.bpe.encode_to_numpy(text, disallowed_special=()) if text else np.empty(0, np.uint32)

    def __call__(self, text: str) -> np.ndarray:
        return np.concatenate([*self.parts(text), self.end]).astype(self.dtype)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Capacities:
    """Open bins by free capacity, with a segment tree that finds the least capacity that is large enough."""

    def __init__(self, most: int) -> None:
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, free: int, b: int) -> None:
        self.bins[free].append(b)
        i = self.size + free
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, bin) of the fullest bin with room for need; the latest of equals."""
        count, i = self.count, self.size + need
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        free = i - self.size
        b = self.bins[free].pop()
        while i:
            count[i] -= 1
            i >>= 1
        return free, b


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers, none over capacity; pieces by falling length, equals by number."""
    tree, bins = Capacities(capacity), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.take(n)
        if found is None:
            bins.append([])
            found = capacity, len(bins) - 1
        free, b = found
        bins[b].append(i)
        if free > n:
            tree.add(free - n, b)
    return bins


def sequences(docs: list[tuple[int | None, np.ndarray]], seq_len: int, end: int) -> pa.RecordBatch:
    """Packs one pool."""
    pieces = [(d, at, ids[at : at + seq_len]) for d, ids in docs for at in range(0, len(ids), seq_len)]
    dtype = docs[0][1].dtype
    bins = best_fit(np.array([len(p[2]) for p in pieces]), seq_len)
    rows: list[list] = [[] for _ in range(7)]
    whole = np.arange(seq_len, dtype="<u4")
    for b in bins:
        parts = [pieces[i] for i in b]
        lengths = [len(p[2]) for p in parts]
        cu = np.concatenate(([0], np.cumsum(lengths)))
        used = int(cu[-1])
        ids = np.full(seq_len, end, dtype)
        ids[:used] = np.concatenate([p[2] for p in parts])
        pos = np.zeros(seq_len, dtype)
        pos[:used] = whole[:used] - np.repeat(cu[:-1], lengths)
        for column, value in zip(rows, (ids.tobytes(), pos.tobytes(), dtype.itemsize, used, cu.tolist(), [p[0] for p in parts], [p[1] for p in parts])):
            column.append(value)
    types = (pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=["input_ids", "position_ids", "id_bytes", "used", "cu_seqlens", "doc_ids", "doc_starts"])


def pack_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, seq_len: int = SEQ_LEN, end: int = END_OF_TEXT, pool_tokens: int = POOL_TOKENS) -> DataFrame:
    """One row for each packed sequence (see above). The vocabulary is read on the driver and sent to the executors."""
    if not 0 < seq_len < 1 << 16:
        raise ValueError("seq_len must fit in 16 bits")
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(ranks.value, end)
        pool: list[tuple[int | None, np.ndarray]] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py())
                pool.append((doc_id, ids))
                held += len(ids)
                if held >= pool_tokens:
                    yield sequences(pool, seq_len, end)
                    pool, held = [], 0
        if pool:
            yield sequences(pool, seq_len, end)

    return docs.where(docs["text"].isNotNull()).select(docs["doc_id"].cast("long"), "text").mapInArrow(run, SCHEMA)


def unpack(rows: list[dict]) -> dict[int | None, np.ndarray]:
    """The documents' ids again, with their end-of-text ids; for documents with unique ids."""
    parts: dict[int | None, list[tuple[int, np.ndarray]]] = {}
    for r in rows:
        ids = np.frombuffer(r["input_ids"], "<u2" if r["id_bytes"] == 2 else "<u4")
        for d, start, a, b in zip(r["doc_ids"], r["doc_starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            parts.setdefault(d, []).append((start, ids[a:b]))
    return {d: np.concatenate([x for _, x in sorted(p, key=lambda y: y[0])]) for d, p in parts.items()}
