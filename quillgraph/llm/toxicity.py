"""Operator 6: toxicity by a convolutional text classifier, trained here in numpy.

A word becomes the concatenation of two hashed embeddings, one of the whole word and one of its first PREFIX bytes (so
inflected forms of a stem share a part). Filters of several widths run over the whole text, each filter keeps its largest
activation (max pooling), and a logistic layer gives the score. Thresholds are calibrated by language on rows held out from
training: the middle of the range of best F1; a language with too few held-out rows of either class takes the common threshold.

The classifier is fitted on all labelled rows, after exact and near copies among them are dropped (a toxic text that was copied often would teach its harmless words). They are
written once, as words, in blocks of about BLOCK_ROWS rows or BLOCK_BYTES by the hash of doc_id. In each epoch every block is trained on from the common model, and the mean of what the blocks
changed is the next one; sums are of whole numbers, so the model doesn't depend on tasks. The driver only holds the model and how many held-out rows have each score. Every document is scored, over its
whole text. Half of the filters begin as detectors of words that toxic texts have more often (prior()), counted over all rows; training moves all of them.

Embeddings of words that training never met are zero, so unknown words can't raise a score.

Defined results: a NULL or empty text has the score of a text without words; a NULL or unknown language takes the common
threshold; labels that are NULL or whose document is missing are not used; without labels of both classes nothing is toxic
(score 0); repeated rows are scored each, of texts of one doc_id the one with the least hash is learned from; an empty table gives an empty result; further columns of any name are kept by
filter_toxic().
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillgraph.llm.common import free_names, mix, word_hashes, written
from quillgraph.scratch import discard

BLOCK_ROWS = 3000
BLOCK_BYTES = 16 << 20
BROADCAST_ROWS = 1_000_000
TASKS = 64  # of an epoch, at most: each sends its sums
SEGMENTS = 16
UNIT = 1 << 30
HELD_OUT = 4  # one of so many rows, by the hash of doc_id, is held out for the thresholds
PREFIX = 4
WORDS, PREFIXES, DIM = 1 << 17, 1 << 16, 6
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH, RATE = 8, 64, 0.05
PAD = max(WIDTHS) - 1
BLOCK_WORDS = 1 << 17
MIN_CLASS_ROWS = 5


@dataclass
class Model:
    word: np.ndarray
    prefix: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    offset: float = 0.0
    threshold: float = 2.0
    by_lang: dict[str, float] = field(default_factory=dict)

    def limit(self, lang: str | None) -> float:
        return self.by_lang.get(lang, self.threshold)


def bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word rows, prefix rows, start of each text) of the texts one behind the other, PAD empty places behind each.

    Row 0 of both tables is the empty place.
    """
    data = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    joined = b" ".join(data)
    h, start, _ = word_hashes(joined)
    p, _, _ = word_hashes(joined, PREFIX)
    begins = np.concatenate(([0], np.cumsum([len(d) + 1 for d in data])))
    n = np.diff(np.searchsorted(start, begins))
    at = np.concatenate(([0], np.cumsum(n + PAD)))[:-1]
    where = np.arange(len(h)) + np.repeat(np.arange(len(n)) * PAD, n)
    total = len(h) + PAD * len(n)
    words, prefixes = np.zeros(total, np.int64), np.zeros(total, np.int64)
    words[where] = 1 + (h % np.uint64(WORDS)).astype(np.int64)
    prefixes[where] = 1 + (p % np.uint64(PREFIXES)).astype(np.int64)
    return words, prefixes, at


def convolve(m: Model, words: np.ndarray, prefixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(embedded words, activations of all filters at every place)."""
    x = np.concatenate([m.word[words], m.prefix[prefixes]], axis=1)
    padded = np.concatenate([x, np.zeros((PAD, x.shape[1]), x.dtype)])
    acts, behind = [], np.flatnonzero(words == 0)
    for w in WIDTHS:
        a = np.tile(m.bias[w], (len(x), 1))
        for j in range(w):
            a += padded[j : j + len(x)] @ m.filters[w][j]
        a[behind] = m.bias[w]  # places behind a text see nothing of the next one
        acts.append(a)
    return x, np.maximum(np.concatenate(acts, axis=1), 0)


def scores(m: Model, texts: list[str | None]) -> np.ndarray:
    out = np.empty(len(texts))
    sizes = np.cumsum([len(t or "") // 5 + 1 for t in texts])
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + BLOCK_WORDS)))
        out[lo:hi] = scores_of(m, *bags(texts[lo:hi]))
        lo = hi
    return out


def scores_of(m: Model, words: np.ndarray, prefixes: np.ndarray, at: np.ndarray) -> np.ndarray:
    pooled = np.maximum.reduceat(convolve(m, words, prefixes)[1], at, axis=0)
    return 1 / (1 + np.exp(-np.clip(pooled @ m.out + m.offset, -40, 40)))


def occurrences(words: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """By label and row, the number of texts."""
    counts = np.zeros((2, size))
    for w, label in zip(words, y):
        counts[int(label), np.unique(w)] += 1
    return counts


def prior(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How much more often a row occurs in toxic texts than in others: log odds, shrunk for rare rows, about 0 to 1. n: texts by label."""
    n = np.maximum(1, n)
    odds = np.log((counts[1] + 0.3) / (n[1] + 1)) - np.log((counts[0] + 0.3) / (n[0] + 1))
    weight = counts[1] / (counts[1] + 4)
    return (np.clip(odds, 0, 6) / 6 * weight).astype(np.float32)


class Training:
    """A model that is trained, with the sums of squares that its steps depend on."""

    def __init__(self, counts: tuple[np.ndarray, np.ndarray], n: np.ndarray, seed: int = 7):
        """counts: occurrences() of words and prefixes; n: texts by label."""
        rng = np.random.default_rng(seed)
        d = 2 * DIM
        word = rng.normal(0, 0.02, (WORDS + 1, DIM)).astype(np.float32)
        prefix = rng.normal(0, 0.02, (PREFIXES + 1, DIM)).astype(np.float32)
        for table, own in zip((word, prefix), counts):
            table[:, 0] = prior(own, n)
            table[own.sum(axis=0) == 0] = 0
            table[0] = 0
        m = Model(word, prefix, {w: rng.normal(0, 0.15, (w, d, FILTERS)).astype(np.float32) for w in WIDTHS}, {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}, rng.normal(0.1, 0.1, len(WIDTHS) * FILTERS).astype(np.float32))
        for w in WIDTHS:  # half of the filters begin as detectors of what the prior favours
            for j in range(w):
                m.filters[w][j][[0, DIM], : FILTERS // 2] = 1.0 / w
            m.bias[w][: FILTERS // 2] = -0.5
            m.out[WIDTHS.index(w) * FILTERS :][: FILTERS // 2] = 1.0
        m.offset = -1.0
        self.model, self.weight = m, 0.5 * n.sum() / np.maximum(1, n)
        self.dense = {("f", w): m.filters[w] for w in WIDTHS} | {("b", w): m.bias[w] for w in WIDTHS} | {"out": m.out, "offset": np.array([m.offset], np.float32)}
        self.square = {k: np.full_like(v, 1e-3) for k, v in self.dense.items()}
        self.rows_square = np.full(WORDS + 1, 1e-2, np.float32), np.full(PREFIXES + 1, 1e-2, np.float32)

    def arrays(self) -> list[np.ndarray]:
        """All that training changes: by word, by prefix (two of each), then what is dense."""
        return [self.model.word, self.rows_square[0], self.model.prefix, self.rows_square[1], *self.dense.values(), *self.square.values()]

    def load(self, arrays: list[np.ndarray]) -> None:
        for mine, x in zip(self.arrays(), arrays):
            mine[...] = x
        self.model.offset = float(self.dense["offset"][0])

    def epoch(self, parts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, order: np.ndarray) -> None:
        m, dense, square, rows_square, d = self.model, self.dense, self.square, self.rows_square, 2 * DIM
        weight = self.weight[y]
        for lo in range(0, len(order), BATCH):
            picked = order[lo : lo + BATCH]
            words = np.concatenate([parts[i][0] for i in picked])
            prefixes = np.concatenate([parts[i][1] for i in picked])
            ends = np.cumsum([len(parts[i][0]) for i in picked])
            begins = np.concatenate(([0], ends[:-1]))
            x, acts = convolve(m, words, prefixes)
            top = np.stack([s + acts[s:e].argmax(axis=0) for s, e in zip(begins, ends)])
            pooled = np.take_along_axis(acts, top, axis=0)
            z = pooled @ m.out + dense["offset"][0]
            err = ((1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[picked]) * weight[picked] / len(picked)).astype(np.float32)
            grads = {"out": err @ pooled, "offset": np.array([err.sum()], np.float32)}
            back = err[:, None] * m.out[None, :] * (pooled > 0)
            at_rows, at_grads = [], []
            padded = np.concatenate([x, np.zeros((PAD, d), x.dtype)])
            for i, w in enumerate(WIDTHS):
                g, t = back[:, i * FILTERS : (i + 1) * FILTERS], top[:, i * FILTERS : (i + 1) * FILTERS]
                grads["b", w] = g.sum(axis=0)
                g = g * (words[t] != 0)
                grads["f", w] = np.stack([np.einsum("nfd,nf->df", padded[t + j], g) for j in range(w)])
                for j in range(w):
                    at_rows.append((t + j).ravel())
                    at_grads.append(np.einsum("nf,df->nfd", g, m.filters[w][j]).reshape(-1, d))
            rows, vals = np.concatenate(at_rows), np.concatenate(at_grads)
            inside = rows < len(words)
            rows, vals = rows[inside], vals[inside]
            for table, ids, part, sq in ((m.word, words[rows], vals[:, :DIM], rows_square[0]), (m.prefix, prefixes[rows], vals[:, DIM:], rows_square[1])):
                u, inverse = np.unique(ids, return_inverse=True)
                total = np.zeros((len(u), DIM), np.float32)
                np.add.at(total, inverse, part)
                sq[u] += (total**2).mean(axis=1)
                table[u] -= RATE * total / np.sqrt(sq[u])[:, None]
                table[0] = 0
            for k, g in grads.items():
                square[k] += g**2
                dense[k] -= RATE * g / np.sqrt(square[k])
        m.offset = float(dense["offset"][0])


def train(texts: list[str], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    parts = [bags([t])[:2] for t in texts]
    training = Training((occurrences([p[0] for p in parts], y, WORDS + 1), occurrences([p[1] for p in parts], y, PREFIXES + 1)), np.bincount(y, minlength=2), seed)
    for _ in range(epochs):
        training.epoch(parts, y, rng.permutation(len(parts)))
    return training.model


def cut(s: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """The middle of the range of thresholds of best F1. n: how many rows each stands for."""
    n = np.ones(len(y), np.int64) if n is None else n
    order = np.argsort(-s, kind="stable")
    hits = np.cumsum((y * n)[order])
    f1 = 2 * hits / (np.cumsum(n[order]) + (y * n).sum())
    last = np.r_[s[order][1:] != s[order][:-1], True]
    best = int(np.argmax(np.where(last, f1, -1)))
    low = s[order][best + 1] if best + 1 < len(s) else 0.0
    return float((s[order][best] + low) / 2)


def calibrate(m: Model, s: np.ndarray, y: np.ndarray, langs: list[str | None], n: np.ndarray) -> None:
    if not 0 < (y * n).sum() < n.sum():
        m.threshold = 0.5
        return
    m.threshold = cut(s, y, n)
    by: dict[str, list[int]] = {}
    for i, lang in enumerate(langs):
        if lang is not None:
            by.setdefault(lang, []).append(i)
    for lang, own in by.items():
        if min((y * n)[own].sum(), ((1 - y) * n)[own].sum()) >= MIN_CLASS_ROWS:
            m.by_lang[lang] = cut(s[own], y[own], n[own])


_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def sketch(text: str) -> list[int] | None:
    """Four minima of word triples; None without words."""
    h = word_hashes(text.lower().encode("utf-8", "surrogatepass"))[0]
    triple = h[:-2] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[2:] * np.uint64(7) if len(h) > 2 else h
    if not len(triple):
        return None
    return [int(x) for x in np.array([((triple ^ x) * np.uint64(0xBF58476D1CE4E5B9)).min() for x in _SALTS]).view(np.int64)]


def labelled(docs: DataFrame, labels: DataFrame, rows: int | None = None, most: int | None = None) -> DataFrame:
    """(doc_id, toxic, text, lang): the labelled documents; with rows and most, the first by hash within these bounds."""
    sample = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").distinct()
    if rows is not None:
        sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    small = rows is not None and rows <= BROADCAST_ROWS or sample.count() <= BROADCAST_ROWS
    one = texts.join(F.broadcast(sample) if small else sample, "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "lang")).alias("x"))
    if most is not None:
        size = F.sum(F.octet_length("x.text")).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic"))  # over at most rows rows
        one = one.withColumn("size", size).where(F.col("size") <= most)
    return one.select("doc_id", "toxic", "x.text", "x.lang")


BLOCK = "block int, doc_id binary, toxic binary, lang array<string>, sketch binary, places binary, words binary, prefixes binary"


def blocks_of(docs: DataFrame, labels: DataFrame) -> DataFrame | None:
    """All labelled rows as words, a row a block; written to the shared folder. sketch: four minima a row, of those with words (places > PAD)."""
    rows = written(labelled(docs, labels), "toxicity-rows")
    count, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    if not count:
        discard(rows)
        return None
    parts = max(-(-count // BLOCK_ROWS), -(-size // BLOCK_BYTES))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def block() -> pa.RecordBatch:
            ids, y, langs, sketches, places, words, prefixes = zip(*held)
            raw = [np.array(ids, np.int64), np.array(y, np.int8), np.array(sketches, np.int64), np.array(places, np.int64), np.concatenate(words), np.concatenate(prefixes)]
            a, b, c, d, e, f = (pa.array([x.tobytes()], pa.binary()) for x in raw)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), a, b, pa.array([list(langs)], pa.list_(pa.string())), c, d, e, f], names=[x.split()[0] for x in BLOCK.split(", ")])

        for batch in batches:
            for b, i, y, text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                if b != now and held:
                    yield block()
                    held = []
                now = b
                words, prefixes, _ = bags([text])
                held.append((i, y, lang, sketch(text) or [0] * 4, len(words), words.astype(np.int32), prefixes.astype(np.int32)))
        if held:
            yield block()

    keyed = rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("block"), "doc_id", "toxic", "text", "lang")
    blocks = written(keyed.repartitionById(parts, "block").sortWithinPartitions("block", "doc_id", "toxic").mapInArrow(pack, BLOCK), "toxicity-blocks")
    discard(rows)
    return blocks


def copies_of(blocks: DataFrame) -> DataFrame:
    """(block, gone): by block the places of the rows that are copies of an earlier one, that is have two of its minima; rows are in order of doc_id and label."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                some = np.flatnonzero(np.frombuffer(r["places"], np.int64) > PAD)
                four = np.frombuffer(r["sketch"], np.int64).reshape(-1, 4)[some]
                ids, y = np.frombuffer(r["doc_id"], np.int64)[some], np.frombuffer(r["toxic"], np.int8)[some].astype(np.int32)
                for k in range(4):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), r["block"], np.int32)), pa.array(some.astype(np.int32)), pa.array(ids), pa.array(y), pa.array(np.full(len(some), k, np.int32)), pa.array(np.ascontiguousarray(four[:, k]))], names=["block", "at", "doc_id", "toxic", "k", "least"])

    rows = blocks.select("block", "doc_id", "toxic", "sketch", "places").mapInArrow(unpack, "block int, at int, doc_id long, toxic int, k int, least long")
    first = rows.groupBy("k", "least").agg(F.min(F.struct("doc_id", "toxic")).alias("first"))
    met = rows.join(first, ["k", "least"]).where(F.col("first") < F.struct("doc_id", "toxic"))
    return met.groupBy("block", "at").count().where("count >= 2").groupBy("block").agg(F.collect_list("at").alias("gone"))


class Block:
    """The rows of a block that aren't copies."""

    def __init__(self, r: dict):
        ids = np.frombuffer(r["doc_id"], np.int64)
        self.number, keep = r["block"], np.ones(len(ids), bool)
        keep[r["gone"] or []] = False
        bounds = np.r_[0, np.cumsum(np.frombuffer(r["places"], np.int64))].tolist()
        words, prefixes, y = np.frombuffer(r["words"], np.int32), np.frombuffer(r["prefixes"], np.int32), np.frombuffer(r["toxic"], np.int8)
        held = mixed(ids) % np.uint64(HELD_OUT) == HELD_OUT - 1
        self.train, self.held = (np.flatnonzero(keep & x) for x in (~held, held))
        self.y, self.lang = y.astype(np.int64), r["lang"]
        self.parts = lambda which: [(words[bounds[i] : bounds[i + 1]], prefixes[bounds[i] : bounds[i + 1]]) for i in which]


def mixed(ids: np.ndarray) -> np.ndarray:
    return mix(ids.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def summed(blocks: DataFrame, of: Callable[[Block], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of a vector of whole numbers. Each task sends its sum's parts without zeros; tasks, one for each SEGMENT, add them up."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for r in batch.to_pylist():
                x = of(Block(r))
                total = x if total is None else np.add(total, x, out=total)
        if total is not None:
            for k, part in enumerate(np.array_split(total, SEGMENTS)):
                at = np.flatnonzero(part).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([len(part)]), pa.array([at.tobytes()], pa.binary()), pa.array([part[at].tobytes()], pa.binary())], names=["k", "size", "at", "x"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                total = totals.setdefault(r["k"], np.zeros(r["size"], np.int64))
                total[np.frombuffer(r["at"], np.int32)] += np.frombuffer(r["x"], np.int64)
        for k, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["k", "x"])

    sent = blocks.coalesce(TASKS).mapInArrow(add, "k int, size long, at binary, x binary")
    got = sent.repartition(SEGMENTS, "k").mapInArrow(merge, "k int, x binary").collect()
    return np.concatenate([np.frombuffer(r["x"], np.int64) for r in sorted(got, key=lambda r: r["k"])])


def counted(b: Block) -> np.ndarray:
    """occurrences() of words and of prefixes, and texts by label."""
    parts, y = b.parts(b.train), b.y[b.train]
    return np.concatenate([*(occurrences([p[i] for p in parts], y, size).ravel() for i, size in ((0, WORDS + 1), (1, PREFIXES + 1))), np.bincount(y, minlength=2)]).astype(np.int64)


def next_epoch(blocks: DataFrame, training: Training, number: int) -> None:
    """All blocks are trained on from here; the mean of the changes is taken, for a word or prefix of those blocks that changed it."""
    shared = blocks.sparkSession.sparkContext.broadcast(training)

    def changes(b: Block) -> np.ndarray:
        own = copy.deepcopy(shared.value)
        if len(b.train):
            own.epoch(b.parts(b.train), b.y[b.train], np.random.default_rng([7, number, b.number]).permutation(len(b.train)))
        pairs = list(zip(own.arrays(), shared.value.arrays()))
        met = [pairs[i][0] != pairs[i][1] for i in (1, 3)]
        return np.concatenate([*(np.rint((x.astype(np.float64) - y) * UNIT).astype(np.int64).ravel() for x, y in pairs), *met, [len(b.train) > 0]])

    total = summed(blocks, changes)
    shared.destroy()
    old, at, out = training.arrays(), 0, []
    met = np.split(total[-(WORDS + 1 + PREFIXES + 1) - 1 : -1], [WORDS + 1])
    for i, x in enumerate(old):
        times = np.maximum(1, met[i // 2] if i < 4 else total[-1])
        change = total[at : at + x.size].reshape(x.shape) / UNIT
        at += x.size
        out.append((x + change / (times[:, None] if i in (0, 2) else times)).astype(np.float32))
    training.load(out)


def held_out(blocks: DataFrame, m: Model) -> DataFrame:
    """(lang, toxic, score, n) of the rows held out."""
    shared = blocks.sparkSession.sparkContext.broadcast(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in map(Block, batch.to_pylist()):
                for lo in range(0, len(b.held), BATCH):
                    some = b.held[lo : lo + BATCH]
                    words, prefixes = (np.concatenate(x) for x in zip(*b.parts(some)))
                    at = np.r_[0, np.cumsum([len(p[0]) for p in b.parts(some)])[:-1]]
                    yield pa.RecordBatch.from_arrays([pa.array([b.lang[i] for i in some], pa.string()), pa.array(b.y[some].astype(np.int32)), pa.array(np.round(scores_of(shared.value, words, prefixes, at).astype(np.float64), 6))], names=["lang", "toxic", "score"])

    return blocks.mapInArrow(run, "lang string, toxic int, score double").groupBy("lang", "toxic", "score").agg(F.count("*").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, epochs: int = EPOCHS) -> Model:
    """Trains on all labelled documents and calibrates the thresholds on those of them that are held out."""
    nothing = Model(np.zeros((WORDS + 1, DIM), np.float32), np.zeros((PREFIXES + 1, DIM), np.float32), {w: np.zeros((w, 2 * DIM, FILTERS), np.float32) for w in WIDTHS}, {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}, np.zeros(len(WIDTHS) * FILTERS, np.float32), -40.0)
    written_blocks = blocks_of(docs, labels)
    if written_blocks is None:
        return nothing
    gone = written(copies_of(written_blocks), "toxicity-copies")
    small = (gone.agg(F.sum(F.size("gone"))).first()[0] or 0) <= BROADCAST_ROWS
    blocks = written_blocks.drop("sketch").join(F.broadcast(gone) if small else gone, "block", "left")
    if not small:
        blocks = written(blocks, "toxicity-kept")
    total = summed(blocks, counted)
    n, edge = total[-2:], 2 * (WORDS + 1)
    m = nothing
    if n.min() > 0:
        training = Training((total[:edge].reshape(2, -1), total[edge:-2].reshape(2, -1)), n)
        for number in range(epochs):
            next_epoch(blocks, training, number)
        m = training.model
        got = held_out(blocks, m).orderBy("lang", "score", "toxic").toArrow()
        calibrate(m, got.column("score").to_numpy(), got.column("toxic").to_numpy().astype(np.int64), got.column("lang").to_pylist(), got.column("n").to_numpy())
    discard(blocks, gone, written_blocks)
    return m


def classify(docs: DataFrame, model: Model, score: str = "tox_score", flag: str = "tox_flag") -> DataFrame:
    """docs with the columns score and flag; columns of docs with these names are replaced."""
    docs = docs.drop(score, flag)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType()), T.StructField(flag, T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = shared.value
            s = np.round(scores(m, batch.column("text").to_pylist()), 6)
            limits = np.array([m.limit(x) for x in batch.column("lang").to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64()), pa.array(s > limits, pa.bool_())], names=[*batch.schema.names, score, flag])

    return docs.mapInArrow(run, schema)


def toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, lang, tox_score, tox_flag) of the documents that the classifier rejects."""
    return classify(docs.select("doc_id", "lang", "text"), fit(docs, labels)).where("tox_flag").select("doc_id", "lang", "tox_score", "tox_flag")


def filter_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those that the classifier rejects."""
    score, flag = free_names(docs, "tox_score", "tox_flag")
    return classify(docs, fit(docs, labels), score, flag).where(~F.col(flag)).select(*docs.columns)
