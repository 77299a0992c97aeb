r"""Operator 5: encoding into SentencePiece pieces and decoding, by max-plus algebra.

The best segmentation of a text is the one of largest total score over the model's pieces: a piece scores
-log(rank + 2) in fixed point (rank: its place in the model's merge order); a character without a piece becomes its UTF-8 bytes, each at BYTE_SCORE.
Scores are integers, so sums are the same in any order.

A document of more than CHUNK characters is cut into chunks that are handled in parallel. State i at a boundary means that
the last piece reaches i characters into the next chunk. A chunk yields the transfer matrix of best scores from every state at its
begin to every state at its end; products of these matrices (maximum for sum, sum for product) are associative and
are scanned in a tree; the scan gives each chunk its states at both ends, and every chunk is then traced back on its own.

No piece has a space behind another character, so a segmentation is free at the begin of every run of spaces. Between the first and the last such place in
a chunk, words are looked up in a cache, and only the two rims (or the whole chunk, if it has no space) need the transfer matrix.

Decoding joins the pieces' bytes; it gives back exactly the text. As usual a space is put before a text and taken away by decoding.

Defined results: a NULL text yields no row; an empty text yields one row with the piece of a lone space; of equal scores the longest
last piece wins within a rim or word, and the smallest state at a boundary; repeated rows are encoded each; NULL ids are kept;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import written

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 16384
SCALE = 10_000
CACHE = 200_000
LOW = -(1 << 60)
BYTE_SCORE = -12 * SCALE
SCHEMA = "doc_id long, chunk int, begin int, score long, ids array<int>, exact boolean"


SLOT_BITS = 18
_FACTOR = np.uint64(0x9FB21C651E98DF25)


def _code_hash(codes: np.ndarray) -> np.ndarray:
    h = np.zeros(len(codes), np.uint64)
    for j in range(codes.shape[1]):
        h = _step(h, codes[:, j])
    return h


def _step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    h = (h ^ (c + np.uint64(1))) * _FACTOR
    return h ^ (h >> np.uint64(32))


class Pieces:
    """A model's pieces as Viterbi search needs them; plain data, so it can be broadcast."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, tuple[int, int]] = {}
        self.text: list[bytes] = []
        self.byte = [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte[value] = i
                self.text.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.text.append(b"")
            else:
                plain = piece.replace("▁", " ")
                if " " in plain.lstrip(" "):
                    raise ValueError("a piece holds a space behind another character")
                self.ids[plain] = (i, -round(SCALE * math.log(max(0.0, -sp.get_score(i)) + 2)))
                self.text.append(plain.encode())
        self.longest = max(map(len, self.ids))
        self.tables()

    def tables(self) -> None:
        """The pieces, and the bytes that stand for ASCII characters without a piece, by the hash of their characters; and what pieces begin with, with id -1."""
        entries = dict(self.ids)
        for c in range(128):
            entries.setdefault(chr(c), (self.byte[c], BYTE_SCORE))
        for t in self.ids:
            for n in range(1, len(t)):
                entries.setdefault(t[:n], (-1, 0))
        codes = [np.array([list(map(ord, t)) for t in entries if len(t) == n], dtype=np.uint64).reshape(-1, n) for n in range(1, self.longest + 1)]
        values = [np.array([v for t, v in entries.items() if len(t) == n], dtype=np.int64).reshape(-1, 2) for n in range(1, self.longest + 1)]
        self.keys, self.values = [], []
        h, v = np.concatenate([_code_hash(c) for c in codes]), np.concatenate(values)
        while len(h):  # what falls on a taken slot goes to the next table
            slots = (h >> np.uint64(64 - SLOT_BITS - 15 * len(self.keys))) & np.uint64((1 << SLOT_BITS) - 1)
            _, first = np.unique(slots, return_index=True)
            key, value = np.zeros(1 << SLOT_BITS, np.uint64), np.zeros((1 << SLOT_BITS, 2), np.int32)
            key[slots[first]], value[slots[first]] = h[first], v[first]
            self.keys.append(key)
            self.values.append(value)
            rest = np.ones(len(h), bool)
            rest[first] = False
            h, v = h[rest], v[rest]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) by hash; id -1 where pieces only begin so, -2 where none does."""
        ids, scores = np.full(len(h), -2, np.int32), np.zeros(len(h), np.int64)
        rest = np.arange(len(h))
        for k, (key, value) in enumerate(zip(self.keys, self.values)):
            slots = ((h >> np.uint64(64 - SLOT_BITS - 15 * k)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)
            taken = key[slots]
            hit = taken == h
            got = value[slots[hit]]
            at = rest[hit]
            ids[at], scores[at] = got[:, 0], got[:, 1]
            other = ~hit & (taken != 0)  # an empty slot says that later tables don't have it either
            rest, h = rest[other], h[other]
            if not len(rest):
                break
        return ids, scores

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.text.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")

    def options(self, text: str, s: int, end: int) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        """(length, score, ids) of the pieces that begin at s and don't pass end."""
        single = False
        for n in range(1, min(self.longest, end - s) + 1):
            found = self.ids.get(text[s : s + n])
            if found:
                single |= n == 1
                yield n, found[1], (found[0],)
        if not single:
            raw = text[s].encode("utf-8", "surrogatepass")
            yield 1, BYTE_SCORE * len(raw), tuple(self.byte[b] for b in raw)


class Encoder:
    def __init__(self, pieces: Pieces) -> None:
        self.p = pieces
        self.words: dict[str, tuple[bytes, int]] = {}

    def path(self, text: str, i: int, n: int, e: int) -> tuple[list[int], int]:
        """Best path from i to e with every piece begun before n. (ids, score)"""
        if i >= e:
            return [], 0
        best = [LOW] * (e + 1)
        back: list[tuple[int, tuple[int, ...]] | None] = [None] * (e + 1)
        best[i] = 0
        for s in range(i, min(n, e)):
            if best[s] > LOW:
                for length, score, ids in self.p.options(text, s, e):
                    if best[s] + score > best[s + length]:  # s rises, so of equals the longest piece stays
                        best[s + length] = best[s] + score
                        back[s + length] = (s, ids)
        out: list[int] = []
        at = e
        while at > i:
            at, ids = back[at]
            out.extend(reversed(ids))
        return out[::-1], best[e]

    def learn(self, new: list[str]) -> None:
        """Puts the best paths of words, each with a space before it, into the cache: one search for all of them."""
        short = [w for w in new if len(w) <= 64]
        slow = [w for w in new if len(w) > 64]
        for lo in range(0, len(short), 1 << 16):
            slow += self.search(short[lo : lo + (1 << 16)])
        for w in slow:
            ids, score = self.path(" " + w, 0, len(w) + 1, len(w) + 1)
            self.words[w] = np.array(ids, np.int32).tobytes(), score

    def search(self, group: list[str]) -> list[str]:
        """learn() for many words side by side; returns those with a character beyond ASCII that has no piece. Words stand in order of falling length, and
        their characters column by column: column c has those of all words of more than c characters (the space before a word counts)."""
        if not group:
            return []
        group = sorted(group, key=len, reverse=True)
        n = np.array([len(w) + 1 for w in group])
        most = int(n[0])
        have = np.searchsorted(-n, -np.arange(most + 1))  # words of more than c characters, by c
        column = np.concatenate(([0], np.cumsum(have)))
        flat = np.frombuffer((" " + " ".join(group)).encode("utf-32-le", "surrogatepass"), np.uint32)
        start = np.cumsum(n) - n
        codes = np.concatenate([flat[start[:m] + c] for c, m in enumerate(have[:most].tolist())]).astype(np.uint64)
        c, w = np.repeat(np.arange(most), have[:most]), np.concatenate([np.arange(m) for m in have[:most].tolist()])
        h = np.zeros(len(c), np.uint64)
        odd = np.zeros(len(group), bool)
        pieces: list[tuple] = [()]  # by length: where each column begins, words, ids, scores
        for k in range(1, min(self.p.longest, most) + 1):
            inside = c + k <= n[w]
            c, w, h = c[inside], w[inside], h[inside]
            if not len(c):
                break
            h = _step(h, codes[column[c + k - 1] + w])
            ids, scores = self.p.find(h)
            good = ids >= 0
            if k == 1:
                odd[w[~good]] = True
            pieces.append((np.searchsorted(c[good], np.arange(most + 1)).tolist(), w[good], ids[good], scores[good]))
            go = ids > -2
            c, w, h = c[go], w[go], h[go]
        best, length, last = [np.zeros(len(group), np.int64)], [np.zeros(0, np.int8)], [np.zeros(0, np.int32)]
        total = np.zeros(len(group), np.int64)
        for e in range(1, most + 1):
            m = int(have[e - 1])
            b, size, ids = np.full(m, LOW, np.int64), np.zeros(m, np.int8), np.zeros(m, np.int32)
            for k in range(1, min(e, len(pieces) - 1) + 1):
                bounds, words, of, scores = pieces[k]
                lo, hi = bounds[e - k], bounds[e - k + 1]
                if lo == hi:
                    continue
                words = words[lo:hi]
                score = best[e - k][words] + scores[lo:hi]
                better = score >= b[words]  # k rises, so of equals the longest piece stays
                words = words[better]
                b[words], size[words], ids[words] = score[better], k, of[lo:hi][better]
            best.append(b)
            length.append(size)
            last.append(ids)
            total[have[e] : m] = b[have[e] : m]
        at = np.where(odd, -1, n)
        rows, ends, chosen = [], [], []
        for e in range(most, 0, -1):
            here = np.flatnonzero(at[: have[e - 1]] == e)
            rows.append(here)
            ends.append(np.full(len(here), e))
            chosen.append(last[e][here])
            at[here] -= length[e][here]
        row = np.concatenate(rows)
        order = np.argsort(row * (most + 1) + np.concatenate(ends))
        raw = np.concatenate(chosen)[order].tobytes()
        stop = (4 * np.cumsum(np.bincount(row, minlength=len(group)))).tolist()
        begin = 0
        for word, end, score in zip(group, stop, total.tolist()):
            if end > begin:
                self.words[word] = raw[begin:end], score
                begin = end
        return [group[i] for i in np.flatnonzero(odd).tolist()]

    @staticmethod
    def parts(text: str) -> list[str]:
        """The words of a text that begins with a space, each without the first of its spaces."""
        parts = text.split(" ")[1:]
        return [x[1:] for x in re.findall(r" +[^ ]*", text)] if "" in parts else parts

    def prepare(self, texts: list[str]) -> None:
        """Learns the new words of many texts together."""
        new: set[str] = set()
        for t in texts:
            new.update(self.parts(t))
        missing = {w for w in new if w not in self.words}
        if len(self.words) + len(missing) > CACHE:  # frequent words are among those that are needed now
            self.words = {w: self.words[w] for w in new - missing}
        self.learn(list(missing))

    def prepare_chunks(self, texts: list[str], sizes: list[int]) -> None:
        places = [self.free(t, n) for t, n in zip(texts, sizes)]
        self.prepare([t[p[0] : p[1]] for t, p in zip(texts, places) if p and p[1] > p[0]])

    def units(self, text: str) -> tuple[bytes, int]:
        """Best path of a text that begins with a space, or is empty: (ids as int32, score)."""
        if not text:
            return b"", 0
        parts = self.parts(text)
        try:
            found = list(map(self.words.__getitem__, parts))
        except KeyError:
            self.prepare([text])
            found = list(map(self.words.__getitem__, parts))
        return b"".join([x[0] for x in found]), sum([x[1] for x in found])

    @staticmethod
    def free(text: str, n: int) -> tuple[int, int] | None:
        """First and last place up to n (its own begin left out) where a run of spaces begins."""
        found = re.search(r"[^ ] ", text[: n + 1])
        if not found:
            return None
        last = n + 1
        while True:  # the last space up to n that stands behind another character
            last = text.rfind(" ", 0, last)
            if text[last - 1] != " ":
                return found.start() + 1, last

    def transfer(self, text: str, n: int) -> np.ndarray:
        """Scores from every state at 0 to every state at n; text goes on behind n by less than a piece."""
        size = self.p.longest
        m = np.full((size, size), LOW, np.int64)
        for i in range(n, size):
            m[i, i - n] = 0  # a piece from before reaches over the whole chunk
        between = self.free(text, n)
        if between is None:
            best = np.full((len(text) + 1, size), LOW, np.int64)
            for i in range(min(size, n)):
                best[i, i] = 0
            for s in range(n):
                for length, score, _ in self.p.options(text, s, len(text)):
                    np.maximum(best[s + length], best[s] + score, out=best[s + length])
            for j in range(min(size, len(text) - n + 1)):
                m[:, j] = np.maximum(m[:, j], best[n + j])
        else:
            a, b = between
            tail = [LOW] * (len(text) + 1)
            tail[b] = 0
            for s in range(b, n):
                if tail[s] > LOW:
                    for length, score, _ in self.p.options(text, s, len(text)):
                        tail[s + length] = max(tail[s + length], tail[s] + score)
            middle = self.units(text[a:b])[1]
            head = [LOW] * a + [0]
            for s in range(a - 1, -1, -1):
                head[s] = max(score + head[s + length] for length, score, _ in self.p.options(text, s, a))
            for i in range(min(size, a + 1, n)):
                for j in range(min(size, len(text) - n + 1)):
                    if tail[n + j] > LOW:
                        m[i, j] = max(m[i, j], head[i] + middle + tail[n + j])
        return np.maximum(m, LOW)

    def trace(self, text: str, n: int, i: int, j: int) -> tuple[np.ndarray, int]:
        """The chunk's ids between state i at 0 and state j at n."""
        if i >= n:
            return np.empty(0, np.int32), 0
        between = self.free(text, n)
        if between is None or i > between[0]:
            ids, score = self.path(text, i, n, n + j)
            return np.array(ids, np.int32), score
        a, b = between
        head, s1 = self.path(text[:a], i, a, a)
        middle, s2 = self.units(text[a:b])
        tail, s3 = self.path(text[b:], 0, n - b, n + j - b)
        return np.concatenate([np.array(head, np.int32), np.frombuffer(middle, np.int32), np.array(tail, np.int32)]), s1 + s2 + s3


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product; LOW stays the least value."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), LOW)


def scan(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """All products of the first matrices, by a tree: pairs first, then their scan, then what lies between."""
    if len(matrices) == 1:
        return matrices
    pairs = [product(matrices[i], matrices[i + 1]) for i in range(0, len(matrices) - 1, 2)]
    upper = scan(pairs)
    return [matrices[0] if i == 0 else upper[i // 2] if i % 2 else product(upper[i // 2 - 1], matrices[i]) for i in range(len(matrices))]


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """The best path's states at all boundaries, from 0 before the first chunk to 0 behind the last."""
    before = scan(matrices)
    states = [0]
    for k in range(len(matrices) - 1, 0, -1):
        states.append(int(np.argmax(before[k - 1][0] + matrices[k][:, states[-1]])))
    return [0, *states[::-1]]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, chunk, begin, score, ids, exact = zip(*rows)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32, copy=False)))
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(chunk, pa.int32()), pa.array(begin, pa.int32()), pa.array(score, pa.int64()), lists, pa.array(exact, pa.bool_())], names=["doc_id", "chunk", "begin", "score", "ids", "exact"])


ROWS = 2048
AT_ONCE = 1 << 21
_CHUNKS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int32()), ("n", pa.int32()), ("text", pa.string()), ("matrix", pa.binary())])


def _matrices(e: Encoder, held: list[tuple]) -> pa.RecordBatch:
    """Chunks with their transfer matrices; their words are learned together."""
    e.prepare_chunks([x[4] for x in held], [x[3] for x in held])
    columns = [*zip(*held), [e.transfer(x[4], x[3]).tobytes() for x in held]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CHUNKS.types)], names=_CHUNKS.names)


def encode(docs: DataFrame, model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, chunk, begin, score, ids, exact): the pieces that begin in each chunk; begin is the place in the text, counted
    with the space put before it, where the first of them begins; exact: decoding them gave that part of the text again."""
    spark = docs.sparkSession
    model_ = spark.sparkContext.broadcast(Pieces(model))
    source = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(model_.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                rows = []
                part = batch.slice(lo, ROWS)
                texts = [" " + t for t in part.column(1).to_pylist()]
                e.prepare(texts)
                for doc_id, text in zip(part.column(0).to_pylist(), texts):
                    raw, score = e.units(text)
                    ids = np.frombuffer(raw, np.int32)
                    rows.append((doc_id, 0, 0, score, ids, e.p.decode(ids) == text))
                yield _batch(rows)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(model_.value)
        held: list[tuple] = []
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                text = " " + text
                for k, at in enumerate(range(0, len(text), chunk)):
                    n = min(chunk, len(text) - at)
                    held.append((row, doc_id, k, n, text[at : at + n + e.p.longest - 1]))
                if len(held) * chunk >= AT_ONCE:
                    yield _matrices(e, held)
                    held = []
        if held:
            yield _matrices(e, held)

    def states(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        found = boundary_states([np.frombuffer(x.as_py(), np.int64).reshape(model_.value.longest, -1) for x in table.column("matrix")])
        return pa.table({"row": table.column("row"), "chunk": table.column("chunk"), "i": pa.array(found[:-1], pa.int32()), "j": pa.array(found[1:], pa.int32())})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(model_.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, max(1, AT_ONCE // chunk)):
                part = batch.slice(lo, max(1, AT_ONCE // chunk))
                texts, sizes = part.column("text").to_pylist(), part.column("n").to_pylist()
                e.prepare_chunks(texts, sizes)
                rows = []
                for doc_id, k, n, text, i, j in zip(part.column("doc_id").to_pylist(), part.column("chunk").to_pylist(), sizes, texts, part.column("i").to_pylist(), part.column("j").to_pylist()):
                    ids, score = e.trace(text, n, i, j)
                    rows.append((doc_id, k, k * chunk + i, score, ids, e.p.decode(ids) == text[i : n + j]))
                yield _batch(rows)

    whole = source.where(F.length("text") < chunk).mapInArrow(short, SCHEMA)
    giant = source.where(F.length("text") >= chunk).withColumn("row", F.monotonically_increasing_id())
    parts = written(giant.mapInArrow(chunks, "row long, doc_id long, chunk int, n int, text string, matrix binary"), "piece-chunks")
    at = parts.select("row", "chunk", "matrix").groupBy("row").applyInArrow(states, "row long, chunk int, i int, j int")
    traced = parts.drop("matrix").join(at, ["row", "chunk"]).select("doc_id", "chunk", "n", "text", "i", "j").mapInArrow(trace, SCHEMA)
    return whole.unionByName(traced)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) from encode()'s rows. Rows of one doc_id must be of one document."""
    model_ = encoded.sparkSession.sparkContext.broadcast(Pieces(model))

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        ids = np.concatenate([np.asarray(x.as_py(), np.int32) for x in table.column("ids")])
        return pa.table({"doc_id": table.column("doc_id").slice(0, 1), "text": pa.array([model_.value.decode(ids)[1:]], pa.string())})

    return encoded.select("doc_id", "chunk", "ids").groupBy("doc_id").applyInArrow(join, "doc_id long, text string")
