r"""Operator 7: near-duplicate lines by a segment-partition edit join.

A line of n bytes is cut into k+1 even segments. If two lines differ by at most k edits, one of the segments of the shorter
line occurs unchanged in the longer one, at a place that its number and the difference of lengths narrow down to a few. Each line is therefore
indexed under its segments (length, segment number, content) and probes with those of its substrings that could be such a segment of a line
of its length or up to k less. Keys are 64-bit hashes from prefix sums; each travels with the line's hash and a signature (16 counters of bytes), and pairs whose signatures
differ by more than k edits could make are dropped before any text is fetched. The rest is verified by a banded bit-parallel edit distance.

Of lines that are equal or at most k edits apart the first one (by doc_id, then line number) stays; every other occurrence is a duplicate. A line is compared with all
others, but not by way of a third one: if b is near a and c is near b, c goes because of b.

Only hashes and places are shuffled, in packed blocks; texts only of lines that are in a candidate pair. A line counts once under a key, however often it
occurs, so equal lines are never paired. Under a key of many lines (of a family that differs in a number, say) not all pairs are made: a line is paired with the first CANDIDATES
lines before it that may be near. If none of those is, and no nearer one is known from another key, the search is done again with more; so what is found is the same, and a
family of near lines costs a few pairs a line.

Defined results: a line is a part of a text between \n; distance counts UTF-8 bytes; lines of fewer than MIN_BYTES bytes are never
near duplicates, and equal ones go only within one document; empty lines never go; NULL texts have no lines and stay
as they are; rows with the same doc_id and text are treated alike and count as one; a NULL doc_id comes after all others; a document whose
lines all occurred before is dropped by dedup_lines(), one without lines to lose is not touched; an empty table gives an empty result;
further columns are kept by dedup_lines() and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import _power_tables, bucket_keys, free_names, mix, size_buckets, written
from quillgraph.scratch import discard

EDITS = 2
MIN_BYTES = 20
BROADCAST_LINES = 1_000_000
PAIRS_AT_ONCE = 1 << 20
CANDIDATES = 64
LAST = (1 << 63) - 1
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def segments(n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, sizes) of the k+1 segments of lines of n bytes; the last ones are the longer ones. Shape (k+1, lines)."""
    base, more = n // (k + 1), n % (k + 1)
    i = np.arange(k + 1)[:, None]
    size = base + (i >= k + 1 - more)
    return i * base + np.maximum(0, i - (k + 1 - more)), size


def keys(data: np.ndarray, start: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index keys, their lines, probe keys, their lines). A line's index keys also are its probes for segments in place."""
    up, down = _power_tables(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)])))

    def key(rows: np.ndarray, at: np.ndarray, size: np.ndarray, length: np.ndarray, i: int) -> np.ndarray:
        b = start[rows] + at
        h = mix((sums[b + size] - sums[b]) * down[b])
        return mix(h ^ (length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i + 1)))

    every = np.arange(len(n))
    seg_at, seg_size = segments(n, k)
    index = np.concatenate([key(every, seg_at[i], seg_size[i], n, i) for i in range(k + 1)])
    probe, lines = [], []
    for d in range(k + 1):
        shorter = n - d
        at, size = segments(shorter, k)
        for i in range(k + 1):
            for shift in range(max(-i, d - (k - i)), min(i, d + (k - i)) + 1):
                if d == 0 and shift == 0:
                    continue
                rows = every[(shorter > k) & (at[i] + shift >= 0) & (at[i] + shift + size[i] <= n) & (size[i] > 0)]
                probe.append(key(rows, at[i][rows] + shift, size[i][rows], shorter[rows], i))
                lines.append(rows)
    return index, np.tile(every, k + 1), np.concatenate(probe), np.concatenate(lines)


def signatures(data: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """16 counters of 4 bits, of the bytes with the same value modulo 16 after mixing, modulo 16."""
    group = (_BYTE[data] >> np.uint64(60)).astype(np.int64)
    line = np.repeat(np.arange(len(n)), n)
    at = np.repeat(start - np.concatenate(([0], np.cumsum(n)))[:-1], n) + np.arange(int(n.sum()))
    counts = np.bincount(line * 16 + group[at], minlength=16 * len(n)).reshape(-1, 16) & 15
    return (counts.astype(np.uint64) << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lower bound of twice the edit distance by signatures; a may be a single one."""
    total = np.zeros(len(b), np.int64)
    for i in range(16):
        s = np.uint64(4 * i)
        d = (((a >> s) & np.uint64(15)).astype(np.int64) - ((b >> s) & np.uint64(15)).astype(np.int64)) % 16
        total += np.minimum(d, 16 - d)
    return total


def line_hash(line: bytes) -> int:
    """Spark's xxhash64 of one string."""
    h = xxhash.xxh64_intdigest(line, seed=42)
    return h - (1 << 64) if h >> 63 else h


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, sizes) of the runs of equal keys that are longer than 1."""
    edge = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.empty(0, np.int64)
    size = np.diff(np.r_[edge, len(sorted_keys)])
    return edge[size > 1], size[size > 1]


def candidates(key: np.ndarray, line: np.ndarray, sig: np.ndarray, doc: np.ndarray, number: np.ndarray, indexed: np.ndarray, k: int, most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs (a, b, 0, -1) of hashes of different lines that share a key, at least one of them by an index key, with signatures near enough; a pair may come again for another key.
    A line of a run of more than ``most`` is paired with at least that many that stand before it; (a, a, doc, number) tells up to which place that was done."""
    order = np.lexsort((number, doc, line, key))
    key, line, sig, doc, number, indexed = (x[order] for x in (key, line, sig, doc, number, indexed))
    fresh = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (line[1:] != line[:-1])]) if len(key) else np.empty(0, np.int64)
    if len(fresh):
        indexed = np.logical_or.reduceat(indexed, fresh)
    key, line, sig, doc, number = (x[fresh] for x in (key, line, sig, doc, number))
    start, size = runs(key)
    for lo, n in zip(start[size > most].tolist(), size[size > most].tolist()):
        by = lo + np.lexsort((number[lo : lo + n], doc[lo : lo + n]))
        yield from _first_candidates(line[by], sig[by], doc[by], number[by], indexed[by], k, most)
    few = np.repeat(start[size <= most], size[size <= most])
    few = few + np.arange(len(few)) - np.repeat(np.cumsum(size[size <= most]) - size[size <= most], size[size <= most])
    few = few[np.lexsort((~indexed[few], key[few]))]
    key, line, sig, indexed = key[few], line[few], sig[few], indexed[few]
    start, size = runs(key)
    n_index = np.add.reduceat(indexed.astype(np.int64), start) if len(start) else start
    # one row for each index entry: it meets all entries behind it in its run
    left = np.repeat(start, n_index) + (np.arange(int(n_index.sum())) - np.repeat(np.cumsum(n_index) - n_index, n_index))
    partners = np.repeat(start + size, n_index) - left - 1
    ends = np.cumsum(partners)
    lo = 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS_AT_ONCE)))
        m = partners[lo:hi]
        a = np.repeat(left[lo:hi], m)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(m) - m, m)
        lo = hi
        good = apart(sig[a], sig[b]) <= 2 * k
        yield _pairs(line[a[good]], line[b[good]])


def _pairs(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    return np.minimum(x, y), np.maximum(x, y), np.zeros(len(x), np.int64), np.full(len(x), -1)


def _first_candidates(line: np.ndarray, sig: np.ndarray, doc: np.ndarray, number: np.ndarray, indexed: np.ndarray, k: int, most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """candidates() of one run, in order of place: a line is done when ``most`` lines before it are its candidates, and all that share the last one's place."""
    n = len(line)
    open_, count, done = np.arange(n), np.zeros(n, np.int64), []
    x, y, held = [], [], 0
    for j in range(n - 1):
        later = open_[np.searchsorted(open_, j + 1) :]
        if not len(later):
            break
        hit = later[(apart(sig[j : j + 1], sig[later]) <= 2 * k) & (indexed[j] | indexed[later])]
        x.append(np.full(len(hit), line[j]))
        y.append(line[hit])
        held += len(hit)
        count[hit] += 1
        if doc[j] != doc[j + 1] or number[j] != number[j + 1]:
            full = later[count[later] >= most]
            if len(full):
                done.append((line[full], line[full], np.full(len(full), doc[j]), np.full(len(full), number[j])))
                open_ = later[count[later] < most]
        if held >= PAIRS_AT_ONCE:
            yield _pairs(np.concatenate(x), np.concatenate(y))
            x, y, held = [], [], 0
    if x:
        yield _pairs(np.concatenate(x), np.concatenate(y))
    yield from done


def distances(left: list[bytes], right: list[bytes], k: int) -> np.ndarray:
    """Edit distances up to k, else k+1: bit-parallel in a diagonal band (Hyyro 2003), all pairs side by side."""
    m, n = np.array([len(x) for x in left], np.int64), np.array([len(x) for x in right], np.int64)
    out = np.full(len(left), k + 1, np.int64)
    near = np.abs(m - n) <= k
    tiny = np.flatnonzero(near & (np.minimum(m, n) <= k))
    for i in tiny:
        out[i] = plain_distance(left[i], right[i])
    live = np.flatnonzero(near & (np.minimum(m, n) > k))
    order = live[np.argsort(n[live], kind="stable")]
    lo = 0
    while lo < len(order):
        hi = lo + max(1, min(4096, (1 << 24) // int(n[order[min(lo + 4096, len(order)) - 1]])))
        part = order[lo:hi]
        out[part] = _band([left[i] for i in part], [right[i] for i in part], m[part], n[part], k)
        lo = hi
    return np.minimum(out, k + 1)


def plain_distance(a: bytes, b: bytes) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def _band(left: list[bytes], right: list[bytes], m: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """Column j holds rows j-k .. j+k of the matrix in the upper 2k+1 bits of a word, vertical differences as bits."""
    width = 2 * k + 1
    a = np.full((len(left), int(m.max()) + int(n.max()) + 2 * width), -1, np.int16)
    b = np.full((len(left), int(n.max())), -2, np.int16)
    for i, (x, y) in enumerate(zip(left, right)):
        a[i, k : k + len(x)] = np.frombuffer(x, np.uint8)
        b[i, : len(y)] = np.frombuffer(y, np.uint8)
    one, top = np.uint64(1), np.uint64(1 << 63)
    weights = one << np.arange(64 - width, 64, dtype=np.uint64)
    vp = np.full(len(left), ((1 << 64) - 1) ^ ((1 << (63 - k)) - 1), np.uint64)
    vn = np.zeros(len(left), np.uint64)
    score = np.full(len(left), k, np.int64)
    for j in range(b.shape[1]):
        eq = np.where(a[:, j : j + width] == b[:, j : j + 1], weights, np.uint64(0)).sum(axis=1, dtype=np.uint64)
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp, hn = vn | ~(d0 | vp), d0 & vp
        down = j < m - k  # the last row of the band still goes down the diagonal; then it stays on the matrix's last row
        level = one << np.clip(62 - (j - (m - k)), 0, 63).astype(np.uint64)
        step = np.where(down, (d0 & top) == 0, ((hp & level) != 0).astype(np.int64) - ((hn & level) != 0))
        score += np.where(j < n, step, 0)
        x = d0 >> one
        vp, vn = hn | ~(x | hp), x & hp
    return score


def _blocks(lines: list[bytes], doc: np.ndarray, number: np.ndarray, k: int, buckets: int) -> Iterator[tuple[int, bytes]]:
    """The keys of one batch of distinct lines by bucket: arrays of keys, line hashes, signatures, places, and index marks."""
    n = np.array([len(x) for x in lines], np.int64)
    data = np.frombuffer(b"".join(lines), np.uint8)
    start = np.concatenate(([0], np.cumsum(n)))[:-1]
    hashes = np.array([line_hash(x) for x in lines], np.int64)
    sig = signatures(data, start, n)
    index, index_lines, probe, probe_lines = keys(data, start, n, k)
    key = np.concatenate([index, probe])
    line = np.concatenate([index_lines, probe_lines])
    mark = np.arange(len(key)) < len(index)
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        part = order[bounds[b] : bounds[b + 1]]
        if len(part):
            row = line[part]
            yield b, b"".join(x.tobytes() for x in (key[part], hashes[row], sig[row], doc[row], number[row], mark[part]))


def first_places(ids: list[int | None], texts: list[str], min_bytes: int) -> dict[bytes, tuple[int, int]]:
    """The distinct lines of a batch with the least (doc_id, line) of each, NULL as the largest doc_id."""
    out: dict[bytes, tuple[int, int]] = {}
    for i, t in zip(ids, texts):
        i = LAST if i is None else i
        for n, x in enumerate(t.encode("utf-8", "surrogatepass").split(b"\n")):
            if len(x) >= min_bytes:
                old = out.get(x)
                if old is None or (i, n) < old:
                    out[x] = i, n
    return out


def candidate_rows(docs: DataFrame, k: int, min_bytes: int, most: int) -> DataFrame:
    """Distinct rows of candidates(): pairs (a, b) with a < b, and (a, a, doc, number)."""
    buckets = size_buckets(docs)
    places = bucket_keys(buckets)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = first_places(batch.column(0).to_pylist(), batch.column(1).to_pylist(), min_bytes)
            lines, at = list(first), np.array(list(first.values()), np.int64).reshape(-1, 2)
            doc, number = at[:, 0], at[:, 1].astype(np.int32)
            lo = 0
            sizes = np.cumsum([len(x) for x in lines])
            while lo < len(lines):
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + (2 << 20))))
                b, blocks = zip(*_blocks(lines[lo:hi], doc[lo:hi], number[lo:hi], k, buckets))
                yield pa.RecordBatch.from_arrays([pa.array([places[x] for x in b], pa.int32()), pa.array(blocks, pa.binary())], names=["bucket", "block"])
                lo = hi

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for block in batch.column("block"):
                raw = block.as_buffer()
                n = raw.size // 37
                words = np.frombuffer(raw, np.uint64, 4 * n).reshape(4, n)
                parts.append((words[0], words[1].view(np.int64), words[2], words[3].view(np.int64), np.frombuffer(raw, np.int32, n, 32 * n), np.frombuffer(raw, bool, n, 36 * n)))
        if parts:
            columns = [np.concatenate(x) for x in zip(*parts)]
            parts.clear()
            for found in candidates(*columns, k, most):
                rows = np.unique(np.stack(found, axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(4)], names=["a", "b", "doc", "number"])

    blocks = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long"), "text").mapInArrow(emit, "bucket int, block binary")
    return blocks.repartition(buckets, "bucket").mapInArrow(meet, "a long, b long, doc long, number long").distinct()


def lines_of(docs: DataFrame, min_bytes: int) -> DataFrame:
    """(doc_id, tie, line, h, text): the lines that may be duplicates; tie tells rows of one doc_id apart."""
    split = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), F.posexplode(F.split("text", "\n")).alias("line", "part"))
    return split.where(F.octet_length("part") >= min_bytes).select("doc_id", "tie", "line", F.xxhash64("part").alias("h"), F.col("part").alias("text"))


def near_pairs(docs: DataFrame, k: int = EDITS, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(a, b, distance) of distinct lines' hashes, 0 < distance <= k, a < b: for each line the pair with the first line that is near it, and others."""
    most = CANDIDATES
    while True:
        rows = written(candidate_rows(docs, k, min_bytes, most), "line-candidates")
        pairs = rows.where("a <> b").select("a", "b")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
        small = pairs.count() <= BROADCAST_LINES
        place = F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.col("line").cast("long").alias("number"))
        known = lines_of(docs, min_bytes).select("h", "text", place.alias("place")).join(F.broadcast(wanted) if small else wanted, "h", "left_semi")
        texts = written(known.groupBy("h").agg(F.any_value("text").alias("text"), F.min("place").alias("place")), "line-texts")
        near = written(_verified(pairs, texts, k), "line-near")
        ways = near.select("a", "b").union(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = ways.join(texts.select(F.col("h").alias("b"), "place"), "b").groupBy("a").agg(F.min("place").alias("place"))
        open_ = rows.where("a = b").join(best, "a", "left").where(F.col("place").isNull() | (F.col("place") > F.struct("doc", "number")))
        resolved = open_.isEmpty()
        discard(rows, texts)
        if resolved:
            return near
        discard(near)
        most *= 16


def _verified(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([x.encode("utf-8", "surrogatepass") for x in batch.column(c).to_pylist()] for c in ("left", "right"))
            d = distances(left, right, k)
            good = pa.array(d <= k)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(d, pa.int32())], names=["a", "b", "distance"]).filter(good)

    both = pairs.join(texts.select(F.col("h").alias("a"), F.col("text").alias("left")), "a").join(texts.select(F.col("h").alias("b"), F.col("text").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(verify, "a long, b long, distance int")


def marked_lines(docs: DataFrame, k: int, min_bytes: int) -> DataFrame:
    """Every line that occurred before or is near an earlier one, with that line; short ones only if equal. home: the first equal line is in
    the same document."""
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line", "tie")
    lines = written(lines_of(docs, 1).select("doc_id", "tie", "line", "h", (F.octet_length("text") < min_bytes).alias("short")).distinct(), "lines")
    near = near_pairs(docs, k, min_bytes)
    ways = written(near.select("a", "b", "distance").union(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance")), "near-lines")
    first = lines.groupBy("h").agg(F.min(place).alias("same"), F.count("*").alias("n"))
    ends = ways.select(F.col("a").alias("b")).distinct()
    small = ways.count() <= BROADCAST_LINES
    first_of = lines.withColumnRenamed("h", "b").join(F.broadcast(ends) if small else ends, "b", "left_semi").groupBy("b").agg(F.min(place).alias("first"))
    best = ways.join(first_of, "b").groupBy("a").agg(F.min(F.struct("first", "distance")).alias("near")).withColumnRenamed("a", "h")
    by_near = F.col("near").isNotNull() & (F.col("near.first") < F.col("same"))
    # only lines that occur again or have a near one go on; a line of very many occurrences is aggregated on the map side and its join can be split
    targets = first.join(F.broadcast(best) if small else best, "h", "left").where((F.col("n") > 1) | by_near)
    return lines.join(targets, "h").where(by_near | (place > F.col("same"))).select(
        "doc_id",
        "tie",
        "line",
        "h",
        "short",
        (F.col("same.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("same.tie") == F.col("tie"))).alias("home"),
        F.when(by_near, F.col("near.first.doc_id")).otherwise(F.col("same.doc_id")).alias("kept_doc_id"),
        F.when(by_near, F.col("near.first.line")).otherwise(F.col("same.line")).alias("kept_line"),
        F.when(by_near, F.col("near.distance")).otherwise(0).cast("int").alias("distance"),
    )


def in_documents(marked: DataFrame) -> DataFrame:
    """(doc_id, tie, h, short, seen, first, gone): marked lines by document and content, with the numbers of those that go. Of equal short
    lines the document's first one, which is not marked if it is the first of all, stays."""
    by_line = marked.groupBy("doc_id", "tie", "h", "short", "home").agg(F.array_sort(F.collect_set("line")).alias("at"))
    stays = F.col("short") & ~F.col("home")
    return by_line.select("doc_id", "tie", "h", "short", F.size("at").alias("seen"), F.when(stays, F.col("at")[0]).alias("first"), F.when(stays, F.slice("at", 2, F.size("at"))).otherwise(F.col("at")).alias("gone"))


def duplicate_lines(docs: DataFrame, k: int = EDITS, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(doc_id, tie, line, kept_doc_id, kept_line, distance): every line that goes, with the first line that it is a duplicate of. Of lines of
    fewer than min_bytes bytes those go that are equal to an earlier line of their document, with its first such line."""
    marked = written(marked_lines(docs, k, min_bytes), "marked-lines")
    short = marked.where("short")
    # the first of all is unmarked, but it is the line that the others are marked with
    at_home = short.where("home").drop("short", "h", "home")
    away = in_documents(short.where(~F.col("home"))).select("doc_id", "tie", F.explode("gone").alias("line"), F.col("doc_id").alias("kept_doc_id"), F.col("first").alias("kept_line"), F.lit(0).alias("distance"))
    return marked.where(~F.col("short")).drop("short", "h", "home").union(at_home).union(away)


def dedup_lines(docs: DataFrame, k: int = EDITS, min_bytes: int = MIN_BYTES) -> DataFrame:
    """docs without their duplicate lines, short ones that repeat within their document included; n_chars, if there, is counted anew. A document
    goes if it loses lines of min_bytes bytes and every line that it would keep is short and occurred before, so that copies don't stay as scraps."""
    # one shuffle by document serves both aggregations
    by_line = in_documents(marked_lines(docs, k, min_bytes).repartition("doc_id", "tie"))
    gone = by_line.groupBy("doc_id", "tie").agg(F.flatten(F.collect_list("gone")).alias("__gone"), F.sum("seen").alias("__seen"), F.bool_or(~F.col("short")).alias("__long"))
    gone = gone.where(F.size("__gone") > 0).select(F.col("doc_id").alias("__gone_id"), F.col("tie").alias("__gone_tie"), "__gone", "__seen", "__long")
    names = ["__gone_id", "__gone_tie", "__gone", "__seen", "__long"]
    gone_id, gone_tie, gone_lines, seen, has_long = own = free_names(docs, *names)
    gone = gone.toDF(*own)
    joined = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(F.col(gone_id)) & (F.xxhash64(docs["text"]) == F.col(gone_tie)), "left")
    hit = F.col(gone_lines).isNotNull()
    lines = F.split("text", "\n")
    out = joined.where(~hit | ~F.col(has_long) | (F.size(F.filter(lines, lambda x: F.octet_length(x) > 0)) > F.col(seen)))
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone_lines, i)), "\n")
    out = out.withColumn("text", F.when(hit, left).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


SQL = f"""
WITH rows AS (SELECT DISTINCT doc_id, text FROM {{docs}} WHERE text IS NOT NULL),
lines AS (SELECT doc_id, hash(text) AS tie, unnest(string_split(text, chr(10))) AS part, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM rows),
l AS (SELECT * FROM lines WHERE strlen(part) >= {MIN_BYTES}),
d AS (SELECT part, strlen(part) AS n, min({{{{'a': doc_id, 'b': line}}}}) AS first FROM l GROUP BY part),
near AS (SELECT x.part, min({{{{'a': y.first, 'b': levenshtein(x.part, y.part)}}}}) AS best
  FROM d x JOIN d y ON y.n BETWEEN x.n - {EDITS} AND x.n + {EDITS} AND x.part <> y.part AND levenshtein(x.part, y.part) <= {EDITS} GROUP BY x.part)
SELECT l.doc_id, CAST(l.line AS INT) AS line,
  CASE WHEN near.best.a < d.first THEN near.best.a.a ELSE d.first.a END AS kept_doc_id,
  CAST(CASE WHEN near.best.a < d.first THEN near.best.a.b ELSE d.first.b END AS INT) AS kept_line,
  CAST(CASE WHEN near.best.a < d.first THEN near.best.b ELSE 0 END AS INT) AS distance
FROM l JOIN d USING (part) LEFT JOIN near USING (part)
WHERE near.best.a < d.first OR {{{{'a': l.doc_id, 'b': l.line}}}} > d.first
UNION ALL
SELECT doc_id, CAST(line AS INT), doc_id, CAST(first AS INT), 0
FROM (SELECT *, min(line) OVER (PARTITION BY doc_id, tie, part) AS first FROM lines WHERE strlen(part) BETWEEN 1 AND {MIN_BYTES - 1}) WHERE line > first
"""
