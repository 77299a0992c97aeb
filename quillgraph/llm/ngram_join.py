"""Operator 3: n-gram Jaccard self-join by T-occurrence search.

Every document is a query: its partners are the documents whose set of word n-grams has a Jaccard similarity of at least t.
Documents with equal sets form a class and are handled as one.

1. Every n-gram is sent to a bucket by its hash, in packed blocks; a bucket holds the whole inverted lists of its n-grams and so knows
   how many classes each occurs in. N-grams of a single class can't be shared and end here. N-grams that a sample shows to be in more than HOT_SHARE
   of all documents aren't listed: they go with their classes as the most frequent ones (frequencies only order n-grams). Members of
   classes only pass through and are aggregated by Spark, so a class of any number of copies is no task's load.
2. By class, the shared n-grams come together with their frequencies. A partner of a class with s n-grams shares at least ceil(t*s) of them, so one of
   the s - ceil(t*s) + 1 rarest; n-grams of the class alone take the first places of that prefix. Most classes have no other ones and are done.
3. By n-gram of the prefix, classes that could be partners meet (prefix, length and positional filters). They are not paired here: each class has a home, the least of
   its shared n-grams that are at least half as frequent as their median (those that only a few copies share would scatter a large group), and joins a cell for each pair of homes that met. Near copies mostly have the same home, so a group of them fills a
   few cells, and a class is sent to few places, however large the group. A cell of more than CELL classes is cut into blocks, and each pair of blocks is a cell of its own,
   so the largest groups spread over many tasks.
4. In each cell the T-occurrence search runs: for each query the longest lists are set aside, the short ones are merged by a heap, and those
   candidates that could still reach the required overlap are looked up in the long ones by binary search (DivideSkip). Equal lists of a query, as near copies have many, are one
   list that counts several times. In a cell of DENSE classes and more, the lists with more than a LONG-th of its classes are the long ones of every query: nearly all classes of a group of near copies are candidates of each
   other there, so these lists are looked up for all of them at once, by a product of matrices; the others are merged by the heap. A pair of classes meets in exactly one cell.
5. Of a cell only each class's number of links and the least class of its part of the group go on, not the pairs, whose number is the square of the group's.
   Groups are the connected components over all cells.

Nothing is capped: frequent n-grams come last in every prefix, and where a document consists of them it still meets all others.

Defined results: words are runs of letters, digits and characters beyond ASCII in lower case; a document of fewer than n words has its whole
word sequence as its one n-gram, one without words has no partners; rows with NULL doc_id or NULL text are left out; repeated rows count once, a doc_id with
several texts has a row for each class; an empty table gives an empty result; further columns are ignored. N-grams are compared by 48 bits of hash within a bucket, classes by 64 bits.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import bucket_keys, free_names, mix, size_buckets, word_hashes, written
from quillgraph.scratch import discard

N = 4
THRESHOLD = 0.45
BLOCK_BYTES = 2 << 20
BROADCAST_ROWS = 1_000_000
CELL = 1024
DENSE = 64
LONG = 32
DENSE_VALUES = 8 << 20
HOT_SHARE = 1 / 64
HOT_LEAST = 16
SAMPLE = 4096
MOST = 65535
_FACTORS = mix(np.arange(101, 133, dtype=np.uint64)) | np.uint64(1)
_EPS = 1e-9


def need(t: float, size: int | np.ndarray) -> int | np.ndarray:
    return np.ceil(t * size - _EPS).astype(np.int64) if isinstance(size, np.ndarray) else math.ceil(t * size - _EPS)


def gram_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """The distinct n-grams of each text as sorted hashes."""
    data = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    h, start, _ = word_hashes(b" ".join(data))
    begins = np.searchsorted(start, np.concatenate(([0], np.cumsum([len(d) + 1 for d in data]))))
    whole = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for j in range(n):
        whole += h[j : len(h) - n + 1 + j] * _FACTORS[j]
    mix(whole)
    out = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(whole[a : b - n + 1]))
        elif b > a:
            out.append(mix((h[a:b] * _FACTORS[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def class_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash for each set."""
    return np.array([int(mix(mix(s.copy()).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s)))[0]) for s in sets], np.uint64)


class Packed:
    """Blocks of entries that belong to owners: owner hash and number of entries, columns by owner, columns by entry."""

    @staticmethod
    def write(owner: np.ndarray, count: np.ndarray, by_owner: tuple[np.ndarray, ...], *entries: np.ndarray) -> bytes:
        if len(count) and count.max() > MOST:  # an owner of more entries stands there several times
            times = -(-count // MOST)
            last = np.cumsum(times) - 1
            owner, by_owner = np.repeat(owner, times), tuple(np.repeat(x, times) for x in by_owner)
            rest = count - (times - 1) * MOST
            count = np.full(len(owner), MOST)
            count[last] = rest
        columns = [np.array([len(owner), int(count.sum())], np.uint32), owner.astype(np.uint64), count.astype(np.uint16), *by_owner, *entries]
        return b"".join(np.ascontiguousarray(x).tobytes() for x in columns)

    @staticmethod
    def read(raw: pa.Buffer, by_owner: tuple, *entries: type | int) -> tuple[np.ndarray, ...]:
        """(owner, count, columns by owner, columns by entry); a column is given by its type, or by the number of bytes of a shortened uint64."""
        owners, total = np.frombuffer(raw, np.uint32, 2).tolist()
        at, out = 8, []
        for n, t in [(owners, np.uint64), (owners, np.uint16), *((owners, t) for t in by_owner), *((total, t) for t in entries)]:
            if isinstance(t, int):
                out.append(widened(np.frombuffer(raw, np.uint8, n * t, at), t))
                at += n * t
            else:
                out.append(np.frombuffer(raw, t, n, at))
                at += n * np.dtype(t).itemsize
        return tuple(out)


def widened(raw: np.ndarray, size: int) -> np.ndarray:
    wide = np.zeros((len(raw) // size, 8), np.uint8)
    wide[:, :size] = raw.reshape(-1, size)
    return wide.view(np.uint64).ravel()


def shortened(x: np.ndarray) -> np.ndarray:
    """The lower 6 bytes."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :6]


def by_bucket(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(bounds)).tolist():
        yield b, order[bounds[b] : bounds[b + 1]]


def spread(bucket: int) -> np.uint64:
    """48 bits that tell equal hashes of different buckets apart."""
    return mix(np.array([bucket + 1], np.uint64))[0] >> np.uint64(16)


def starts(sorted_values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]]) if len(sorted_values) else np.empty(0, np.int64)


_BLOCK = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("block", pa.binary())])
MEMBERS, ENTRIES, HOT = 0, 1, 2


def _rows(rows: list[tuple[int, int, bytes]], places: list[int] | None = None) -> pa.RecordBatch:
    """places: what stands for each bucket in the table (see bucket_keys)."""
    bucket, kind, block = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array([places[b] for b in bucket] if places else bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(block, pa.binary())], names=_BLOCK.names)


def class_buckets(owner: np.ndarray, buckets: int) -> np.ndarray:
    return ((owner >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def listed(gram: np.ndarray, bucket: int) -> np.ndarray:
    """What stands for an n-gram from step 2 on: 48 bits, from those of its hash that its list has."""
    return gram ^ spread(bucket)


def map_block(ids: np.ndarray, ties: np.ndarray, texts: list[str], n: int, buckets: int, hot: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Step 1, map side: members, in any bucket, and n-grams by bucket, hot ones by class. hot: sorted hashes."""
    sets = gram_sets(texts, n)
    some = np.array([len(s) > 0 for s in sets], bool)
    if not some.any():
        return
    ids, ties, sets = ids[some], ties[some], [s for s in sets if len(s)]
    owner = class_hashes(sets)
    yield int(owner[0] % np.uint64(buckets)), MEMBERS, np.concatenate([owner.view(np.int64), ids, ties]).tobytes()
    _, first = np.unique(owner, return_index=True)
    sizes = np.array([len(sets[i]) for i in first])
    grams, local = np.concatenate([sets[i] for i in first]), np.repeat(np.arange(len(first)), sizes)
    owner = owner[first]

    def packed(rows: np.ndarray, gram: np.ndarray) -> bytes:
        present, count = np.unique(local[rows], return_counts=True)  # rows are in order of local
        return Packed.write(owner[present], count, (sizes[present].astype(np.uint32),), shortened(gram))

    if len(hot):
        where = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
        is_hot = hot[where] == grams
        some = np.flatnonzero(is_hot)
        by_gram = grams[some] >> np.uint64(16)
        for b in np.unique(grams[some] % np.uint64(buckets)).tolist():
            own = grams[some] % np.uint64(buckets) == b
            by_gram[own] = listed(by_gram[own], b)
        for b, rows in by_bucket(class_buckets(owner[local[some]], buckets), buckets):
            yield b, HOT, packed(some[rows], by_gram[rows])
        grams, local = grams[~is_hot], local[~is_hot]
    for b, rows in by_bucket((grams % np.uint64(buckets)).astype(np.int64), buckets):
        yield b, ENTRIES, packed(rows, grams[rows] >> np.uint64(16))


def shared_grams(blocks: list[pa.Buffer], bucket: int, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """Step 1, reduce side: the n-grams of one bucket that several classes have, by class. Frequencies only order n-grams, so those beyond 16 bits count as equal."""
    owner, count, size, gram = (np.concatenate(x) for x in zip(*(Packed.read(b, (np.uint32,), 6) for b in blocks)))
    blocks.clear()
    row = np.repeat(np.arange(len(owner), dtype=np.int32), count)
    order = np.argsort(gram)
    gram = gram[order]
    at = starts(gram)
    lengths = np.diff(np.r_[at, len(gram)])
    several = np.repeat(lengths > 1, lengths)
    gram, row = gram[several], row[order[several]]
    who = owner[row]
    order = np.lexsort((who, gram))
    gram, who, row = gram[order], who[order], row[order]
    fresh = np.r_[True, (gram[1:] != gram[:-1]) | (who[1:] != who[:-1])] if len(gram) else np.empty(0, bool)
    gram, who, row = gram[fresh], who[fresh], row[fresh]
    at = starts(gram)
    lengths = np.diff(np.r_[at, len(gram)])
    df = np.repeat(lengths, lengths)
    keep = df > 1
    gram, who, row, df = listed(gram[keep], bucket), who[keep], row[keep], np.minimum(df[keep], MOST)
    order = np.argsort(who, kind="stable")
    gram, who, row, df = gram[order], who[order], row[order], df[order]
    for b, rows in by_bucket(class_buckets(who, buckets), buckets):
        at = starts(who[rows])
        yield b, ENTRIES, Packed.write(who[rows[at]], np.diff(np.r_[at, len(rows)]), (size[row[rows[at]]],), shortened(gram[rows]), df[rows].astype(np.uint16))


CLASSES = "owner long, size int, home long, grams binary, prefix int"


def class_rows(entries: list[pa.Buffer], hot: list[pa.Buffer], t: float) -> Iterator[pa.RecordBatch]:
    """Step 2: classes whose prefix holds a shared n-gram, with their shared n-grams by frequency, those of the hot list last."""
    parts = [Packed.read(b, (np.uint32,), 6, np.uint16) for b in entries]
    parts += [(*x, np.full(len(x[3]), MOST, np.uint16)) for x in (Packed.read(b, (np.uint32,), 6) for b in hot)]
    owner, count, size, gram, df = (np.concatenate(x) for x in zip(*parts))
    who, size = np.repeat(owner, count), np.repeat(size, count)
    order = np.lexsort((gram, df, who))
    who, size, gram, df = who[order], size[order].astype(np.int64), gram[order], df[order]
    if hot and len(who):  # a class's hot n-grams come from every block that has a copy
        fresh = np.r_[True, (who[1:] != who[:-1]) | (gram[1:] != gram[:-1])]
        who, size, gram, df = who[fresh], size[fresh], gram[fresh], df[fresh]
    lo = starts(who)
    hi = np.r_[lo[1:], len(who)]
    owner, size = who[lo], size[lo]
    prefix = np.minimum(np.maximum(0, size - need(t, size) + 1 - (size - (hi - lo))), hi - lo)
    picked = np.flatnonzero(prefix > 0)
    frequent = df >= np.repeat(df[(lo + hi) // 2] / 2, hi - lo)
    home = np.minimum.reduceat(np.where(frequent, gram, np.uint64(2**64 - 1)), lo) if len(lo) else gram
    for at in range(0, len(picked), 2048):
        part = picked[at : at + 2048]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(owner[part].view(np.int64)),
                pa.array(size[part].astype(np.int32)),
                pa.array(home[part].view(np.int64)),
                pa.array([shortened(gram[lo[i] : hi[i]]).tobytes() for i in part], pa.binary()),
                pa.array(prefix[part].astype(np.int32)),
            ],
            names=["owner", "size", "home", "grams", "prefix"],
        )


def prefix_blocks(batch: pa.RecordBatch, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """Step 3, map side: the prefixes' n-grams by bucket, each with what a class still can share from it on."""
    owner, size, home, prefix = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("owner", "size", "home", "prefix"))
    raw = [g.as_buffer() for g in batch.column("grams")]
    gram = np.concatenate([widened(np.frombuffer(g, np.uint8, 6 * p), 6) for g, p in zip(raw, prefix.tolist())])
    left = np.concatenate([g.size // 6 - np.arange(p, dtype=np.uint32) for g, p in zip(raw, prefix.tolist())]).astype(np.uint32)
    row = np.repeat(np.arange(len(owner)), prefix)
    for b, at in by_bucket((gram % np.uint64(buckets)).astype(np.int64), buckets):
        present, count = np.unique(row[at], return_counts=True)  # at is in order of row
        yield b, ENTRIES, Packed.write(owner.view(np.uint64)[present], count, (size[present].astype(np.uint32), home[present]), shortened(gram[at]), left[at])


def meetings(blocks: list[pa.Buffer], t: float) -> np.ndarray:
    """Step 3, reduce side: rows (owner, home, home) of the cells that a class has to join."""
    owner, count, size, home, gram, left = (np.concatenate(x) for x in zip(*(Packed.read(b, (np.uint32, np.int64), 6, np.uint32) for b in blocks)))
    owner, size, home = (np.repeat(x, count) for x in (owner.view(np.int64), size.astype(np.int64), home))
    order = np.lexsort((home, gram))
    owner, size, gram, home, left = owner[order], size[order], gram[order], home[order], left[order].astype(np.int64)
    largest = np.floor(left * (1 + t) / t + _EPS).astype(np.int64) - size  # of a partner whose first shared n-gram this is (positional filter)
    group = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (home[1:] != home[:-1])])  # entries of one n-gram and home
    g_gram, g_home, g_count = gram[group], home[group], np.diff(np.r_[group, len(gram)])
    g_min, g_max = np.minimum.reduceat(size, group), np.maximum.reduceat(size, group)
    run = starts(g_gram)
    per_run = np.diff(np.r_[run, len(g_gram)])
    run_of_entry = np.repeat(np.repeat(np.arange(len(run)), per_run), g_count)
    own = np.repeat(np.arange(len(group)), g_count)
    fan = per_run[run_of_entry]
    lonely = (fan == 1) & (g_count[own] == 1)
    found = []
    entries = np.flatnonzero(~lonely)
    ends = np.cumsum(fan[entries])
    lo = 0
    while lo < len(entries):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + (1 << 20))))
        e = np.repeat(entries[lo:hi], fan[entries[lo:hi]])
        u = run[run_of_entry[e]] + np.arange(len(e)) - np.repeat(np.cumsum(fan[entries[lo:hi]]) - fan[entries[lo:hi]], fan[entries[lo:hi]])
        lo = hi
        good = (g_max[u] >= need(t, size[e])) & (need(t, g_min[u]) <= size[e]) & (g_min[u] <= largest[e]) & ((u != own[e]) | (g_count[u] > 1))
        e, u = e[good], u[good]
        found.append(np.unique(np.stack([owner[e], np.minimum(home[e], g_home[u]), np.maximum(home[e], g_home[u])], axis=1), axis=0))
    return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 3), np.int64)


def merge_counts(lists: list[np.ndarray], weights: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(records, occurrences) over sorted lists, each of which counts by its weight: a merge by a heap of the lists' next records, that is of numbers of record and list."""
    if not lists:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bits = len(lists).bit_length()
    mask = (1 << bits) - 1
    following = [iter((x.astype(np.int64) << bits | i).tolist()).__next__ for i, x in enumerate(lists)]
    heap = [x() for x in following]
    heapq.heapify(heap)
    merged: list[int] = []
    add, replace = merged.append, heapq.heapreplace
    while heap:
        try:
            while True:
                top = heap[0]
                add(top)
                replace(heap, following[top & mask]())
        except StopIteration:  # that list has ended
            heapq.heappop(heap)
    both = np.array(merged)
    records = both >> bits
    at = starts(records)
    return records[at], np.add.reduceat(np.array(weights)[both & mask], at)


def divide_skip(lists: list[np.ndarray], weights: list[int], least: int, cost: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """(records, occurrences) of the records whose lists weigh at least ``least``; no list is empty."""
    order = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    longest = len(lists[order[-1]]) if lists else 0
    most = min(least - 1, int(least / (cost * math.log2(longest + 2) + 1)))
    aside, held = len(order), 0
    while aside and held + weights[order[aside - 1]] <= most:
        aside -= 1
        held += weights[order[aside]]
    records, counts = merge_counts([lists[i] for i in order[:aside]], [weights[i] for i in order[:aside]])
    keep = counts >= least - held
    records, counts = records[keep], counts[keep]
    for i in reversed(order[aside:]):
        if not len(records):
            break
        x = lists[i]
        at = np.minimum(np.searchsorted(x, records), len(x) - 1)
        counts = counts + weights[i] * (x[at] == records)
    keep = counts >= least
    return records[keep], counts[keep]


def dense_counts(at: np.ndarray, end: np.ndarray, record: np.ndarray, weights: np.ndarray, sizes: np.ndarray, queries: int, two: bool, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, partner, occurrences) of the pairs of a large cell that may be similar, from its different lists record[at:end] and their weights."""
    lengths = end - at
    entry = np.repeat(at - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
    record, of = record[entry], np.repeat(np.arange(len(at)), lengths)
    kind = np.float32 if sizes.max() < 1 << 23 else np.float64  # whole numbers up to twice that are exact
    counts = np.zeros((queries, len(sizes)), kind)
    long = np.flatnonzero(lengths * LONG > len(sizes))
    wide = max(1, DENSE_VALUES // len(sizes))
    for lo in range(0, len(long), wide):
        column = np.full(len(at), -1)
        column[long[lo : lo + wide]] = np.arange(len(long[lo : lo + wide]))
        some = column[of] >= 0
        there = np.zeros((len(sizes), min(wide, len(long) - lo)), kind)
        there[record[some], column[of[some]]] = 1
        times = there[:queries] * weights[long[lo : lo + wide]].astype(kind)
        for q in range(0, queries, 256):
            first = queries if two else q
            counts[q : q + 256, first:] += times[q : q + 256] @ there[first:].T
    short = lengths * LONG <= len(sizes)
    own = np.flatnonzero(short[of] & (record < queries))
    own = own[np.argsort(record[own], kind="stable")]
    bounds = np.searchsorted(record[own], np.arange(queries + 1))
    begin = np.r_[0, np.cumsum(lengths)]
    found = [(np.empty(0, np.int64),) * 3]
    for i in range(queries):
        first = queries if two else i + 1
        lists, times = [], []
        for k in of[own[bounds[i] : bounds[i + 1]]].tolist():
            x = record[begin[k] : begin[k + 1]]
            if x[-1] >= first:
                lists.append(x[np.searchsorted(x, first) :])
                times.append(int(weights[k]))
        partner, shared = merge_counts(lists, times)
        counts[i, partner] += shared
        partner = first + np.flatnonzero(counts[i, first:] * (1 + t) >= t * (sizes[i] + sizes[first:]) - 1)
        found.append((np.full(len(partner), i), partner, counts[i, partner].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found))


def search_cell(sets: list[np.ndarray], sizes: np.ndarray, two: bool, side: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Step 4: pairs of records (i < j) of a cell with their similarity; two: only those of different sides."""
    found = [(np.empty(0, np.int64),) * 3]
    order = np.argsort(side, kind="stable") if two else np.arange(len(sets))  # the other side's records come last
    sets, sizes = [sets[k] for k in order.tolist()], sizes[order]
    queries = int((~side).sum()) if two else len(sets)
    if two and queries in (0, len(sets)):
        pass
    elif len(sets) == 2:
        found.append(tuple(np.array([x]) for x in (0, 1, len(np.intersect1d(sets[0], sets[1], assume_unique=True)))))
    else:
        gram = np.concatenate(sets)
        record = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        by = np.argsort(gram, kind="stable")
        gram, record = gram[by], record[by]
        at = starts(gram)
        end = np.r_[at[1:], len(gram)]
        keys = gram[at]
        sums = np.add.reduceat(mix(record.astype(np.uint64) + np.uint64(1)), at) if len(at) else np.empty(0, np.uint64)
        _, like, same = np.unique(sums, return_index=True, return_inverse=True)  # n-grams of the same records share a list
        dense = len(sets) >= DENSE
        if dense:
            found.append(dense_counts(at[like], end[like], record, np.bincount(same), sizes, queries, two, t))
        for i, s in enumerate([] if dense else sets[:queries]):
            least = int(need(t, int(sizes[i])))
            first = queries if two else i + 1  # of two partners the first one is the query
            lists, weights = [], []
            for k, w in zip(*(x.tolist() for x in np.unique(same[np.searchsorted(keys, s)], return_counts=True))):
                x = record[at[like[k]] : end[like[k]]]
                if x[-1] >= first:
                    lists.append(x[np.searchsorted(x, first) :])
                    weights.append(w)
            if sum(weights) >= least:
                partner, shared = divide_skip(lists, weights, least)
                found.append((np.full(len(partner), i), partner, shared))
    i, j, shared = (np.concatenate(x) for x in zip(*found))
    jaccard = shared / np.maximum(1, sizes[i] + sizes[j] - shared)
    good = jaccard >= t - _EPS
    i, j = order[i[good]], order[j[good]]
    return np.minimum(i, j), np.maximum(i, j), jaccard[good]


def hot_grams(docs: DataFrame, n: int) -> np.ndarray:
    """Sorted hashes of the n-grams that more than HOT_SHARE of a sample of about SAMPLE documents have. It decides where n-grams travel, not what is found."""
    count = docs.count()
    if not count:
        return np.empty(0, np.uint64)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found, times = np.unique(np.concatenate([np.empty(0, np.uint64), *gram_sets(texts, n)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times)], names=["gram", "times"])

    some = docs.select("text").sample(min(1.0, SAMPLE / count), 11).mapInArrow(grams, "gram long, times long")
    least = max(HOT_LEAST, min(SAMPLE, count) * HOT_SHARE)  # so at most the sample's n-grams divided by this number are hot
    rows = some.groupBy("gram").agg(F.sum("times").alias("times")).where(F.col("times") > least).select("gram").toArrow()
    return np.sort(rows.column("gram").to_numpy().view(np.uint64))


def shared_entries(docs: DataFrame, n: int) -> tuple[DataFrame, int]:
    """Step 1; written to the shared folder: (bucket, kind, block), and the number of buckets."""
    source = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    buckets = size_buckets(source)
    places = bucket_keys(buckets)
    hot = hot_grams(source, n)
    block_bytes = min(32 * BLOCK_BYTES, max(BLOCK_BYTES, buckets << 10))  # the more buckets, the more text a block must hold for its parts not to be tiny

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            sizes = np.cumsum([len(x) for x in texts])
            lo = 0
            while lo < len(texts):
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + block_bytes)))
                rows = list(map_block(ids[lo:hi], ties[lo:hi], texts[lo:hi], n, buckets, hot))
                if rows:
                    yield _rows(rows, places)
                lo = hi

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.Buffer]] = {}
        for batch in batches:
            kind = batch.column(1).to_numpy()
            passing = np.flatnonzero(kind != ENTRIES)
            if len(passing):
                yield batch.take(pa.array(passing))
            for i in np.flatnonzero(kind == ENTRIES).tolist():
                held.setdefault(batch.column(0)[i].as_py(), []).append(batch.column(2)[i].as_buffer())
        for b in list(held):
            rows = list(shared_grams(held.pop(b), b, buckets))
            if rows:
                yield _rows(rows, places)

    blocks = source.mapInArrow(emit, "bucket int, kind int, block binary")
    return written(blocks.repartition(buckets, "bucket").mapInArrow(share, "bucket int, kind int, block binary"), "ngram-shared"), buckets


def members(shared: DataFrame) -> DataFrame:
    """(owner, doc_id, tie): the class of every document with words, and the hash of its text."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column("block"):
                x = np.frombuffer(block.as_buffer(), np.int64).reshape(3, -1)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in x], names=["owner", "doc_id", "tie"])

    return shared.where(F.col("kind") == MEMBERS).select("block").mapInArrow(unpack, "owner long, doc_id long, tie long")


def active_classes(shared: DataFrame, buckets: int, t: float) -> DataFrame:
    """Step 2; written to the shared folder."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[pa.Buffer], list[pa.Buffer]]] = {}
        for batch in batches:
            for b, kind, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                held.setdefault(b, ([], []))[kind == HOT].append(block.as_buffer())
        for b in list(held):
            yield from class_rows(*held.pop(b), t)

    return written(shared.where(F.col("kind") != MEMBERS).repartition(buckets, "bucket").mapInArrow(collect, CLASSES), "ngram-classes")


def cell_links(owner: np.ndarray, i: np.ndarray, j: np.ndarray, jaccard: np.ndarray) -> tuple[np.ndarray, ...]:
    """Step 5: (owner, links, best, root) of the classes that have links."""
    links, best, root = np.bincount(np.concatenate([i, j]), minlength=len(owner)), np.zeros(len(owner)), owner.copy()
    while True:
        least, old = np.minimum(root[i], root[j]), root.copy()
        for x in (i, j):
            np.minimum.at(root, x, least)
        if (root == old).all():
            break
    for x in (i, j):
        np.maximum.at(best, x, jaccard)
    some = links > 0
    return owner[some], links[some], best[some], root[some]


def cell_pairs(owner: np.ndarray, i: np.ndarray, j: np.ndarray, jaccard: np.ndarray) -> tuple[np.ndarray, ...]:
    return owner[i], owner[j], jaccard


def searched(active: DataFrame, buckets: int, t: float, result: Callable[..., tuple[np.ndarray, ...]], schema: str) -> DataFrame:
    """Steps 3 to 5: what result makes of the pairs of each cell."""
    places = bucket_keys(buckets)
    names = [x.split()[0] for x in schema.split(", ")]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                yield _rows(list(prefix_blocks(batch.slice(lo, 4096), buckets)), places)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [block.as_buffer() for batch in batches for block in batch.column("block")]
        if held:
            rows = meetings(held, t)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(3)], names=["owner", "a", "b"])

    def solve(rows: list[dict]) -> tuple[np.ndarray, ...]:
        first = rows[0]
        homes, blocks = first["a"] != first["b"], first["i"] != first["j"]
        home, block = np.array([r["home"] == r["b"] for r in rows]), np.array([r["block"] == first["j"] for r in rows])
        i, j, x = search_cell([np.sort(widened(np.frombuffer(r["grams"], np.uint8), 6)) for r in rows], np.array([r["size"] for r in rows], np.int64), homes or blocks, home if homes else block, t)
        if homes and blocks:
            good = block[i] != block[j]
            i, j, x = i[good], j[good], x[good]
        return result(np.array([r["owner"] for r in rows], np.int64), i, j, x)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows, out, held = None, [], [], 0

        def batch_of(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=names)

        for batch in batches:
            for r in batch.to_pylist():
                if (r["a"], r["b"], r["i"], r["j"]) != cell:
                    if len(rows) > 1:
                        out.append(solve(rows))
                        held += len(out[-1][0])
                    cell, rows = (r["a"], r["b"], r["i"], r["j"]), []
                    if held > 4096:
                        yield batch_of(out)
                        out, held = [], 0
                rows.append(r)
        if len(rows) > 1:
            out.append(solve(rows))
        if out:
            yield batch_of(out)

    blocks = active.select("owner", "size", "home", "grams", "prefix").mapInArrow(emit, "bucket int, kind int, block binary")
    cells = written(blocks.repartition(buckets, "bucket").mapInArrow(meet, "owner long, a long, b long").distinct(), "ngram-cells")
    large = cells.groupBy("a", "b").agg(F.ceil(F.count("*") / CELL).cast("int").alias("parts")).where("parts > 1")
    small = large.count() <= BROADCAST_ROWS
    cells = cells.join(F.broadcast(large) if small else large, ["a", "b"], "left").withColumn("block", F.pmod(F.hash("owner"), F.coalesce("parts", F.lit(1))))
    other = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    cells = cells.select("owner", "a", "b", "block", other.alias("other")).select("owner", "a", "b", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    full = cells.join(active.select("owner", "size", "home", "grams"), "owner")
    return full.repartition(buckets, "a", "b", "i", "j").sortWithinPartitions("a", "b", "i", "j").mapInArrow(search, schema)


def pairs(docs: DataFrame, n: int = N, t: float = THRESHOLD) -> DataFrame:
    """(class_id, match_id, jaccard): every pair of similar classes, by the least doc_id of each, class_id < match_id but for a doc_id with several texts. In a group of m classes there may be m * m / 2 of them."""
    shared, buckets = shared_entries(docs, n)
    ids = members(shared).groupBy("owner").agg(F.min("doc_id").alias("id"))
    found = searched(active_classes(shared, buckets, t), buckets, t, cell_pairs, "a long, b long, jaccard double")
    both = found.join(ids.select(F.col("owner").alias("a"), F.col("id").alias("x")), "a").join(ids.select(F.col("owner").alias("b"), F.col("id").alias("y")), "b")
    return both.select(F.least("x", "y").alias("class_id"), F.greatest("x", "y").alias("match_id"), F.round("jaccard", 6).alias("jaccard"))


def groups(docs: DataFrame, n: int = N, t: float = THRESHOLD) -> DataFrame:
    """(doc_id, tie, class_id, group_id, copies, links, best) of the documents that have a copy or a link; tie is the hash of the text."""
    shared, buckets = shared_entries(docs, n)
    who = members(shared)
    classes = who.select("owner", "doc_id").distinct().groupBy("owner").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"))
    found = written(searched(active_classes(shared, buckets, t), buckets, t, cell_links, "owner long, links long, best double, root long"), "ngram-links")
    roots = components(found.where("owner <> root").select(F.col("owner").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("owner").agg(F.sum("links").alias("links"), F.max("best").alias("best"))
    about = classes.join(links, "owner", "left").where("copies > 1 OR links > 0").join(roots.withColumnRenamed("node", "owner"), "owner", "left").withColumn("root", F.coalesce("root", "owner"))
    about = written(about, "ngram-about")
    least = about.groupBy("root").agg(F.min("class_id").alias("group_id"))
    # the many members of one class are rows of the join's larger side, which adaptive execution can split
    return who.distinct().join(about.join(least, "root").drop("root"), "owner").select("doc_id", "tie", "class_id", "group_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.round("best", 6).alias("best"))


def join(docs: DataFrame, n: int = N, t: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, group_id, copies, links, best): a row for every document that has a partner. class_id is the least doc_id of its class (documents of equal
    sets), copies their number; links is the number of other classes that are similar, best the largest of those similarities (NULL without links);
    group_id is the least doc_id that links lead to."""
    return groups(docs, n, t).drop("tie").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of edges (a, b): root is the least node that can be reached. Each round takes the least label around a node and then that label's own; rounds grow with the
    logarithm of a component's width. Each round's table is written to the shared folder and the one before removed."""
    both = written(edges.union(edges.select("b", "a")).distinct(), "edges")
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        around = both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = label.join(around, "node").select("node", F.least("root", "near").alias("next"), "root")
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("far"))
        new = written(step.join(jump, "next", "left").select("node", F.least("next", F.coalesce("far", "next")).alias("root"), F.col("root").alias("old")), "labels")
        discard(label)
        label = new
        if new.where("root <> old").isEmpty():
            discard(both)
            return label.select("node", "root")


def repeats(docs: DataFrame, n: int = N, t: float = THRESHOLD) -> DataFrame:
    """(doc_id, tie, kept_id): the documents that go if of each group the one with the least doc_id stays; tie is the hash of the text."""
    return groups(docs, n, t).where("doc_id <> group_id").select("doc_id", "tie", F.col("group_id").alias("kept_id"))


def dedup_documents(docs: DataFrame, n: int = N, t: float = THRESHOLD) -> DataFrame:
    """docs with one document of each group, that with the least doc_id. Texts of one doc_id are judged each on its own, equal rows alike; rows without id or text stay."""
    gone_id, gone_tie = free_names(docs, "__gone_id", "__gone_tie")
    gone = written(repeats(docs, n, t).select(F.col("doc_id").alias(gone_id), F.col("tie").alias(gone_tie)), "ngram-gone")
    small = gone.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if small else gone, (docs["doc_id"].cast("long") == F.col(gone_id)) & (F.xxhash64(docs["text"]) == F.col(gone_tie)), "left_anti")


def sql(docs: str = "documents", n: int = N, t: float = THRESHOLD) -> str:
    grams = f"CASE WHEN len(w) >= {n} THEN list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"
    return f"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'), lambda x: x <> '') AS w
  FROM {docs} WHERE doc_id IS NOT NULL AND text IS NOT NULL),
sets AS (SELECT doc_id, list_sort(list_distinct({grams})) AS g FROM words),
classes AS MATERIALIZED (SELECT g, list_sort(list(DISTINCT doc_id)) AS docs, len(g) AS size, row_number() OVER () AS c FROM sets WHERE len(g) > 0 GROUP BY g),
entries AS (SELECT c, size, unnest(g) AS gram FROM classes),
pairs AS (SELECT x.c AS a, y.c AS b, x.size AS sa, y.size AS sb, count(*) AS shared FROM entries x JOIN entries y ON x.gram = y.gram AND x.c < y.c GROUP BY ALL),
good AS (SELECT a, b, shared / (sa + sb - shared) AS jaccard FROM pairs WHERE shared / (sa + sb - shared) >= {t} - 1e-9),
ways AS MATERIALIZED (SELECT a, b, jaccard FROM good UNION ALL SELECT b, a, jaccard FROM good),
reach AS (SELECT c AS a, c AS b FROM classes WHERE c IN (SELECT a FROM ways) UNION SELECT reach.a, ways.b FROM reach JOIN ways ON ways.a = reach.b),
roots AS (SELECT reach.a AS c, min(docs[1]) AS root FROM reach JOIN classes ON c = reach.b GROUP BY reach.a),
links AS (SELECT a AS c, count(*) AS links, round(max(jaccard), 6) AS best FROM ways GROUP BY a)
SELECT unnest(docs) AS doc_id, docs[1] AS class_id, coalesce(root, docs[1]) AS group_id, len(docs) AS copies, coalesce(links, 0) AS links, best
FROM classes LEFT JOIN links USING (c) LEFT JOIN roots USING (c) WHERE len(docs) > 1 OR links > 0
"""
