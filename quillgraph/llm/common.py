"""What the corpus operators share: written intermediate tables, buckets, word hashing."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from quillgraph.scratch import written  # noqa: F401  the operators' way to store what they build on

_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


def fitting_partitions(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


BUCKET_BYTES = 256 << 20
_UNKNOWN = 1 << 60


def size_buckets(df: DataFrame) -> int:
    """Buckets for work that holds a bucket at a time: as many as shuffle partitions, more if the input that Spark's plan expects would give a bucket over BUCKET_BYTES."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return fitting_partitions(df.sparkSession, 1 if size >= _UNKNOWN else -(-size // BUCKET_BYTES))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """names, each with as many underscores behind it as it takes not to be a column of df (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for x in names:
        while x.lower() in taken:
            x += "_"
        out.append(x)
    return out


def _murmur(k: int) -> int:
    """Spark's hash of one int (Murmur3, seed 42), unsigned."""
    m = 0xFFFFFFFF
    k = k * 0xCC9E2D51 & m
    k = (k << 15 | k >> 17) & m
    h = 42 ^ (k * 0x1B873593 & m)
    h = ((h << 13 | h >> 19) & m) * 5 + 0xE6546B64 & m
    h ^= 4
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    return h ^ h >> 16


def bucket_keys(buckets: int) -> list[int]:
    """For every bucket an int that repartition(buckets, key) sends to a partition of its own: bucket numbers themselves would share some and leave others empty."""
    keys: dict[int, int] = {}
    k = 0
    while len(keys) < buckets:
        h = _murmur(k)
        keys.setdefault((h - (1 << 32) if h >> 31 else h) % buckets, k)
        k += 1
    return [keys[b] for b in range(buckets)]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, in place."""
    h ^= h >> np.uint64(30)
    h *= _MIX_A
    h ^= h >> np.uint64(27)
    h *= _MIX_B
    h ^= h >> np.uint64(31)
    return h


#: Bytes that belong to words: ASCII letters and digits, and every byte of a character beyond ASCII.
_WORD = np.zeros(256, dtype=bool)
_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
_WORD[128:] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 16
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = _BLOCK
    while size < n:
        size *= 2
    if size not in _powers:
        _powers.clear()
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, _INVERSE, dtype=np.uint64)
        up[0] = down[0] = 1
        _powers[size] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers[size]


def word_hashes(data: bytes, prefix: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of lower-case UTF-8 data, with the positions of each word's first byte and behind its last.

    A word is a run of letters, digits and characters beyond ASCII. The hash is polynomial in the word's bytes, taken
    from prefix sums, so that no Python code runs per word. prefix: of each word only so many bytes are hashed.
    """
    b = np.frombuffer(data, dtype=np.uint8)
    inside = _WORD[b]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.empty(0, np.uint64), start, end
    up, down = _power_tables(len(b))
    sums = np.empty(len(b) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[b] * up[: len(b)], out=sums[1:])
    last = np.minimum(end, start + prefix) if prefix else end
    return mix((sums[last] - sums[start]) * down[start]), start, end


WORD_SQL = "[^0-9a-z\\x{80}-\\x{10FFFF}]+"


def words_of(text: str) -> list[str]:
    """The words that word_hashes() hashes, as strings; for tests and small inputs."""
    return re.findall("[0-9a-z\x80-\U0010ffff]+", text.lower())
