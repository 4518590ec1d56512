"""Minimal perfect hashing of 64-bit keys: n distinct keys get the numbers 0 to n - 1.

Keys are dealt into buckets by their hash, and each bucket is built by itself. A bucket
has levels of bits: every key that alone hashes to a bit of the first level sets it, the
others try the next level. The number of a key is the number of set bits before its own,
over all levels of all buckets in order, so buckets that were built apart are one hash as
soon as their words stand in a row.

Any key outside the set may get a number too. Whoever looks one up compares it with the
key kept under that number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import mixed

BUCKET_KEYS = 1 << 13  # keys of a bucket on average
MAX_LEVELS = 64
BUILT = "bucket int, n int, levels array<int>, words binary, keys binary"
_BUCKET_SEED = np.uint64(0xA0761D6478BD642F)


def buckets_for(n_keys: int) -> int:
    return max(1, -(-n_keys // BUCKET_KEYS))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(keys ^ _BUCKET_SEED) % np.uint64(buckets)).astype(np.int64)


def _level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    return mixed(keys ^ mixed(np.full(1, level + 1, np.uint64)))


def built(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Words per level, and the words of all levels, of a set of distinct keys."""
    sizes, words = [], []
    while len(keys):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("keys of a perfect hash must be distinct")
        size = -(-2 * len(keys) // 64)
        place = (_level_hash(keys, len(sizes)) % np.uint64(64 * size)).astype(np.int64)
        alone = np.bincount(place, minlength=64 * size) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        keys = keys[~alone[place]]
    return sizes, np.concatenate(words) if words else np.empty(0, np.uint64)


class PerfectHash:
    """The hash of the buckets `first` and following, as made by `build`."""

    def __init__(self, first: int, buckets: int, levels: list[list[int]], words: list[bytes]):
        self.first, self.buckets, self.held = first, buckets, len(levels)
        depth = max(map(len, levels), default=0)
        self.size = np.zeros((self.held, depth), np.int64)
        for i, sizes in enumerate(levels):
            self.size[i, : len(sizes)] = sizes
        ends = np.cumsum(self.size.ravel())
        self.start = (ends - self.size.ravel()).reshape(self.size.shape)
        self.words = np.frombuffer(b"".join(words), "<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.n = int(ones.sum())

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 if the hash shows that it is none of its own."""
        out = np.full(len(keys), -1, np.int64)
        bucket = bucket_of(keys, self.buckets) - self.first
        left = np.flatnonzero((bucket >= 0) & (bucket < self.held))
        for level in range(self.size.shape[1]):
            left = left[self.size[bucket[left], level] > 0]
            if not len(left):
                break
            b = bucket[left]
            place = (_level_hash(keys[left], level) % (64 * self.size[b, level]).astype(np.uint64)).astype(np.int64)
            at = self.start[b, level] + (place >> 6)
            bit = (place & 63).astype(np.uint64)
            word = self.words[at]
            hit = (word >> bit) & np.uint64(1) == 1
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.before[at[hit]] + np.bitwise_count(below)
            left = left[~hit]
        return out


def build(keys: DataFrame, n_keys: int) -> DataFrame:
    """One `BUILT` row per bucket of a table of distinct `key`s (BIGINT).

    `keys` holds a bucket's keys in the order of their numbers. No bucket is larger than
    the mean but by chance, so none grows with the number of keys.
    """
    buckets = buckets_for(n_keys)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = bucket_of(batch.column(0).to_numpy().view(np.uint64), buckets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bucket.astype(np.int32))], ["key", "bucket"])

    def one(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        members = group.column("key").to_numpy().view(np.uint64)
        sizes, words = built(members)
        hashed = PerfectHash(bucket, buckets, [sizes], [words.tobytes()])
        ordered = np.empty(len(members), np.uint64)
        ordered[hashed.numbers(members)] = members
        return pa.table(
            {
                "bucket": pa.array([bucket], pa.int32()),
                "n": pa.array([len(members)], pa.int32()),
                "levels": pa.array([sizes], pa.list_(pa.int32())),
                "words": pa.array([words.tobytes()], pa.binary()),
                "keys": pa.array([ordered.tobytes()], pa.binary()),
            }
        )

    return keys.select("key").mapInArrow(dealt, "key bigint, bucket int").groupBy("bucket").applyInArrow(one, BUILT)


def ranges(made: DataFrame, most_keys: int) -> Iterator[tuple[int, int]]:
    """(first bucket, end) of runs of buckets that hold at most `most_keys` each.

    Only the sizes of the buckets are read here; a bucket larger than the limit is a run.
    """
    first, end, held = None, 0, 0
    for bucket, n in made.select("bucket", "n").orderBy(F.col("bucket")).toLocalIterator():
        if first is not None and held + n > most_keys:
            yield first, end
            first, held = None, 0
        first = bucket if first is None else first
        end, held = bucket + 1, held + n
    if first is not None:
        yield first, end


def loaded(made: DataFrame, first: int, end: int, n_keys: int) -> tuple[PerfectHash, np.ndarray]:
    """The hash of a run of buckets and its keys by number."""
    rows = made.where(F.col("bucket").between(first, end - 1)).toArrow().to_pylist()
    by_bucket = {r["bucket"]: r for r in rows}
    every = [by_bucket.get(b, {"levels": [], "words": b"", "keys": b""}) for b in range(first, end)]
    hashed = PerfectHash(first, buckets_for(n_keys), [r["levels"] for r in every], [r["words"] for r in every])
    return hashed, np.frombuffer(b"".join(r["keys"] for r in every), "<u8")
