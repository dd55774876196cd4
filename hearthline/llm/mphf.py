"""A minimal perfect hash of distinct 64-bit keys, built in buckets by Spark's tasks.

Each bucket lays its keys on levels of bits: a key that falls alone on a bit of a level stays there,
the others go on to the next level. The rank of a key's bit among all bits set is its index, so that
n keys have the indexes 0 to n - 1. The hash knows no keys: a number that is none of them may get an
index too, so the keys are kept by index and every answer is verified.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import mixed

_U = np.uint64
#: Keys of a bucket, on average, and bits of a level per key that reaches it.
BUCKET, ROOM = 4_096, 2
_STEP = _U(0x9E3779B97F4A7C15)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (((mixed(keys.astype(np.uint64) ^ _STEP) >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


def _spot(keys: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    return (mixed(keys.astype(np.uint64) + _U((level + 1) * int(_STEP) & ((1 << 64) - 1))) % np.asarray(size).astype(np.uint64)).astype(np.int64)


def _lay(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sizes of the levels in bits, the words of all levels, and the keys in the order of their bits."""
    sizes, words, placed, level = [], [], [], 0
    while len(keys):
        size = 64 * -(-ROOM * len(keys) // 64)
        spot = _spot(keys, level, size)
        alone = np.bincount(spot, minlength=size)[spot] == 1
        bits = np.zeros(size, np.uint8)
        bits[spot[alone]] = 1
        words.append(np.packbits(bits, bitorder="little").view("<u8"))
        placed.append(keys[alone][np.argsort(spot[alone])])
        sizes.append(size)
        keys, level = keys[~alone], level + 1
    return sizes, np.concatenate(words), np.concatenate(placed)


class PerfectHash:
    """Looks up the index of keys; numbers that are no keys get -1."""

    def __init__(self, rows: Iterable, buckets: int):
        """``rows`` has (bucket, sizes, words, keys) of every bucket that holds a key."""
        rows = sorted(rows, key=lambda r: r[0])
        levels = max((len(r[1]) for r in rows), default=0)
        self.buckets = buckets
        self.size = np.zeros((levels, buckets), np.int64)
        self.start = np.zeros((levels, buckets), np.int64)
        at = 0
        for bucket, sizes, _, _ in rows:
            for level, size in enumerate(sizes):
                self.size[level, bucket], self.start[level, bucket] = size, at
                at += size // 64
        self.words = np.frombuffer(b"".join(bytes(r[2]) for r in rows), "<u8")
        self.keys = np.frombuffer(b"".join(bytes(r[3]) for r in rows), "<i8")
        held = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(held) - held

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        open_, bucket = np.arange(len(keys)), _bucket(keys, self.buckets)
        for level in range(len(self.size)):
            size = self.size[level, bucket[open_]]
            open_, size = open_[size > 0], size[size > 0]
            if not len(open_):
                break
            spot = _spot(keys[open_], level, size)
            word = self.start[level, bucket[open_]] + spot // 64
            bit = (spot % 64).astype(np.uint64)
            hit = (self.words[word] >> bit) & _U(1) == 1
            below = self.words[word[hit]] & ((_U(1) << bit[hit]) - _U(1))
            out[open_[hit]] = self.before[word[hit]] + np.bitwise_count(below)
            open_ = open_[~hit]
        known = out >= 0
        out[known] = np.where(self.keys[out[known]] == keys[known], out[known], -1)
        return out


def build(keys: DataFrame, count: int, bucket_keys: int = BUCKET) -> PerfectHash:
    """The hash of the distinct longs in the only column of ``keys``; ``count`` is their number.

    Buckets are built in parallel. What comes to the driver is about 9 bytes a key, so the caller
    bounds ``count``. A null key or a repeated one is an error; no keys give a hash that knows none.
    """
    buckets = max(1, -(-count // bucket_keys))
    name = keys.columns[0]

    def dealt(batches):
        for batch in batches:
            own = np.asarray(batch.column(0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(_bucket(own, buckets).astype(np.int32)), pa.array(own)], names=["bucket", "key"])

    def lay(group: pa.Table) -> pa.Table:
        own = np.asarray(group.column("key"), np.int64)
        if len(np.unique(own)) < len(own):
            raise ValueError("a key is repeated")
        sizes, words, placed = _lay(own)
        return pa.table(
            {
                "bucket": pa.array([group.column("bucket")[0].as_py()], pa.int32()),
                "sizes": pa.array([sizes], pa.list_(pa.int32())),
                "words": pa.array([words.tobytes()], pa.binary()),
                "keys": pa.array([placed.astype("<i8").tobytes()], pa.binary()),
            }
        )

    rows = keys.select(F.col(name).alias("key")).mapInArrow(dealt, "bucket int, key long")
    rows = rows.groupBy("bucket").applyInArrow(lay, "bucket int, sizes array<int>, words binary, keys binary").collect()
    found = PerfectHash(rows, buckets)
    if len(found) != count:
        raise ValueError(f"{count} keys were announced, {len(found)} came")
    return found
