"""A minimal perfect hash of distinct 63-bit keys, built in parts by Spark tasks.

Keys are parted by hash into shards. A shard is hashed level by level: a key that falls
alone on a place of a level's bit row sets that bit, the others go on to the next level,
``GAMMA`` places for each key left. A key's number is the count of bits set before its
own, over all rows in order: 0 to the number of keys less one, without gaps.

A key that is not in the set may get a number too, so users keep the keys by number and compare.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm import winnow

#: Places for each key that is left at a level.
GAMMA = 2
#: Keys of a shard, about.
SHARD_KEYS = 1 << 13


def _spread(keys: np.ndarray, salt: int) -> np.ndarray:
    return winnow.mixed(keys.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (salt + 1) % (1 << 64)))


def shard_of(keys: np.ndarray, n_shards: int) -> np.ndarray:
    return (_spread(keys, 0) % np.uint64(n_shards)).astype(np.int64)


def levels(keys: np.ndarray) -> list[np.ndarray]:
    """The bit rows of one shard's distinct keys, as words of 64 bits."""
    rows: list[np.ndarray] = []
    while len(keys):
        words = -(-GAMMA * len(keys) // 64)
        at = (_spread(keys, len(rows) + 1) % np.uint64(64 * words)).astype(np.int64)
        alone = np.bincount(at, minlength=64 * words) == 1
        rows.append(np.packbits(alone, bitorder="little").view(np.uint64))
        keys = keys[~alone[at]]
    return rows


@dataclass
class PerfectHash:
    """``words``: all bit rows; ``bases``, ``sizes``: first word and words of each shard's levels."""

    words: np.ndarray
    before: np.ndarray
    bases: np.ndarray
    sizes: np.ndarray
    starts: np.ndarray

    @classmethod
    def joined(cls, shards: list[list[np.ndarray]]) -> PerfectHash:
        deep = max(map(len, shards), default=0)
        sizes = np.zeros((len(shards), deep), np.int64)
        for s, rows in enumerate(shards):
            sizes[s, :len(rows)] = [len(r) for r in rows]
        bases = np.cumsum(np.concatenate([[0], sizes.ravel()]))[:-1].reshape(sizes.shape).astype(np.int64)
        words = np.concatenate([r for rows in shards for r in rows] + [np.zeros(1, np.uint64)])
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])[:-1]
        starts = np.array([before[b[0]] if deep else 0 for b in bases] + [int(np.bitwise_count(words).sum())], np.int64)
        return cls(words, before, bases, sizes, starts)

    def arrays(self) -> tuple[np.ndarray, ...]:
        """What makes it again: ``PerfectHash(*arrays)``."""
        return self.words, self.before, self.bases, self.sizes, self.starts

    def __len__(self) -> int:
        return int(self.starts[-1])

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of ``keys``; -1 for some keys that are not in the set."""
        out = np.full(len(keys), -1, np.int64)
        left, shard = np.arange(len(keys)), shard_of(keys, len(self.bases))
        for level in range(self.sizes.shape[1]):
            some = self.sizes[shard[left], level] > 0
            left = left[some]
            if not len(left):
                break
            own = shard[left]
            at = (_spread(keys[left], level + 1) % (64 * self.sizes[own, level]).astype(np.uint64)).astype(np.int64)
            word, bit = self.bases[own, level] + (at >> 6), (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            under = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.before[word] + np.bitwise_count(under))[hit]
            left = left[~hit]
        return out


def build(keys: DataFrame, n_keys: int) -> PerfectHash:
    """The hash of the distinct longs of the one column of ``keys``; some four bits a key reach the driver."""
    n_shards = max(1, -(-n_keys // SHARD_KEYS))
    name = keys.columns[0]

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array(shard_of(batch.column(0).to_numpy(zero_copy_only=False), n_shards), pa.int64()),
                                   batch.column(0)], names=["shard", "key"])

    def built(table: pa.Table) -> pa.Table:
        rows = levels(table.column("key").to_numpy())
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
                         "rows": pa.array([[r.tobytes() for r in rows]], pa.list_(pa.binary()))})

    found = {r["shard"]: [np.frombuffer(bytes(x), np.uint64) for x in r["rows"]] for r in
             keys.select(F.col(name).cast("long")).mapInArrow(shard, "shard long, key long")
             .groupBy("shard").applyInArrow(built, "shard long, rows array<binary>").toLocalIterator()}
    return PerfectHash.joined([found.get(s, []) for s in range(n_shards)])
