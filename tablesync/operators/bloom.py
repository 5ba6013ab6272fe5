"""Blocked Bloom filters of keys, built in shards by Spark and tested where a table is scanned."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

SHARD_KEYS, BITS, PROBES = 1 << 17, 12, 6
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _bits(h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of a key's bits the 64-bit word inside its block of 512 bits, and the mask."""
    g = _mixed(h + _ODD)
    for k in range(PROBES):
        bit = (g >> np.uint64(9 * k)) & np.uint64(511)
        yield (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h & np.uint64(0xFFFFFFFF)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64) * 8


def _built(h: np.ndarray, blocks: int) -> np.ndarray:
    words, at = np.zeros(blocks * 8, dtype=np.uint64), _block(_mixed(h), blocks)
    for word, mask in _bits(h):
        np.bitwise_or.at(words, at + word, mask)
    return words


def key_hash(on: Iterable[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in on])


class KeyFilter:
    """Which keys may be among those of ``keys``: never wrong about one that is, wrong about one in some hundred of the others.

    Keys are dealt to shards of about 131,072 by hash, one task builds the filter of a shard, so its size is known before it is built.
    """

    def __init__(self, keys: DataFrame, on: Iterable[str], distinct: int | None = None):
        self.on, spark = list(on), keys.sparkSession
        self.types = [keys.schema[c].dataType for c in self.on]
        hashed = keys.select(key_hash(self.on).alias("h")).distinct()
        n = hashed.count() if distinct is None else distinct
        self.shards = max(1, -(-n // SHARD_KEYS))
        blocks = max(1, -(-min(n, 2 * SHARD_KEYS) * BITS // 512))

        def build(p: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"shard": p["shard"][:1], "bits": [_built(p["h"].to_numpy(np.int64).view(np.uint64), blocks).tobytes()]})

        dealt = hashed.select("h", F.pmod(F.xxhash64("h"), F.lit(self.shards)).cast("int").alias("shard"))
        parts = {r["shard"]: bytes(r["bits"]) for r in dealt.groupBy("shard").applyInPandas(build, "shard int, bits binary").collect()}
        self.bytes = len(parts) * blocks * 64
        empty = bytes(blocks * 64)
        self._shared = spark.sparkContext.broadcast(b"".join(parts.get(k, empty) for k in range(self.shards)))
        self._blocks = blocks

    @staticmethod
    def size(keys: int) -> int:
        """Bytes that the filter of so many keys takes."""
        return max(1, -(-keys // SHARD_KEYS)) * max(1, -(-min(keys, 2 * SHARD_KEYS) * BITS // 512)) * 64

    def test(self, df: DataFrame) -> DataFrame:
        """Rows whose key may be among the keys; null keys are not. Only a hash of the key goes to Python."""
        shared, blocks = self._shared, self._blocks

        @pandas_udf("boolean")
        def known(h: pd.Series, shard: pd.Series) -> pd.Series:
            words = np.frombuffer(shared.value, dtype="<u8")
            x = h.to_numpy(np.int64).view(np.uint64)
            at = shard.to_numpy(np.int64) * blocks * 8 + _block(_mixed(x), blocks)
            out = np.ones(len(x), dtype=bool)
            for word, mask in _bits(x):
                out &= words[at + word] & mask != 0
            return pd.Series(out)

        h = key_hash(self.on)
        there = F.lit(True)
        for c in self.on:
            there = there & F.col(f"`{c}`").isNotNull()
        return df.where(there).where(known(h, F.pmod(F.xxhash64(h), F.lit(self.shards)).cast("int")))
