"""Lookup joins against a dimension table. A null key never matches."""

from __future__ import annotations

import time
from functools import reduce
from typing import Callable, Iterable

from pyspark.sql import DataFrame, functions as F

from ..session import is_small, measured_bytes
from .bloom import KeyFilter, key_hash

BROADCAST_BYTES = 16 << 20  # measured size of the rows
FILTER_BYTES = 64 << 20  # size of a filter of keys
HEAVY_KEYS = 256  # most keys that are taken out of a shuffle join


def lookup_join(
    df: DataFrame, dim: DataFrame, on: Iterable[str], how: str = "inner", max_broadcast_bytes: int = BROADCAST_BYTES, heavy_share: float | None = None
) -> DataFrame:
    """Join rows with every matching dimension row.

    A dimension whose measured size is below the bound is broadcast. A bigger one meets a small probe (a micro-batch) by
    its keys: they are broadcast instead, so the dimension is filtered where it is read and never shuffled as a whole.
    Otherwise it is a sort-merge join, where AQE splits the partitions of hot keys; with ``heavy_share`` keys that hold such a share of the
    rows are joined apart (:func:`heavy_join`), at the price of reading the keys of ``df`` once more.
    """
    on = list(on)
    if how not in ("inner", "left"):
        raise ValueError("a lookup join is inner or left")
    small = is_small(dim, max_broadcast_bytes)
    if small:
        return df.join(F.broadcast(dim), on, how)
    if is_small(df.select(*on), max_broadcast_bytes):
        return df.join(lookup_by_keys(df, dim, on, max_broadcast_bytes), on, how)
    if heavy_share:
        return heavy_join(df, dim, on, how, heavy_share, max_broadcast_bytes)
    return df.join(dim if small is None else dim.hint("merge"), on, how)


def heavy_keys(df: DataFrame, on: Iterable[str], share: float) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows, by one frequent-items sketch over the rows; at most 256.

    The sketch may name a key whose share is a little smaller; such a key is joined apart as well, which changes no result.
    """
    h = key_hash(on)
    known = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in on])
    found = df.where(known).select(h.alias("h")).agg(F.count("*").alias("n"), F.expr(f"approx_top_k(h, {HEAVY_KEYS}, {HEAVY_KEYS * 64})").alias("top")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] >= share * found["n"]]


def heavy_join(
    df: DataFrame, dim: DataFrame, on: Iterable[str], how: str = "inner", share: float = 0.01, max_broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """A shuffle join without hot keys: rows of keys that hold ``share`` of the rows or more meet their dimension rows by broadcast.

    The dimension rows of those few keys are measured; beyond the bound all keys are joined by shuffle. Rows with a null in their key match
    nothing and are not shuffled either. Keys of other types than the dimension's are left to the shuffle join.
    """
    on = list(on)
    plain = df.join(dim.hint("merge"), on, how)
    if [df.schema[c].dataType for c in on] != [dim.schema[c].dataType for c in on]:
        return plain
    hashes = heavy_keys(df, on, share)
    is_heavy = key_hash(on).isin(hashes) if hashes else F.lit(False)
    known = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in on])
    few = dim.where(known & is_heavy)
    if hashes and measured_bytes(few) > max_broadcast_bytes:
        return plain
    out = df.where(known & ~is_heavy).join(dim.where(known & ~is_heavy).hint("merge"), on, how)
    if hashes:
        out = out.unionByName(df.where(known & is_heavy).join(F.broadcast(few), on, how))
    if how == "left":
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema if f.name not in on]
        out = out.unionByName(df.where(~known).select("*", *rest))
    return out


def lookup_by_keys(
    keys: DataFrame, dim: DataFrame, on: Iterable[str], max_broadcast_bytes: int = BROADCAST_BYTES, max_filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """Only the dimension rows some probe key asks for. Each distinct key is looked up once.

    Keys that need more than the bound are not broadcast: a Bloom filter of them is, up to ``max_filter_bytes``. It is tested where the
    dimension is read, and only rows that pass are shuffled to the exact join.
    """
    on = list(on)
    wanted = keys.select(*on).dropna(subset=on).distinct()
    if is_small(wanted, max_broadcast_bytes):
        return dim.join(F.broadcast(wanted), on, "left_semi")
    same_types = [keys.schema[c].dataType for c in on] == [dim.schema[c].dataType for c in on]
    n = wanted.count() if same_types and max_filter_bytes else 0
    if n and KeyFilter.size(n) <= max_filter_bytes:
        dim = KeyFilter(wanted, on, n).test(dim)
    return dim.join(wanted, on, "left_semi")


class CachedDimension:
    """A dimension read again once it is older than ``ttl_ms``; the clock is the driver's.

    ``reader`` returns a new DataFrame, so every refresh sees the files of that moment.
    """

    def __init__(
        self, reader: Callable[[], DataFrame], ttl_ms: int = 5000, clock: Callable[[], float] = time.monotonic, max_bytes: int = BROADCAST_BYTES
    ):
        self._reader, self._ttl, self._clock, self._max_bytes = reader, ttl_ms / 1000.0, clock, max_bytes
        self._df: DataFrame | None = None
        self._kept = False
        self._at = 0.0
        self.loads = 0

    def get(self) -> DataFrame:
        now = self._clock()
        if self._df is None or now - self._at >= self._ttl:
            fresh = self._reader()
            # a dimension beyond the bound is read by the batch's keys each time, never kept as a whole
            kept = bool(is_small(fresh, self._max_bytes))
            if self._kept:
                self._df.unpersist()
            self._df, self._at, self._kept = fresh.persist() if kept else fresh, now, kept
            self.loads += 1
        return self._df
