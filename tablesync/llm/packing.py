"""Best-fit packing of token sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import Stage
from .tokens import encoder

CAPACITY, END_ID = 2048, 0
#: Pieces that are packed together by one task: enough that what its last bins waste is small beside the rest.
GROUP = 40_000


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``): the ids of each document with the end id, cut where too long.

    A document of more than ``capacity`` ids has a shorter first piece (the remainder) and full ones after it.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, end = encoder(vocabulary), np.array([end_id], dtype="<u4")
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                ids = np.concatenate((enc.ids([text])[0] if text else end[:0], end))
                at, k = 0, 0
                while at < len(ids):
                    n = len(ids) % capacity or capacity if k == 0 else capacity
                    cut = ids[at:at + n]
                    rows.append((doc_id, k, at, n, zlib.crc32(cut.tobytes()), *([cut.astype("<i4")] if with_ids else [])))
                    at, k = at + n, k + 1
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    d = docs.select("doc_id", "text")
    if id_type != "string":  # pandas would turn integers with nulls into floats
        d = d.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
        return d.mapInPandas(each, schema.replace(f"doc_id {id_type}", "doc_id string")).withColumn("doc_id", F.col("doc_id").cast(id_type))
    return d.mapInPandas(each, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, longest first, each where the sum of the squared counts of open bins per gap becomes smallest.

    With N(h) open bins of gap h, a piece of length s in such a bin changes that sum by 2(N(h-s) - N(h) + 1), or by 1 - 2N(h) if it
    fills the bin; filled bins are closed. A bin is opened only if no open one has room. Ties go to the smallest gap.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, last = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        here = counts[s:capacity]
        if s < capacity and here.any():
            change = 2 * (counts[:capacity - s] - here + 1)
            change[0] = 1 - 2 * here[0]
            change[here == 0] = np.iinfo(np.int64).max
            gap = s + int(np.argmin(change))
            b = open_bins[gap].pop()
            counts[gap] -= 1
        else:
            gap, b, last = capacity, last, last + 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            open_bins[gap - s].append(b)
            counts[gap - s] += 1
    return bins, offsets


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP, with_ids: bool = False) -> DataFrame:
    """One row per piece: those of :func:`pieces` with ``sequence_id`` and ``offset``.

    Pieces are dealt into groups of about ``group`` rows by their position in a written table, whatever their content, and each
    group is packed by itself; the number of groups follows the number of pieces. Full pieces are sequences of their own and
    need no task. Null and empty texts are one end id. Repeated rows are packed as often as they come. No rows give no rows.
    """
    stage = Stage(docs.sparkSession, "packing")
    rows = stage.write(pieces(docs, vocabulary, capacity, end_id, with_ids).withColumn("_at", F.monotonically_increasing_id()))
    n = rows.where(F.col("length") < capacity).count()
    groups = max(1, -(-n // group))

    def each(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        # the longest first, so the order of rows within equal lengths decides nothing about the number of bins
        p = p.sort_values("_at", ignore_index=True)
        bins, offsets = sum_of_squares(p["length"].to_numpy(np.int64), capacity)
        return pd.DataFrame({"_at": p["_at"], "sequence_id": bins * groups + int(key[0]), "offset": offsets})

    short = rows.where(F.col("length") < capacity).select("_at", "length", F.pmod(F.xxhash64("_at"), F.lit(groups)).alias("_g"))
    placed = stage.write(short.groupBy("_g").applyInPandas(each, "_at bigint, sequence_id bigint, offset bigint"))
    # full pieces come after all numbers of the others
    most = (placed.agg(F.max("sequence_id")).first()[0] or 0) + 1
    full = rows.where(F.col("length") >= capacity).withColumns({"sequence_id": F.col("_at") + most, "offset": F.lit(0).cast("bigint")})
    out = rows.where(F.col("length") < capacity).join(placed, "_at").select(*full.columns)
    return out.unionAll(full).drop("_at")
