"""Aggregate-key columns: exact (bitmap) and approximate (HLL) distinct counts that merge.

All of them are built-in partial aggregates, so hot keys combine on the map side. A bitmap is kept as one row per key
and value range (32,768 values), so no bitmap grows with the data.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, functions as F

BUCKET, BITMAP, HLL, FEW = "bitmap_bucket", "bitmap", "hll", "few"
#: Values of one range that are kept as a sorted list; more of them are a bitmap.
MOST_LISTED = 1024


def bitmap_rollup(df: DataFrame, keys: Iterable[str], col: str) -> DataFrame:
    """``BITMAP_UNION(to_bitmap(col))`` per key. ``col`` must be a non-negative integer; nulls add nothing."""
    keys = list(keys)
    value = F.col(col).cast("bigint")
    checked = F.when(
        value < 0, F.raise_error(F.concat(F.lit("negative value for a bitmap: "), value.cast("string"))).cast("bigint")
    ).otherwise(value)
    return (
        df.where(F.col(col).isNotNull())
        .select(*keys, checked.alias("_v"))
        .groupBy(*keys, F.bitmap_bucket_number("_v").alias(BUCKET))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_v")).alias(BITMAP))
    )


def bitmap_merge(a: DataFrame, b: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Union of two bitmap rollups, the merge an aggregate-key table makes on load."""
    keys = list(keys)
    return a.unionByName(b).groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def bitmap_ndv(rollup: DataFrame, by: Iterable[str], keys: Iterable[str] | None = None) -> DataFrame:
    """Exact distinct count per ``by`` over a bitmap rollup. Groups coarser than the rollup's ``keys`` are merged first."""
    by = list(by)
    merged = rollup
    if keys is None or set(keys) != set(by):
        merged = rollup.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count(BITMAP)).alias("ndv"))


def hll_rollup(df: DataFrame, keys: Iterable[str], col: str, log_k: int = 12) -> DataFrame:
    """``HLL_UNION(hll_hash(col))`` per key."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(col, F.lit(log_k)).alias(HLL))


def hll_merge(a: DataFrame, b: DataFrame, keys: Iterable[str]) -> DataFrame:
    return a.unionByName(b).groupBy(*keys).agg(F.hll_union_agg(HLL).alias(HLL))


def hll_ndv(rollup: DataFrame, by: Iterable[str]) -> DataFrame:
    """Approximate distinct count per ``by`` over an HLL rollup."""
    by = list(by)
    return rollup.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(HLL)).alias("ndv"))


#: A place of a range as a word of 32 places and its bits there, whose hex digits are the bytes of Spark's bitmaps.
_WORD = "struct(shiftright({0}, 5) AS _word, shiftleft(1L, ({0} & 31) ^ 24) AS _bits)"


def _words(rollup: DataFrame, keys: list[str]) -> DataFrame:
    """Lists and bitmaps as rows of ``_word`` and ``_bits``."""
    listed = F.expr(f"transform({FEW}, p -> {_WORD.format('p')})")
    dense = F.expr(f"transform(sequence(0, 1023), w -> struct(w AS _word, cast(conv(hex(substring({BITMAP}, 4 * w + 1, 4)), 16, 10) AS bigint) AS _bits))")
    return rollup.select(*keys, BUCKET, F.inline(F.coalesce(listed, dense))).where("_bits <> 0")


def _packed(words: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``keys``, range, ``_word`` and ``_bits``, packed: a sorted list while there are few values, else a bitmap.

    Words are united first, in buffers of eight bytes. A range is then packed within its row, so no shuffle is read for lists and again for bitmaps.
    """
    by = [*keys, BUCKET]
    words = words.groupBy(*by, "_word").agg(F.bit_or("_bits").alias("_bits"))
    sets = words.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("_set"), F.sum(F.bit_count("_bits")).alias("_n"))
    one = "array(cast(32 * w._word + (bit_count(w._bits - 1) ^ 24) AS smallint))"
    more = "transform(filter(sequence(0, 31), i -> getbit(w._bits, i ^ 24) = 1), i -> cast(32 * w._word + i AS smallint))"
    listed = F.expr(f"flatten(transform(_set, w -> if(bit_count(w._bits) = 1, {one}, {more})))")
    gap = "w._word - if(i = 0, 0, get(_set, i - 1)._word + 1)"
    digits = F.expr(f"array_join(transform(_set, (w, i) -> concat(repeat('0', 8 * ({gap})), lpad(hex(w._bits), 8, '0'))), '')")
    short = F.col("_n") <= MOST_LISTED
    return sets.select(*by, F.when(short, listed).alias(FEW), F.when(~short, F.unhex(F.rpad(digits, 8192, "0"))).alias(BITMAP))


def mixed_rollup(df: DataFrame, keys: Iterable[str], col: str) -> DataFrame:
    """Distinct values per key for ids of any density: one row per key and range of 32,768 values, ``few`` (sorted places) or ``bitmap``.

    A range of at most 1,024 values takes two bytes for each, so scattered 64-bit ids cost about their own size instead of a bitmap
    of 4 KB; a fuller range costs 4 KB at most. Values are combined on the map side; no list is longer than a range. ``col`` must be a
    non-negative integer; nulls add nothing.
    """
    keys = list(keys)
    value = F.col(col).cast("bigint")
    checked = F.when(value < 0, F.raise_error(F.concat(F.lit("negative value for a bitmap: "), value.cast("string"))).cast("bigint")).otherwise(value)
    rows = df.where(F.col(col).isNotNull()).select(*keys, checked.alias("_v"))
    places = rows.select(*keys, F.bitmap_bucket_number("_v").alias(BUCKET), F.bitmap_bit_position("_v").cast("int").alias("_p"))
    return _packed(places.select(*keys, BUCKET, F.expr(_WORD.format("_p")).alias("_w")).select(*keys, BUCKET, "_w.*"), keys)


def mixed_merge(a: DataFrame, b: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Union of two rollups of :func:`mixed_rollup`; lists that grow beyond the bound become bitmaps."""
    keys = list(keys)
    return _packed(_words(a.unionByName(b), keys), keys)


def mixed_ndv(rollup: DataFrame, by: Iterable[str], keys: Iterable[str] | None = None) -> DataFrame:
    """Exact distinct count per ``by``. Groups coarser than the rollup's ``keys`` are united first."""
    by = list(by)
    if keys is None or set(keys) != set(by):
        rollup = _packed(_words(rollup, by), by)
    return rollup.groupBy(*by).agg(F.sum(F.coalesce(F.size(FEW), F.lit(0)) * F.col(FEW).isNotNull().cast("int") + F.coalesce(F.bitmap_count(BITMAP), F.lit(0))).alias("ndv"))
