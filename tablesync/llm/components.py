"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Stage


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Links neighbours to the smallest node around ``u``: the larger ones (large star) or the smaller ones and u (small star)."""
    e = edges.select("u", "v")
    if both_ways:
        e = e.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    joined = e.join(least, F.col("u") == F.col("c"))
    if both_ways:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(edges.select("u").join(least, F.col("u") == F.col("c")).select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """``node, root`` for every node with a link; ``root`` is the smallest node of its component.

    ``edges`` has two columns of integers, in any order and with repeats; links to itself and nulls are ignored. Each step is
    two joins and is written before the next, so a step is what lost executors repeat. The number of steps grows with the
    logarithm of the longest path. Only a count and a checksum per step reach the driver. Hub nodes spread: minima are
    combined before the shuffle and the joins are open to skew splitting.
    """
    a, b = edges.columns
    e = stage.write(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"`{a}` != `{b}`").distinct())
    mark = lambda t: t.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
    before = mark(e)
    while before[0]:
        new = stage.write(_star(_star(e, True), False))
        after = mark(new)
        stage.drop(e)
        e = new
        if after == before:
            break
        before = after
    pairs = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
