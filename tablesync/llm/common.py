"""Helpers of the operators: staged tables, row identity, size checks of broadcast sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import Files, measured_bytes, work_dir

#: A side is broadcast only if its rows were counted and need at most so many bytes; beyond it the join shuffles.
MAX_BROADCAST = 8 << 20


class Stage:
    """Intermediate tables of one operator call, in the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A written table cuts the lineage, so lost executors repeat one step and not the whole operator. ``drop`` removes
    tables that no later step reads; tables behind a returned DataFrame stay until the cluster clears the folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self._n = spark, work_dir(spark, name), 0

    def write(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n}"
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stage_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            Files(self.spark, self.root).delete(t._stage_path)


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows, those of the smallest hashes of ``key``; all of them if there are no more.

    Rows above a bound on the hash, set from the counted rows, leave where they are read, so about ``rows`` reach the task that
    cuts the rest, however many partitions there are. ``df`` should be cheap to count.
    """
    n = df.count()
    if n <= rows:
        return df
    h = F.shiftrightunsigned(F.xxhash64(key), 1)
    share = min(1.0, (1.1 * rows + 100) / n)
    return df.where(h <= int(share * ((1 << 63) - 1))).orderBy(h).limit(rows)


def small(df: DataFrame, max_bytes: int = MAX_BROADCAST) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is below the bound, else unchanged. ``df`` should be cheap to count."""
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def once(value: Column) -> Column:
    """A value that is computed once for each row, as a generator column.

    Plain nested selects don't do: Catalyst may merge them and compute the value again for every element of an array.
    """
    return F.explode(F.array(value))


def text_key(text: Column) -> Column:
    """Together with doc_id it names a row: rows equal in both have equal results."""
    return F.xxhash64(text)


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Join condition that also pairs null keys with each other."""
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[k])
    return out


def repeat_rows(df: DataFrame, count: str) -> DataFrame:
    """One row for each counted input row; the count column goes."""
    cols = [c for c in df.columns if c != count]
    return df.select(*cols, F.explode(F.sequence(F.lit(1), F.col(count).cast("int"))).alias("_i")).select(*cols)
