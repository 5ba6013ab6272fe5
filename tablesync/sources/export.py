"""Text files of a load: framed batches, row delimiters, compression."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

CHUNK_BYTES = 20 << 20


def frame_chunks(df: DataFrame, fmt: str, row_delimiter: str = "\n", max_bytes: int = CHUNK_BYTES, col: str = "value") -> DataFrame:
    """Join text rows into load payloads of about ``max_bytes``: rows of one input partition, in their order, grouped by running size.

    A payload is closed by the row that reaches the bound, so it is longer by at most that row. JSON payloads are arrays ``[a,b]``; CSV
    payloads end every row, the last too, with the row delimiter.
    """
    if fmt not in ("json", "csv"):
        raise ValueError(f"unknown format {fmt}")
    first, between, last = ("[", ",", "]") if fmt == "json" else ("", row_delimiter, row_delimiter)
    rows = df.select(F.col(col).alias("_text")).where(F.col("_text").isNotNull()).withColumn("_at", F.monotonically_increasing_id())
    before = F.sum(F.octet_length("_text") + len(between.encode())).over(Window.partitionBy("_slot").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_slot", F.shiftright("_at", 33)).withColumn("_chunk", F.floor(F.coalesce(before, F.lit(0)) / max_bytes))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("_at", "_text"))), lambda r: r["_text"])
    joined = rows.groupBy("_slot", "_chunk").agg(texts.alias("_rows"))
    return joined.select(F.concat(F.lit(first), F.array_join("_rows", between), F.lit(last)).alias("payload"), F.size("_rows").cast("bigint").alias("n_rows"))


def write_text(
    df: DataFrame,
    path: str,
    fmt: str,
    row_delimiter: str = "\n",
    compression: str | None = None,
    as_array: bool = False,
    mode: str = "errorifexists",
    col: str = "value",
) -> None:
    """Write encoded rows as text files: one row per ``row_delimiter``; ``as_array`` writes JSON array payloads, one per
    line. ``compression`` is any codec Spark's text writer knows, ``lz4`` among them."""
    rows = frame_chunks(df, "json", col=col).select("payload") if as_array and fmt == "json" else df.select(col)
    writer = rows.write.mode(mode).option("lineSep", "\n" if as_array else row_delimiter)
    (writer.option("compression", compression) if compression else writer).text(path)
