"""Table scans. Column and filter selection is left to Catalyst, which pushes both into the file reader."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T


def scan(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    columns: Iterable[str] | None = None,
    where: Column | str | Iterable[Column | str] | None = None,
    limit: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Read a table: declared schema, columns in any order, filters (several are joined by AND), optional limit.

    ``path`` is a file path, or a table name when ``fmt`` is ``table``.
    """
    if fmt == "table":
        df = spark.table(path)
    else:
        reader = spark.read.format(fmt)
        df = (reader.schema(schema) if schema is not None else reader).load(path)
    for condition in _conditions(where):
        df = df.where(condition)
    if columns is not None:
        df = df.select(*_known(df, columns))
    return df if limit is None else df.limit(limit)


def scan_options(spark: SparkSession, path: str, options: Mapping[str, str], **kw) -> DataFrame:
    """Scan configured by text: ``scan.columns="a, b"``, ``scan.filter="c1 = 100"``, ``scan.limit``.

    A ``count(`` in ``scan.columns`` makes it a count-only scan.
    """
    columns = options.get("scan.columns", "").strip()
    condition = options.get("scan.filter", "").strip() or None
    if "count(" in columns.lower():
        return scan_count(spark, path, where=condition, **kw)
    names = [c.strip().strip("`") for c in columns.split(",") if c.strip()] or None
    limit = options.get("scan.limit")
    return scan(spark, path, columns=names, where=condition, limit=int(limit) if limit else None, **kw)


def scan_count(spark: SparkSession, path: str, where: Column | str | None = None, **kw) -> DataFrame:
    """Number of rows that pass the filter, as one row; only the filter's columns are read."""
    return scan(spark, path, where=where, **kw).agg(F.count("*").alias("count"))


def observe_scan(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that leave a scan while the job runs; read ``observation.get["total_scanned_rows"]`` afterwards."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("total_scanned_rows")), observation


def _conditions(where) -> list:
    if where is None:
        return []
    return [where] if isinstance(where, (str, Column)) else list(where)


def _known(df: DataFrame, columns: Iterable[str]) -> list[str]:
    columns = list(columns)
    have = {c.lower() for c in df.columns}
    for c in columns:
        if c.lower() not in have:
            raise ValueError(f"column {c} is not in the table: {df.columns}")
    return columns
