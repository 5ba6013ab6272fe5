"""Load reports that outlive a session: counts and quantile sketches per query, merged over restarts."""

from __future__ import annotations

import re
import time
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import Files
from ..store.table import _safe

ROW = "query_id string, target string, batch_id bigint, at bigint, load_ms bigint, rows bigint, filtered bigint, bytes bigint"
MEASURES = ("load_ms", "rows", "bytes")
#: Size of the quantile sketches: ranks are right to about 1.3 %.
KLL_K = 200


class LoadReports:
    """Reports of loads as a Parquet folder: single rows of the current epoch, and one row per query and table for all epochs before.

    A row is named by query, batch and table, so a batch that is delivered again replaces its report. :meth:`fold` merges the
    epoch's rows into counts, sums and KLL sketches, which merge again: size follows the number of queries and tables, not of batches. One driver
    writes; readers see the last finished fold and the rows after it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._files = Files(spark, self.path)

    def _epoch(self) -> int:
        done = [int(n) for n in self._files.names(f"{self.path}/folded") if re.fullmatch(r"\d+", n) and self._files.exists(f"{self.path}/folded/{n}/_SUCCESS")]
        return max(done, default=0)

    def record(self, report: Mapping, query_id: str, batch_id: int, target: str = "") -> None:
        """One load's report, or those of a routed batch or a sync by table. Skipped loads are not recorded."""
        if report and all(isinstance(v, Mapping) for v in report.values()):
            for name, r in report.items():
                if name:
                    self.record(r, query_id, batch_id, name)
            return
        if report.get("skipped"):
            return
        row = (query_id, target, batch_id, int(time.time() * 1000), report.get("load_ms", 0), report.get("loaded_rows", 0), report.get("filtered_rows", 0), report.get("loaded_bytes", 0))
        self.record_rows(self.spark.createDataFrame([row], ROW), f"{_safe(query_id)}-{_safe(target)}-{batch_id}")

    def record_rows(self, rows: DataFrame, name: str) -> None:
        """Reports as rows, under a name that a repeated call replaces."""
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/{self._epoch()}/{name}")

    def _merged(self) -> DataFrame:
        """One row per query and table over all epochs, with mergeable sketches."""
        epoch, parts = self._epoch(), []
        names = self._files.names(f"{self.path}/rows/{epoch}")
        if names:
            rows = self.spark.read.schema(ROW).parquet(*[f"{self.path}/rows/{epoch}/{n}" for n in names])
            sketches = [F.kll_sketch_agg_bigint(m, F.lit(KLL_K)).alias(f"{m}_sketch") for m in MEASURES]
            parts.append(rows.groupBy("query_id", "target").agg(F.count("*").alias("batches"), F.sum("rows").alias("rows"), F.sum("filtered").alias("filtered"), F.sum("bytes").alias("bytes"), *sketches))
        if epoch:
            parts.append(self.spark.read.parquet(f"{self.path}/folded/{epoch}"))
        schema = "query_id string, target string, batches bigint, rows bigint, filtered bigint, bytes bigint, " + ", ".join(f"{m}_sketch binary" for m in MEASURES)
        if not parts:
            return self.spark.createDataFrame([], schema)
        return _sum(parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0], ["query_id", "target"])

    def fold(self) -> None:
        """Merge the rows of this epoch into the sketches and start a new one. What a fold that did not finish wrote is replaced."""
        epoch = self._epoch()
        self._merged().coalesce(1).write.mode("overwrite").parquet(f"{self.path}/folded/{epoch + 1}")  # a row for each query and table
        self._files.delete(f"{self.path}/rows/{epoch}")
        self._files.delete(f"{self.path}/folded/{epoch}")

    def latencies(self, by: Iterable[str] = ("query_id",), shares: Iterable[float] = (0.5, 0.95, 0.99)) -> DataFrame:
        """Loads, rows, rejected rows and bytes, and quantiles of durations (``p50_ms``, ...), rows and bytes of a load."""
        merged = _sum(self._merged(), list(by))
        out = [*by, "batches", "rows", "filtered", "bytes"]
        for m, unit in (("load_ms", "ms"), ("rows", "rows"), ("bytes", "bytes")):
            out += [F.kll_sketch_get_quantile_bigint(f"{m}_sketch", F.lit(p)).alias(f"p{round(100 * p)}_{unit}") for p in shares]
        return merged.select(*out)


def _sum(rows: DataFrame, by: list[str]) -> DataFrame:
    counts = [F.sum(c).alias(c) for c in ("batches", "rows", "filtered", "bytes")]
    return rows.groupBy(*by).agg(*counts, *[F.kll_merge_agg_bigint(f"{m}_sketch", F.lit(KLL_K)).alias(f"{m}_sketch") for m in MEASURES])
