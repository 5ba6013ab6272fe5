"""Dimension rows kept by key across micro-batches and restarts."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.lookup import BROADCAST_BYTES, lookup_by_keys
from ..session import Files

FOUND = "_found"


class KeyCache:
    """Rows of a dimension for the keys that were asked for, with the time they were read; keys without a row are remembered too.

    The rows are a Parquet folder with a part for each time of reading, so they survive a restart, any number of them fits, and parts that are
    older than ``ttl_ms`` go as a whole. A key is in one live part at most. Beyond ``max_parts`` parts are merged into one, which
    expires with its oldest row. Times are the driver's clock in milliseconds; one driver writes.
    """

    def __init__(self, spark: SparkSession, path: str, ttl_ms: int = 5000, max_parts: int = 64, clock: Callable[[], float] = time.time):
        self.spark, self.path, self.ttl_ms, self.max_parts, self._clock = spark, path.rstrip("/"), ttl_ms, max_parts, clock
        self._files = Files(spark, self.path)

    def _parts(self, now: int) -> list[str]:
        """Live parts; expired ones and those that were not finished are removed."""
        live = []
        for n in self._files.names(self.path):
            p = f"{self.path}/{n}"
            if now - int(n.split("-")[0]) < self.ttl_ms and self._files.exists(f"{p}/_SUCCESS"):
                live.append(p)
            else:
                self._files.delete(p)
        return live

    def _read(self, parts: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*parts) if parts else self.spark.createDataFrame([], schema)

    def rows(self, keys: DataFrame, reader: Callable[[], DataFrame], on: Iterable[str], max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """Dimension rows for ``keys``: known ones from the cache, others read from the dimension now and kept. Null keys have none.

        Only unknown keys meet the dimension (:func:`operators.lookup.lookup_by_keys`); if all are known it is not read.
        """
        on, now = list(on), int(self._clock() * 1000)
        dim, parts = reader(), self._parts(now)
        schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in dim.schema], T.StructField(FOUND, T.BooleanType())])
        if len(parts) > self.max_parts:
            oldest = min(int(p.rsplit("/", 1)[1].split("-")[0]) for p in parts)
            merged = f"{self.path}/{oldest}-{uuid.uuid4().hex[:8]}"
            self._read(parts, schema).write.parquet(merged)
            for p in parts:
                self._files.delete(p)
            parts = [merged]
        asked = keys.select(*on).dropna(subset=on).distinct()
        unknown = asked.join(self._read(parts, schema).select(*on).distinct(), on, "left_anti").persist()
        try:
            if not unknown.isEmpty():
                found = lookup_by_keys(unknown, dim, on, max_broadcast_bytes).withColumn(FOUND, F.lit(True))
                fresh = unknown.join(found, on, "left").withColumn(FOUND, F.coalesce(FOUND, F.lit(False)))
                path = f"{self.path}/{now}-{uuid.uuid4().hex[:8]}"
                fresh.select(*schema.names).write.parquet(path)
                parts.append(path)
        finally:
            unknown.unpersist()
        return self._read(parts, schema).where(FOUND).drop(FOUND)
