"""Running counters of streaming loads."""

from __future__ import annotations

import math
import threading
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

class LoadListener(StreamingQueryListener):
    """Counts rows, batches, failures and filtered rows over all queries of a session; keeps batch durations per query.

    Durations are kept as counts per tenth of a power of two of milliseconds, so all batches of any number fit and quantiles
    are exact to 7 %. Pass :meth:`report` as ``report=`` (or ``on_report=``) of a load to count loaded and filtered rows.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self.counters = {"rows": 0, "batches": 0, "loaded": 0, "filtered": 0, "started": 0, "ended": 0, "failed": 0}
        self._latencies: dict[str, Counter] = {}
        self._rows: Counter = Counter()

    def onQueryStarted(self, event) -> None:
        self._add(started=1)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._add(rows=p.numInputRows, batches=1)
        with self._lock:
            self._latencies.setdefault(str(p.id), Counter())[round(10 * math.log2(max(1, p.batchDuration)))] += 1
            self._rows[str(p.id)] += p.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._add(ended=1, failed=1 if event.exception else 0)

    def report(self, report: dict) -> None:
        rows = report.values() if report and all(isinstance(v, dict) for v in report.values()) else [report]
        for r in rows:
            self._add(loaded=r.get("loaded_rows", 0), filtered=r.get("filtered_rows", 0))

    def _add(self, **by: int) -> None:
        with self._lock:
            for k, v in by.items():
                self.counters[k] += v

    def latencies(self, spark: SparkSession) -> DataFrame:
        """Duration quantiles per query over all its batches."""
        with self._lock:
            rows = [(q, sum(c.values()), self._rows[q], *(_quantile(c, p) for p in (0.5, 0.95, 0.99))) for q, c in self._latencies.items()]
        return spark.createDataFrame(rows, "query_id string, batches long, rows long, p50_ms long, p95_ms long, p99_ms long")


def _quantile(counts: Counter, share: float) -> int:
    left = math.ceil(share * sum(counts.values()))
    for step in sorted(counts):
        left -= counts[step]
        if left <= 0:
            return round(2 ** (step / 10))
    return 0
