"""Rows that the loads of a table refused: kept beside the table, read back, corrected and loaded again."""

from __future__ import annotations

import uuid
from typing import Callable, Iterable

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from ..functions.redact import redact_column
from ..operators import changes as ch
from ..operators.builders import LoadColumns
from ..operators.quality import REASONS, gate, reason_samples, row_bytes
from ..session import Files, observed
from ..spec import OP, TableSpec
from .table import KeyedTable, _safe

LOAD, BAD, INPUT = "load", "_bad", "_input"
RECORD = "_record"  # text that an input row was decoded from: kept with a rejected row, not loaded
REPLAY = "replay:"  # prefix of the query id of a replayed load


class Rejects:
    """Rejected rows of one table, a plain Parquet folder (default: beside the table's data) with a part for each load.

    A load writes good and bad rows in one job, which reads the input once. The good ones are then loaded from there; the bad ones become
    visible after the table's commit. The table's own record of loads decides what counts: parts of a crashed load are published
    if its commit is recorded and removed if not, and a delivered-again batch adds nothing. A load without ``query_id`` isn't recorded;
    if the driver dies between its commit and the next step, its rejected rows are lost.
    """

    def __init__(self, table: KeyedTable, path: str | None = None):
        self.table, self.spark = table, table.spark
        self.path = (path or f"{table.path}/_rejects").rstrip("/")
        self._files = Files(self.spark, self.path)

    # -- write -----------------------------------------------------------------------------------------------------

    def load(
        self, df: DataFrame, seq: Iterable[str] | str = (), mode: str = "full", columns: Iterable[str] | None = None, merge_condition: str | None = None,
        ignore_update_before: bool = True, kind: str = ch.KIND, strict: bool = True, max_filter_ratio: float = 1.0, query_id: str | None = None,
        batch_id: int | None = None, evolve: Callable[[dict], dict] | None = None, report: Callable[[dict], None] | None = None,
        mapping: str | LoadColumns | None = None, **options,
    ) -> dict:
        """:meth:`KeyedTable.load` that keeps the rows it filters. ``max_filter_ratio`` above which the load fails is 1 by default.

        A column ``_record`` of ``df`` is kept with rejected rows only. The report has ``rejected_load``, the name under which the rejected rows are kept (null if there are none).
        """
        self.settle()
        m = self.table.manifest()
        if query_id is not None and m["ledger"].get(query_id, -1) >= batch_id:
            return {"skipped": True, "version": m["version"]}
        spec = TableSpec.from_dict((evolve(m) if evolve else m)["spec"])
        seq = [seq] if isinstance(seq, str) else list(seq)
        if mode == "partial" and columns is None:
            columns = [c for c in spec.names if c.lower() in {d.lower() for d in df.columns}]
        keyed = spec.model in ("primary", "unique")
        plan = LoadColumns.compile(mapping, spec) if isinstance(mapping, str) else mapping
        df = plan.named(df) if isinstance(mapping, str) else df
        whole = df.withColumn(INPUT, F.struct(*[F.col(f"`{c}`") for c in df.columns if c != REASONS]))
        if isinstance(mapping, str):
            whole = plan.derive(whole, spec, (*seq, kind))
        if keyed or kind in df.columns or OP in df.columns:
            whole = ch.prepare(whole, spec.model, ignore_update_before, kind) if keyed else _upserts(whole, kind)
        row_spec = plan.row_spec(spec) if plan and plan.builders else spec
        checked = self.table.judged(whole, row_spec, strict, columns if mode == "partial" else None)
        bad = F.col(REASONS) != ""
        image = F.when(bad, F.to_variant_object(INPUT)).alias("_row")
        ddl = F.when(bad, F.lit(whole.schema[INPUT].dataType.simpleString())).alias("_schema")
        out = checked.select(*[F.col(f"`{c}`") for c in checked.columns if c not in (INPUT, REASONS, RECORD)], F.when(bad, redact_column(F.col(REASONS))).alias(REASONS), image, ddl, bad.alias(BAD))
        obs = Observation(f"rejects_{uuid.uuid4().hex[:8]}")
        size = F.sum(F.when(~F.col(BAD), row_bytes(T.StructType([f for f in out.schema if f.name in spec.names]))))
        metrics = [F.count(F.lit(1)).alias("total"), F.count_if(BAD).alias("filtered"), F.coalesce(size, F.lit(0)).alias("bytes")]
        name = f"{_safe(query_id)}-{batch_id}" if query_id is not None else f"once-{uuid.uuid4().hex[:12]}"
        staged = f"{self.path}/_staged/{name}"
        out.observe(obs, *metrics).write.mode("overwrite").partitionBy(BAD).parquet(staged)
        try:
            counts = observed(obs, out.agg(*metrics))
            rows = self.spark.read.schema(out.schema).parquet(staged)
            if counts["total"] and counts["filtered"] / counts["total"] > max_filter_ratio:
                gate(counts["total"], counts["filtered"], max_filter_ratio, rows.where(BAD).withColumn(REASONS, F.coalesce(REASONS, F.lit(""))))
            good = rows.where(~F.col(BAD)).drop(BAD, REASONS, "_row", "_schema")
            given = set(df.columns) - {RECORD} | {OP, "_sub"} | (plan.sources | {n for n, _ in plan.scalars} if plan else set())
            good = good.select(*[c for c in good.columns if c in given or c.lower() in {g.lower() for g in given}])
            if plan:
                options["mapping"] = plan  # already applied
            done = self.table.load(
                good, seq, mode=mode, columns=columns, merge_condition=merge_condition, ignore_update_before=ignore_update_before, strict=strict,
                query_id=query_id, batch_id=batch_id, evolve=evolve, **options)
        except BaseException:
            if query_id is None or not self.table.finished(query_id, batch_id):
                self._files.delete(staged)
            raise
        kept = self._publish(name, done["version"]) if counts["filtered"] else self._files.delete(staged) and None
        out_report = {
            **done, "total_rows": counts["total"], "loaded_rows": counts["total"] - counts["filtered"], "filtered_rows": counts["filtered"],
            "loaded_bytes": counts["bytes"], "rejected_load": kept, "reasons": reason_samples(self.read(kept).withColumn(REASONS, F.col("reasons"))) if kept else []}
        if report:
            report(out_report)
        return out_report

    def _publish(self, name: str, version: int) -> str:
        load = f"{version:010d}-{name}"
        if not self._files.exists(f"{self.path}/data/{LOAD}={load}"):
            self._files.move(f"{self.path}/_staged/{name}/{BAD}=true", f"{self.path}/data/{LOAD}={load}")
        self._files.delete(f"{self.path}/_staged/{name}")
        return load

    def settle(self) -> list[str]:
        """Publish what recorded loads left staged, remove what others did. Run by every load before it starts."""
        published, m = [], None
        for name in self._files.names(f"{self.path}/_staged"):
            m = m or self.table.manifest()
            query, _, batch = name.rpartition("-")
            recorded = max((n for q, n in m["ledger"].items() if _safe(q) == query), default=-1)
            if batch.isdigit() and recorded >= int(batch) and self._files.exists(f"{self.path}/_staged/{name}/{BAD}=true"):
                published.append(self._publish(name, m["version"]))
            else:
                self._files.delete(f"{self.path}/_staged/{name}")
        return published

    # -- read ------------------------------------------------------------------------------------------------------

    def loads(self) -> list[str]:
        """Names of loads with rejected rows, in the order of their commits."""
        return [n[len(LOAD) + 1:] for n in self._files.names(f"{self.path}/data") if n.startswith(f"{LOAD}=")]

    def open(self) -> list[str]:
        """Loads whose rejected rows have not been loaded again."""
        done = self.table.manifest()["ledger"]
        return [n for n in self.loads() if f"{REPLAY}{n}" not in done]

    def read(self, load: str | None = None) -> DataFrame:
        """``load, reasons, row, input_schema``: all rejected rows, or those of one load. Reasons hold no values; ``row`` is the whole input row."""
        names = [load] if load else self.loads()
        schema = f"{REASONS} string, _row variant, _schema string, {LOAD} string"
        if not names:
            return self.spark.createDataFrame([], f"{LOAD} string, reasons string, row variant, input_schema string")
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/{LOAD}={n}" for n in names])
        return rows.select(LOAD, F.col(REASONS).alias("reasons"), F.col("_row").alias("row"), F.col("_schema").alias("input_schema"))

    def rows(self, load: str) -> DataFrame:
        """Rejected rows of a load with the columns and types of its input, and ``reasons``."""
        kept = self.read(load)
        schema = kept.select("input_schema").first()[0]  # one for all rows of a load
        return kept.select(F.variant_get("row", "$", schema).alias("r"), "reasons").select("r.*", "reasons")

    # -- replay ----------------------------------------------------------------------------------------------------

    def replay(self, fix: Callable[[DataFrame], DataFrame], seq: Iterable[str] | str = (), loads: Iterable[str] | None = None, **options) -> dict[str, dict]:
        """Correct rejected rows and load them again, each load's once: :meth:`open` ones, or those named that are open.

        ``fix`` gets the input rows with ``reasons`` and returns rows for a load; rows that it leaves out are given up. Rows that fail
        again are rejected rows of the replay, and open. In the table a replay is a load like any other: it comes after those before, so
        a ``merge_condition`` guards newer values. Returns the reports by load.
        """
        self.settle()
        waiting = self.open()
        chosen = waiting if loads is None else [n for n in waiting if n in set(loads)]
        out = {}
        for n in chosen:
            fixed = fix(self.rows(n))
            out[n] = self.load(fixed.drop("reasons"), seq, query_id=f"{REPLAY}{n}", batch_id=0, **options)
        return out


def _upserts(rows: DataFrame, kind: str) -> DataFrame:
    """Rows for a table without a primary key: deletes and before images are no rows of it."""
    rows = ch.filter_kinds(rows, has_pk=False) if kind in rows.columns else rows
    return rows.where(F.col(OP) == 0) if OP in rows.columns else rows
