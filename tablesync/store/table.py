"""A keyed table kept as Parquet files plus one manifest per version.

Layout: ``data/_commit=<id>/_bucket=<n>/*.parquet`` and ``_manifest/<version>.json``. A load rewrites only the buckets
its keys fall into (or, merging on read, writes the folded load as a delta for them) and then publishes the next manifest: data and the record of the
load (``query_id`` -> last ``batch_id``) become visible in one rename. Readers open one manifest, so they see one
version. All row work is Spark's; the driver handles bucket numbers (bounded by the bucket count) and the manifest.

The rename must not overwrite (HDFS and local disks; for plain object stores use a table format with MERGE instead).
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections import Counter
from functools import reduce
from typing import Callable, Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..operators import changes as ch
from ..operators.builders import LoadColumns
from ..operators.quality import NO_IMAGE, REASONS, check_rows, gate, row_bytes
from ..session import Files, observed
from ..spec import OP, ColumnSpec, TableSpec

SMALL_ROWS = 200_000  # folds up to this many rows never need the rebalancing shuffle before the write
KEEP = "keep_versions"  # table property: older manifests go as new ones are published (0, the default: only vacuum removes)
BUCKET, COMMIT = "_bucket", "_commit"


class ConcurrentCommit(RuntimeError):
    """Another writer published the same version first."""


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._files = Files(spark, path)

    # -- manifest ------------------------------------------------------------------------------------------------

    @classmethod
    def create(cls, spark: SparkSession, path: str, spec: TableSpec, if_not_exists: bool = False) -> KeyedTable:
        table = cls(spark, path)
        if table.exists():
            if if_not_exists:
                return table
            raise ValueError(f"table {spec.name} exists")
        names = {c.name: c.name for c in spec.columns}
        table._files.mkdirs(f"{table.path}/_manifest")
        first = {"version": 0, "spec": spec.to_dict(), "physical": names, "used": list(names), "born": {}, "live": {}, "ledger": {}}
        if not table._files.publish_text(table._manifest_path(0), json.dumps(first)) and not if_not_exists:
            raise ValueError(f"table {spec.name} exists")
        return table

    def exists(self) -> bool:
        return bool(self.versions())

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._files.names(f"{self.path}/_manifest") if re.fullmatch(r"\d+\.json", n)]

    def manifest(self, version: int | None = None) -> dict:
        versions = self.versions()
        if not versions:
            raise ValueError(f"no table at {self.path}")
        return json.loads(self._files.read_text(self._manifest_path(max(versions) if version is None else version)))

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/_manifest/{version:010d}.json"

    def _publish(self, manifest: dict) -> None:
        if not self._files.publish_text(self._manifest_path(manifest["version"]), json.dumps(manifest)):
            raise ConcurrentCommit(f"version {manifest['version']} of {self.path} was published by another writer")
        keep = int(manifest["spec"]["props"].get(KEEP, 0))
        if keep and manifest["version"] >= keep:
            self._files.delete(self._manifest_path(manifest["version"] - keep))

    @property
    def spec(self) -> TableSpec:
        return TableSpec.from_dict(self.manifest()["spec"])

    # -- read ----------------------------------------------------------------------------------------------------

    def read(self, version: int | None = None, keys: Mapping[str, Iterable] | None = None) -> DataFrame:
        """Rows of a version. ``keys`` gives wanted values for every key column: only their buckets are opened."""
        m = self.manifest(version)
        if not keys:
            return self._read(m)
        spec = TableSpec.from_dict(m["spec"])
        wanted = reduce(lambda x, y: x & y, [F.col(k).isin(list(keys[k])) for k in spec.keys])
        return self._read(m, self._buckets_of(spec, keys)).where(wanted)

    def _buckets_of(self, spec: TableSpec, keys: Mapping[str, Iterable]) -> set[int]:
        values = self.spark.range(1).select(*[F.array(*[F.lit(v).try_cast(spec.column(k).spark) for v in keys[k]]).alias(k) for k in spec.keys])
        for k in spec.keys:
            values = values.withColumn(k, F.explode(k))
        bucket = F.pmod(F.hash(*spec.keys), F.lit(spec.buckets))
        return {r[0] for r in values.select(bucket).distinct().collect()}

    def _commit_dir(self, commit: str) -> str:
        return f"{self.path}/data/{COMMIT}={commit}"

    def _read(self, m: dict, buckets: set[int] | None = None) -> DataFrame:
        """Rows of all or some buckets: the base, with pending deltas merged in."""
        spec = TableSpec.from_dict(m["spec"])
        fields = [T.StructField(m["physical"][c.name], c.spark) for c in spec.columns]
        files = self._scan(m["live"], buckets, fields)
        base = None if files is None else files.select(*[self._column(m, c) for c in spec.columns])
        pending = self._scan(m.get("deltas", {}), buckets, self._delta_fields(m, spec))
        if pending is None:
            return self.spark.createDataFrame([], spec.schema) if base is None else base
        rows = sum(e["rows"] for e in m["deltas"].values())
        whole = all(e["mode"] == "full" for e in m["deltas"].values())
        return ch.merge(
            base, self._fold_deltas(m, spec, pending, whole), spec.keys, spec.names, spec.values,
            "full" if whole else "partial", strategy="split" if rows <= SMALL_ROWS else "outer",
        )

    def _scan(self, entries: dict, buckets: set[int] | None, fields: list[T.StructField]) -> DataFrame | None:
        paths = []
        for commit, e in entries.items():
            if e["buckets"] is None:
                paths.append(self._commit_dir(commit))
                continue
            wanted = [b for b in e["buckets"] if buckets is None or b in buckets]
            if len(wanted) == e["written"]:
                paths.append(self._commit_dir(commit))
            else:
                paths += [f"{self._commit_dir(commit)}/{BUCKET}={b}" for b in wanted]
        if not paths:
            return None
        parts = [T.StructField(COMMIT, T.StringType())]
        if any(e["buckets"] is not None for e in entries.values()):
            parts.append(T.StructField(BUCKET, T.IntegerType()))
        reader = self.spark.read.schema(T.StructType(fields + parts)).option("basePath", f"{self.path}/data")
        return reader.parquet(*paths)

    # -- deltas: folded loads kept beside the base and merged when the table is read ------------------------------

    def _delta_fields(self, m: dict, spec: TableSpec) -> list[T.StructField]:
        name = m["physical"]
        out = [T.StructField(name[k], spec.column(k).spark) for k in spec.keys]
        out += [T.StructField(flag, T.BooleanType()) for flag in (ch.GONE, ch.ALIVE)]
        for c in spec.values:
            out += [T.StructField(f"_n_{name[c]}", spec.column(c).spark), T.StructField(f"_s_{name[c]}", T.BooleanType())]
        return out

    def _fold_deltas(self, m: dict, spec: TableSpec, pending: DataFrame, whole: bool) -> DataFrame:
        """One folded row per key over all deltas, in the order of their commits."""
        name, keys = m["physical"], list(spec.keys)
        named = [F.col(f"`{name[k]}`").alias(k) for k in keys]
        values = [F.col(f"`_n_{name[c]}`").alias(c) for c in spec.values]
        if whole:
            rows = pending.select(*named, *values, COMMIT, F.when(F.col(ch.ALIVE), 0).otherwise(1).alias(OP))
            return ch.fold(rows, keys, [COMMIT], spec.values)
        # a delta row stands for a delete, an upsert, or a delete followed by an upsert
        step = lambda op, sub: F.struct(F.lit(op).alias(OP), F.lit(sub).alias("_sub"))
        steps = F.array_compact(F.array(F.when(F.col(ch.GONE), step(1, 0)), F.when(F.col(ch.ALIVE), step(0, 1))))
        given = [F.col(f"`_s_{name[c]}`").alias(f"_given_{c}") for c in spec.values]
        rows = pending.select(*named, *values, *given, COMMIT, F.explode(steps).alias("_step")).select("*", "_step.*")
        present = {c: F.col(f"_given_{c}") for c in spec.values}
        return ch.fold(rows, keys, [COMMIT, "_sub"], spec.values, "partial", present=present)

    def _delta_rows(self, m: dict, spec: TableSpec, folded: DataFrame, mode: str, given: list[str]) -> DataFrame:
        name, out = m["physical"], [ch.GONE, ch.ALIVE]
        for k in spec.keys:
            out.append(F.col(k).cast(spec.column(k).spark).alias(name[k]))
        for c in spec.values:
            value = F.col(f"_n_{c}") if c in given else F.lit(None)
            flag = F.lit(c in given) if mode == "full" or c not in given else F.col(f"_s_{c}")
            out += [value.cast(spec.column(c).spark).alias(f"_n_{name[c]}"), flag.alias(f"_s_{name[c]}")]
        return folded.select(*out, BUCKET)

    def _column(self, m: dict, c: ColumnSpec) -> Column:
        col = F.col(f"`{m['physical'][c.name]}`")
        born = m["born"].get(c.name)
        if born is not None and c.default is not None:
            older = F.substring(COMMIT, 1, 10) < f"{born:010d}"
            col = F.when(older, F.lit(c.default).cast(c.spark)).otherwise(col)
        return col.alias(c.name)

    # -- schema --------------------------------------------------------------------------------------------------

    def evolve(self, add: Iterable[ColumnSpec] = (), drop: Iterable[str] = ()) -> None:
        """Add columns at the end and drop columns, in one manifest; no data file is touched.

        A default value counts for the rows of older files, so pending deltas are merged first if there is one."""
        add = list(add)
        if any(c.default is not None for c in add) and self.manifest().get("deltas"):
            self.compact()
        m = self.manifest()
        self._publish({**evolve_manifest(m, add, list(drop)), "version": m["version"] + 1})

    # -- loads ---------------------------------------------------------------------------------------------------

    def finished(self, query_id: str, batch_id: int) -> bool:
        return self.manifest()["ledger"].get(query_id, -1) >= batch_id

    def load(self, df: DataFrame, seq: Iterable[str] | str = (), *args, retries: int = 2, rejects: bool = False, **options) -> dict:
        """:meth:`load_once`, done again on the newest version if another writer published first, ``retries`` times at most.

        A load that changes columns (``evolve``) belongs to the version it was planned for and is not repeated. With
        ``rejects`` filtered rows are kept (see :class:`store.rejects.Rejects`).
        """
        if rejects:
            from .rejects import Rejects

            return Rejects(self).load(df, seq, *args, retries=retries, **options)
        for left in range(retries, -1, -1):
            try:
                return self.load_once(df, seq, *args, **options)
            except ConcurrentCommit:
                if not left or options.get("evolve"):
                    raise

    def load_once(
        self,
        df: DataFrame,
        seq: Iterable[str] | str = (),
        mode: str = "full",
        columns: Iterable[str] | None = None,
        merge_condition: str | None = None,
        ignore_update_before: bool = True,
        kind: str = ch.KIND,
        strict: bool = True,
        max_filter_ratio: float = 0.0,
        query_id: str | None = None,
        batch_id: int | None = None,
        evolve: Callable[[dict], dict] | None = None,
        report: Callable[[dict], None] | None = None,
        parallelism: int | None = None,
        merge_on_read: bool | None = None,
        stream_id: str | None = None,
        mapping: str | LoadColumns | None = None,
    ) -> dict:
        """Check, fold and apply one load, then publish it.

        Columns are matched by name. With ``query_id`` and ``batch_id`` a load that is already recorded is skipped;
        ``stream_id`` names the checkpoint behind a ``query_id``, and another checkpoint under the same id raises.
        ``evolve`` changes the manifest's columns in the same step. ``parallelism`` fixes the number of writing tasks,
        which is otherwise Spark's choice. ``merge_on_read`` (default: the table's property) writes only the folded load
        beside the table instead of rewriting buckets; conditional loads always rewrite. ``mapping`` names the input fields and
        derives columns, sketches of an aggregate table among them (:mod:`operators.builders`). Returns the load report.
        """
        started = time.perf_counter()
        m = self.manifest()
        m = owned(m, query_id, stream_id)
        if query_id is not None and m["ledger"].get(query_id, -1) >= batch_id:
            return {"skipped": True, "version": m["version"]}
        if evolve:
            m = owned(evolve(m), query_id, stream_id)
        spec = TableSpec.from_dict(m["spec"])
        seq = [seq] if isinstance(seq, str) else list(seq)
        if isinstance(mapping, str):
            mapping = LoadColumns.compile(mapping, spec)
            df = mapping.derive(mapping.named(df), spec, (*seq, kind))
        known = {c.lower() for c in spec.names}
        helper = {OP, kind, REASONS, "_sub", *seq, *(mapping.sources if mapping else ())}
        for c in df.columns:
            if c.lower() not in known and c not in helper:
                spec.column(c)  # raises: no such column
        obs = Observation(f"load_{uuid.uuid4().hex[:8]}")
        if spec.model == "aggregate":
            report_row = self._aggregate(m, spec, df, strict, max_filter_ratio, obs, query_id, batch_id, mapping)
        elif spec.model == "duplicate":
            report_row = self._append(m, spec, df, strict, max_filter_ratio, obs, query_id, batch_id, parallelism)
        else:
            if mode == "partial" and columns is None:
                columns = [c for c in spec.names if c.lower() in {d.lower() for d in df.columns}]
            if merge_condition:
                mode = "conditional"
            report_row = self._apply(
                m, spec, df, seq, mode, columns, merge_condition, ignore_update_before, kind, strict,
                max_filter_ratio, obs, query_id, batch_id, parallelism,
                spec.props.get("merge_on_read") == "true" if merge_on_read is None else merge_on_read,
            )
        report_row["load_ms"] = int((time.perf_counter() - started) * 1000)
        if report:
            report(report_row)
        return report_row

    def _aggregate(self, m, spec, df, strict, max_filter_ratio, obs, query_id, batch_id, mapping=None) -> dict:
        """Rows of a key are merged with those of the table by the aggregate of each column, never replaced."""
        aggs = {c.name: aggregate_of(c) for c in spec.columns if c.name not in spec.keys}
        built = bool(mapping and mapping.builders)
        good, recount, checked = self._checked(df, mapping.row_spec(spec) if built else spec, strict, obs, None)
        counts = recount.first().asDict()
        gate(counts["total"], counts["filtered"], max_filter_ratio, checked)
        out = self.merge_aggregate(mapping.partials(good, spec, aggs) if built else good, aggs, query_id, batch_id, m)
        return {**out, **_row_counts(counts)}

    def _checked(self, df: DataFrame, spec: TableSpec, strict: bool, obs: Observation, columns: set[str] | None):
        """Typed good rows, whose counts go to ``obs`` while the job runs, the same counts as a query of their own, and all checked rows."""
        checked = self.judged(df, spec, strict, columns)
        bad = F.col(REASONS) != ""
        size = F.sum(F.when(~bad, row_bytes(T.StructType([f for f in checked.schema if f.name in spec.names]))))
        metrics = [F.count(F.lit(1)).alias("total"), F.count_if(bad).alias("filtered"), F.coalesce(size, F.lit(0)).alias("bytes")]
        return checked.observe(obs, *metrics).where(~bad).drop(REASONS), checked.agg(*metrics), checked

    @staticmethod
    def judged(df: DataFrame, spec: TableSpec, strict: bool = True, columns: Iterable[str] | None = None) -> DataFrame:
        """Rows typed, with the reasons against them as a load of these ``columns`` (default: all) sees them."""
        if columns is not None:
            # a partial load is checked on its own columns only
            lower = {c.lower() for c in columns} | {k.lower() for k in spec.keys}
            spec = spec.with_columns([c for c in spec.columns if c.name.lower() in lower])
        checked = check_rows(df, spec, strict)
        if OP in df.columns:
            # a delete needs its key only
            lost = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in spec.keys], F.col(REASONS).contains(NO_IMAGE))
            checked = checked.withColumn(REASONS, F.when((F.col(OP) == 1) & ~lost, "").otherwise(F.col(REASONS)))
        return checked

    def _apply(
        self, m, spec, df, seq, mode, columns, merge_condition, ignore_update_before, kind, strict, max_filter_ratio, obs,
        query_id, batch_id, parallelism, merge_on_read,
    ) -> dict:
        keys = list(spec.keys)
        rows = ch.prepare(df, "unique" if spec.model == "unique" else "primary", ignore_update_before, kind)
        if "_sub" not in rows.columns:
            rows = rows.withColumn("_sub", F.lit(0))
        only = set(columns) if mode == "partial" else None
        given = [c for c in (columns or spec.names) if c not in keys]
        good, recount, checked = self._checked(rows, spec, strict, obs, only)
        order = [*seq, "_sub"]
        folded = ch.fold(good, keys, order, given if mode == "partial" else spec.values, mode, merge_condition)
        folded = folded.withColumn(BUCKET, F.pmod(F.hash(*keys), F.lit(spec.buckets))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = {r[BUCKET]: r["count"] for r in folded.groupBy(BUCKET).count().collect()}
            counts = observed(obs, recount)
            gate(counts["total"], counts["filtered"], max_filter_ratio, checked)
            changed = sum(touched.values())
            loaded = given if mode == "partial" else spec.values
            filled = bool(m["live"] or m.get("deltas"))
            as_delta = merge_on_read and filled and mode != "conditional" and bool(touched)
            commit, written = None, []
            if as_delta:
                rows = self._delta_rows(m, spec, folded, mode, loaded)
                commit, written = self._write_buckets(m, rows, spec, changed > SMALL_ROWS, query_id, batch_id, parallelism)
            elif touched:
                current = self._read(m, set(touched)) if filled else None
                merged = ch.merge(
                    current, folded.drop(BUCKET), keys, spec.names, loaded, mode, merge_condition,
                    # a large fold is not broadcast: one join of whole rows beats three with parts of them
                    strategy="outer" if mode != "full" and changed > SMALL_ROWS else "split",
                )
                commit, written = self._write(m, spec, merged, keys, changed > SMALL_ROWS, query_id, batch_id, parallelism)
        finally:
            folded.unpersist()
        live, deltas = m["live"], m.get("deltas", {})
        if as_delta:
            deltas = {**deltas, commit: {"buckets": written, "written": len(written), "rows": changed, "mode": mode}}
        else:
            live, deltas = _without(live, touched), _without(deltas, touched)
            if written:
                live[commit] = {"buckets": written, "written": len(written)}
        m = {**m, "deltas": deltas}
        return self._finish(m, live, commit, counts, query_id, batch_id, keys_changed=changed, buckets=len(touched))

    def _append(self, m, spec, df, strict, max_filter_ratio, obs, query_id, batch_id, parallelism) -> dict:
        rows = df
        if ch.KIND in rows.columns:
            rows = ch.filter_kinds(rows, has_pk=False)
        rows = rows.where(F.col(OP) == 0) if OP in rows.columns else rows
        good, recount, checked = self._checked(rows, spec, strict, obs, None)
        commit, _ = self._write(m, spec, good.select(*spec.names), None, False, query_id, batch_id, parallelism)
        counts = observed(obs, recount)
        try:
            gate(counts["total"], counts["filtered"], max_filter_ratio, checked)
        except Exception:
            self._files.delete(self._commit_dir(commit))
            raise
        live = {**m["live"], commit: {"buckets": None, "written": None}}
        return self._finish(m, live, commit, counts, query_id, batch_id)

    def merge_aggregate(
        self, delta: DataFrame, aggs: dict[str, Callable[[str], Column]], query_id: str | None = None, batch_id: int | None = None,
        manifest: dict | None = None,
    ) -> dict:
        """Aggregate-key load: rows with the same key are merged column by column, e.g. ``{"bitmap": F.bitmap_or_agg}``."""
        m = manifest or self.manifest()
        if query_id is not None and m["ledger"].get(query_id, -1) >= batch_id:
            return {"skipped": True, "version": m["version"]}
        spec = TableSpec.from_dict(m["spec"])
        keys = list(spec.keys)
        combine = lambda df: df.groupBy(*keys).agg(*[f(c).alias(c) for c, f in aggs.items()])
        folded = combine(delta.select(*spec.names))
        folded = folded.withColumn(BUCKET, F.pmod(F.hash(*keys), F.lit(spec.buckets))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = {r[BUCKET]: r["count"] for r in folded.groupBy(BUCKET).count().collect()}
            merged = folded.drop(BUCKET)
            if m["live"]:
                merged = combine(self._read(m, set(touched)).unionByName(merged))
            commit, written = self._write(m, spec, merged.select(*spec.names), keys, True, query_id, batch_id)
        finally:
            folded.unpersist()
        live = _without(m["live"], touched)
        if written:
            live[commit] = {"buckets": written, "written": len(written)}
        return self._finish(m, live, commit, {"total": sum(touched.values()), "filtered": 0}, query_id, batch_id)

    def compact(self, min_deltas: int = 0) -> None:
        """Merge deltas into the base and rewrite buckets with well-sized files: all buckets, or only those with at least
        ``min_deltas`` deltas. Without keys the loads since the last time become one, if there are at least ``min_deltas`` (0: all loads)."""
        m = self.manifest()
        spec = TableSpec.from_dict(m["spec"])
        if spec.model == "duplicate":
            loads = {c: e for c, e in m["live"].items() if not (min_deltas and e.get("merged"))}
            if len(loads) < max(min_deltas, 2):
                return
            commit, _ = self._write(m, spec, self._read({**m, "live": loads}), None, "always", None, None)
            live = {c: e for c, e in m["live"].items() if c not in loads} | {commit: {"buckets": None, "written": None, "merged": True}}
            self._finish(m, live, commit, {"total": 0, "filtered": 0}, None, None)
            return
        keys = list(spec.keys)
        live, deltas, chosen = {}, {}, None
        if min_deltas:
            counts = Counter(b for e in m.get("deltas", {}).values() for b in e["buckets"])
            chosen = {b for b, n in counts.items() if n >= min_deltas}
            if not chosen:
                return
            live, deltas = _without(m["live"], chosen), _without(m["deltas"], chosen)
        commit, written = self._write(m, spec, self._read(m, chosen), keys, "always", None, None)
        if written:
            live[commit] = {"buckets": written, "written": len(written)}
        self._finish({**m, "deltas": deltas}, live, commit, {"total": 0, "filtered": 0}, None, None)

    def _write(self, m, spec, df, keys, rebalance, query_id, batch_id, parallelism=None) -> tuple[str, list[int]]:
        named = [F.col(f"`{c}`").cast(spec.column(c).spark).alias(m["physical"][c]) for c in spec.names]
        if keys is None:
            commit, flat = self._new_commit(m, query_id, batch_id), df.select(*named)
            flat = flat.repartition(parallelism) if parallelism else flat
            (flat.hint("rebalance") if rebalance else flat).write.parquet(self._commit_dir(commit))
            return commit, []
        out = df.select(*named, F.pmod(F.hash(*keys), F.lit(spec.buckets)).alias(BUCKET))
        return self._write_buckets(m, out, spec, rebalance, query_id, batch_id, parallelism)

    def _new_commit(self, m, query_id, batch_id) -> str:
        who = f"{_safe(query_id)}-{batch_id}" if query_id is not None else "once-0"
        return f"{m['version'] + 1:010d}-{who}-{uuid.uuid4().hex[:8]}"

    def _write_buckets(self, m, out, spec, rebalance, query_id, batch_id, parallelism) -> tuple[str, list[int]]:
        """Write rows by bucket; returns the commit and the buckets that have rows."""
        commit = self._new_commit(m, query_id, batch_id)
        # Buckets use the hash of Spark's shuffles. When one of the two numbers divides the other, a shuffle partition
        # holds whole buckets or a part of one, and the files are few already.
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        aligned = partitions % spec.buckets == 0 or spec.buckets % partitions == 0
        if parallelism:
            out = out.repartition(parallelism, BUCKET)
        elif rebalance == "always" or (rebalance and not aligned):
            out = out.hint("rebalance", BUCKET)
        out.write.partitionBy(BUCKET).parquet(self._commit_dir(commit))
        prefix = f"{BUCKET}="
        return commit, [int(n[len(prefix):]) for n in self._files.names(self._commit_dir(commit)) if n.startswith(prefix)]

    def _finish(self, m, live, commit, counts, query_id, batch_id, **extra) -> dict:
        ledger = dict(m["ledger"])
        if query_id is not None:
            ledger[query_id] = batch_id
        version = m["version"] + 1
        try:
            self._publish({**m, "version": version, "live": live, "ledger": ledger})
        except ConcurrentCommit:
            if commit:
                self._files.delete(self._commit_dir(commit))
            raise
        return {"skipped": False, "version": version, **_row_counts(counts), **extra}

    # -- upkeep --------------------------------------------------------------------------------------------------

    def _kept(self) -> tuple[set[str], dict[str, set[int] | None]]:
        commits, buckets = set(), {}
        for v in self.versions():
            m = self.manifest(v)
            for c, e in {**m["live"], **m.get("deltas", {})}.items():
                commits.add(c)
                if e["buckets"] is None:
                    buckets[c] = None
                else:
                    buckets.setdefault(c, set()).update(e["buckets"])
        return commits, buckets

    def abort_stale(self, query_id: str) -> list[str]:
        """Remove what a crashed run of ``query_id`` staged but never published. Published commits are never touched."""
        kept, _ = self._kept()
        mine = re.compile(rf"\d{{10}}-{re.escape(_safe(query_id))}-\d+-[0-9a-f]{{8}}")
        stale = [
            c for n in self._files.names(f"{self.path}/data")
            if (c := n.removeprefix(f"{COMMIT}=")) not in kept and mine.fullmatch(c)
        ]
        for c in stale:
            self._files.delete(self._commit_dir(c))
        return stale

    def vacuum(self, keep: int = 2) -> int:
        """Forget all but the last ``keep`` versions and remove the commits and buckets only they used."""
        versions = self.versions()
        for v in versions[:-keep]:
            self._files.delete(self._manifest_path(v))
        newest = f"{versions[-1]:010d}"
        kept, buckets = self._kept()
        removed = 0
        for n in self._files.names(f"{self.path}/data"):
            c = n.removeprefix(f"{COMMIT}=")
            if c not in kept:
                if c[:10] <= newest:  # a later one may be a load in progress
                    removed += self._files.delete(self._commit_dir(c))
            elif buckets[c] is not None:
                for b in self._files.names(self._commit_dir(c)):
                    if b.startswith(f"{BUCKET}=") and int(b.split("=")[1]) not in buckets[c]:
                        removed += self._files.delete(f"{self._commit_dir(c)}/{b}")
        return removed


def _row_counts(counts: dict) -> dict:
    total, filtered = counts["total"], counts["filtered"]
    return {"total_rows": total, "loaded_rows": total - filtered, "filtered_rows": filtered, "loaded_bytes": counts.get("bytes", 0)}


def _without(entries: dict, buckets: Iterable[int]) -> dict:
    """Commit entries without some buckets; commits that have none left go."""
    gone, out = set(buckets), {}
    for c, e in entries.items():
        rest = [b for b in e["buckets"] if b not in gone]
        if rest:
            out[c] = {**e, "buckets": rest}
    return out


def _safe(query_id: str) -> str:
    """Letters and digits stay, other characters are written as their code, so different ids stay different."""
    return re.sub(r"[^A-Za-z0-9]", lambda c: f"_{ord(c[0]):x}_", query_id)


def owned(m: dict, query_id: str | None, stream_id: str | None) -> dict:
    """Manifest in which the id belongs to the checkpoint ``stream_id``; raises if it belongs to another one."""
    if query_id is None or stream_id is None:
        return m
    owner = m.get("owners", {}).get(query_id, stream_id)
    if owner != stream_id:
        raise ValueError(f"{query_id!r} is the id of another stream (checkpoint {owner}); give this one an id of its own")
    return {**m, "owners": {**m.get("owners", {}), query_id: stream_id}}


def aggregate_of(c: ColumnSpec) -> Callable[[str], Column]:
    """How values of a column of an aggregate table are merged: by its ``aggregate``, or what its type says."""
    name = (c.aggregate or {"BITMAP": "bitmap_union", "HLL": "hll_union"}.get(c.type.upper(), "")).lower()
    known = {"sum": F.sum, "min": F.min, "max": F.max, "bitmap_union": F.bitmap_or_agg, "hll_union": F.hll_union_agg}
    if name not in known:
        raise ValueError(f"column {c.name} of an aggregate table needs an aggregate: {', '.join(known)}")
    if name == "sum":
        return lambda x: F.sum(x).cast(c.spark)
    if name.endswith("_union"):  # null where no row has a sketch
        return lambda x: F.when(F.count(x) > 0, known[name](x))
    return known[name]


def evolve_manifest(m: dict, add: list[ColumnSpec], drop: list[str]) -> dict:
    """Manifest after dropping, then adding columns.

    A name used before gets a new name inside the files, so values of a dropped column never come back.
    """
    spec = TableSpec.from_dict(m["spec"])
    gone = {d.lower() for d in drop}
    if gone & {k.lower() for k in spec.keys}:
        raise ValueError("a key column cannot be dropped")
    for d in drop:
        spec.column(d)
    columns = [c for c in spec.columns if c.name.lower() not in gone]
    physical = {c.name: m["physical"][c.name] for c in columns}
    born = {k: v for k, v in m["born"].items() if k in physical}
    used, version = list(m["used"]), m["version"] + 1
    for c in add:
        columns.append(c)
        name = c.name if c.name.lower() not in {u.lower() for u in used} else f"{c.name}__{version}"
        physical[c.name] = name
        used.append(name)
        born[c.name] = version
    return {**m, "spec": spec.with_columns(columns).to_dict(), "physical": physical, "born": born, "used": used}
