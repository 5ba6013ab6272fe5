"""Whole-database synchronisation from a stream of Debezium events."""

from __future__ import annotations

import contextlib
import uuid
from typing import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import Files, observed
from ..spec import TableSpec
from ..store.registry import Registry
from ..functions.temporal import ZONE
from ..store.table import evolve_manifest, owned
from ..streaming.apply import ARRIVAL, start_query, upkeep, with_arrival
from ..streaming.route import in_parallel, stage, staged_targets, staging
from .ddl import STATEMENT, column_of, ddl_to_actions, last_actions, parse_ddl
from .start import Position
from .debezium import OPS, ORDER, debezium_to_changes, parse_debezium

_AT = [*ORDER, "_in"]


def sync_batch(
    batch: DataFrame,
    registry: Registry,
    targets: Mapping[tuple[str, str], tuple[str, str]],
    query_id: str = "sync",
    batch_id: int = 0,
    schema_evolution: bool = False,
    ignore_update_before: bool = True,
    order: Iterable[str] | None = None,
    width: int = 8,
    strict: bool = True,
    max_filter_ratio: float = 0.0,
    col: str = "value",
    ddl_pattern: str = STATEMENT,
    stream_id: str | None = None,
    temporals: Mapping[tuple[str, str], Mapping[str, str]] | None = None,
    zone: str = ZONE,
    compact_every: int | None = None,
    vacuum_every: int | None = None,
    rejects: bool = False,
    start: Position | None = None,
) -> dict[str, dict]:
    """Apply one batch of change events to all tables; with ``rejects`` each keeps the rows it filters (:class:`store.rejects.Rejects`).

    ``targets`` maps (source database, source table) to (database, table); events of other tables are left out. ``order``
    names columns of ``batch`` that order the events (such as a topic offset); without it the position in the envelope
    decides, then the place in the file (``_arrival``) where the batch has it, then the input order inside the batch.

    ``temporals`` gives per (database, table) of the targets the encoding of temporal columns (see
    :func:`functions.temporal.encoded_text`); ``zone`` shows instants. A number in another encoding is a rejected row. The report
    under ``""`` counts events, invalid ones and those of tables that are not listed. Events before ``start`` are left out and not counted.

    The batch is parsed once and staged by target table, so each table reads its own part only. A table's DDL
    statements and rows go into one commit.
    """
    spark = batch.sparkSession
    order = list(order) if order is not None else None
    arrived = ARRIVAL in batch.columns and not order
    keep = order or ([ARRIVAL] if arrived else [])
    events = parse_debezium((start.skip(batch) if start else batch).select(col, *keep), col).withColumn("_in", F.monotonically_increasing_id())
    events = start.since(events) if start else events
    known_op = F.coalesce(F.col("op").isin(*OPS), F.lit(False))
    invalid = ~known_op & (F.col("op").isNotNull() | F.col("ddl").isNull())
    obs = Observation(f"sync_{uuid.uuid4().hex[:8]}")
    unlisted = ~invalid & F.col("_target").isNull()
    metrics = [F.count(F.lit(1)).alias("total_events"), F.count_if(invalid).alias("invalid_events"), F.count_if(unlisted).alias("unlisted_events")]
    # one row per source table, which the caller holds in memory already
    listed = spark.createDataFrame([(db, t, f"{tdb}.{tt}") for (db, t), (tdb, tt) in targets.items()], "_db string, _table string, _target string")
    named = events.join(F.broadcast(listed), (F.col("src_db") == F.col("_db")) & (F.col("src_table") == F.col("_table")), "left").drop("_db", "_table")
    routed = named.observe(obs, *metrics).where(~invalid & F.col("_target").isNotNull())
    path = staging(registry, "sync", query_id, batch_id)
    stage(routed, "_target", path)
    at = order or ([*ORDER, ARRIVAL, "_in"] if arrived else _AT)
    try:
        found = staged_targets(spark, path, "_target")
        staged = spark.read.schema(routed.schema).parquet(path)
        actions = _actions(staged, at, ddl_pattern) if schema_evolution and found else {}
        jobs = {}
        for target in found:
            rows = staged.where(F.col("_target") == target).drop("_target")
            jobs[target] = lambda t=target, r=rows: _sync_table(
                registry, t, r, actions.get(t, []), at, query_id, batch_id, ignore_update_before, strict, max_filter_ratio, stream_id,
                (temporals or {}).get(tuple(t.split(".", 1)), {}), zone, compact_every, vacuum_every, rejects
            )
        reports = in_parallel(jobs, width)
    finally:
        Files(spark, path).delete(path)
    reports[""] = observed(obs, named.agg(*metrics))
    return reports


def _actions(staged: DataFrame, at: list[str], pattern: str) -> dict[str, list]:
    """Last column action per target and column. Reduced by Spark first: the driver gets one row per column, in the order
    the columns were added, however many statements there were."""
    found = last_actions(ddl_to_actions(parse_ddl(staged), pattern=pattern), ["_target"], at)
    out: dict[str, list] = {}
    for r in found.orderBy("_target", "_at").toLocalIterator():
        out.setdefault(r["_target"], []).append(r)
    return out


def _sync_table(
    registry, target, rows, actions, at, query_id, batch_id, ignore_update_before, strict, max_filter_ratio, stream_id, temporals, zone,
    compact_every, vacuum_every, rejects=False,
) -> dict:
    database, _, name = target.partition(".")
    table = registry.table(database, name)
    manifest = table.manifest()
    if owned(manifest, query_id, stream_id)["ledger"].get(query_id, -1) >= batch_id:
        return {"skipped": True, "version": manifest["version"]}
    add, drop, reborn, unknown = plan_actions(TableSpec.from_dict(manifest["spec"]), actions)
    evolved = evolve_manifest(manifest, add, drop) if add or drop else manifest
    spec = TableSpec.from_dict(evolved["spec"])
    # a column created (again) inside the batch takes only values of events after its creation
    since = {
        c: F.struct(*[F.col(a) for a in at]) > F.struct(*[F.lit(pos[a]).alias(a) for a in at]) for c, pos in reborn.items()
    }
    changes = debezium_to_changes(rows, spec, ignore_update_before, keep=at, since=since, temporals=temporals, zone=zone)
    report = table.load(
        changes, at, query_id=query_id, batch_id=batch_id, evolve=lambda m: evolved, strict=strict,
        max_filter_ratio=max(max_filter_ratio, float(rejects)), stream_id=stream_id, rejects=rejects,
    )
    upkeep(table, batch_id, compact_every, 8, vacuum_every)
    return {**report, "unknown_columns": unknown} if unknown else report


def plan_actions(spec: TableSpec, actions: list) -> tuple[list, list, dict, list]:
    """Columns to add, columns to drop, the positions of columns dropped and created again, and columns of unknown type.

    Adding a column that exists and dropping one that does not are ignored, as are key columns.
    """
    have = {c.lower(): c for c in spec.names}
    keys = {k.lower() for k in spec.keys}
    add, drop, reborn, unknown = [], [], {}, []
    for a in actions:
        name = a["column"].lower()
        if name in keys:
            continue
        if a["action"] == "drop":
            if name in have:
                drop.append(have[name])
            continue
        column = column_of(a)
        if column is None:
            unknown.append(f"{a['column']} {a['type']}")
            continue
        if name in have and not a["n_drop"]:
            continue
        if name in have:
            drop.append(have[name])
        if a["n_drop"]:
            reborn[a["column"]] = a["_at"]
        add.append(column)
    return add, drop, reborn, unknown


def target_map(specs: Mapping[tuple[str, str], TableSpec]) -> dict[tuple[str, str], tuple[str, str]]:
    return {source: (s.database, s.table) for source, s in specs.items()}


def sync_database(
    stream: DataFrame,
    registry: Registry,
    specs: Mapping[tuple[str, str], TableSpec],
    checkpoint: str,
    query_id: str | None = None,
    trigger: str = "availableNow",
    on_report: Callable[[dict], None] | None = None,
    start: str | Mapping | Position | None = None,
    **options,
) -> StreamingQuery:
    """Create the missing tables, then keep them in sync with a stream of change events, exactly once.

    ``specs`` comes from :func:`cdc.schema.infer_specs`, which applies the table filters, prefix and suffix. A replayed
    batch skips the tables that already recorded it (under the checkpoint's id, see :func:`streaming.apply.stream_apply`).
    Temporal encodings come from the source types that the specs carry, unless ``temporals`` is given. A source other than
    files needs ``order``, or positions in its envelopes. ``start`` is a place in the feed (:class:`start.Position`: a time, or a log
    file and a place in it); give the same one again on a restart. After :func:`start.load_snapshot` it is the snapshot's end.
    """
    options["start"] = Position.of(start)
    registry.ensure_tables(specs.values())
    targets = target_map(specs)
    options.setdefault("temporals", {(s.database, s.table): s.options["temporals"] for s in specs.values() if "temporals" in s.options})
    if not options.get("order"):
        with contextlib.suppress(ValueError):
            stream = with_arrival(stream)
    cleared = []

    def on_batch(batch: DataFrame, batch_id: int, stream_id: str) -> None:
        own = query_id or stream_id
        if not cleared:
            cleared.extend(registry.table(s.database, s.table).abort_stale(own) for s in specs.values())
        reports = sync_batch(batch, registry, targets, own, batch_id, stream_id=stream_id, **options)
        if on_report:
            on_report(reports)

    return start_query(stream, on_batch, checkpoint, trigger)
