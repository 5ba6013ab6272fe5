"""One stream of addressed text rows into many tables."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import Files, observed
from ..operators.columns import split_mapping
from ..sources.records import custom_records, decode_text
from ..store.registry import Registry
from ..store.rejects import RECORD
from ..store.table import _safe
from .apply import ARRIVAL, start_query, upkeep, with_arrival

ANY = "*"  # stands for every table in per-table options


def _incomplete() -> Column:
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return blank("database") | blank("table") | F.col("row").isNull()


def addressed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a full address, and rows to skip (no database, no table or no payload). An array payload is one row per
    element."""
    good, skipped = df.where(~_incomplete()), df.where(_incomplete())
    if isinstance(df.schema["row"].dataType, T.ArrayType):
        good = good.withColumn("row", F.explode("row"))
    return good, skipped


def stage(df: DataFrame, by: str, path: str) -> None:
    """Write a batch once, split by target, so every target reads its own part only.

    The rebalance gathers each target's rows, so tasks times targets does not become the number of files, and AQE splits
    a target that holds a large share of the batch.
    """
    df.hint("rebalance", by).write.partitionBy(by).parquet(path)


def staged_targets(spark: SparkSession, path: str, by: str) -> list[str]:
    """Targets present in a staged batch, from its folder names (read by Spark, so escaped names come back right)."""
    names = [n for n in Files(spark, path).names(path) if n.startswith(f"{by}=")]
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return [unescape(n[len(by) + 1:]) for n in names]


def in_parallel(jobs: Mapping[str, Callable[[], object]], width: int) -> dict[str, object]:
    """Submit one Spark job per table from a few driver threads; the first error is raised after all have ended."""
    with ThreadPoolExecutor(max_workers=max(1, min(width, len(jobs) or 1))) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: f.result() for name, f in futures.items()}


def route_batch(
    batch: DataFrame,
    registry: Registry,
    options: Mapping[str, Mapping] | None = None,
    query_id: str = "route",
    batch_id: int = 0,
    width: int = 8,
    stream_id: str | None = None,
    compact_every: int | None = None,
    vacuum_every: int | None = None,
) -> dict[str, dict]:
    """Decode and load the rows ``(database, table, row[, seq])`` of one batch into their tables.

    ``options`` holds load options per ``database.table`` over those under ``*``: ``format``, ``columns`` (a mapping),
    ``partial_update``, ``merge_condition``, ``max_filter_ratio``, ``rejects`` (keep filtered rows), separators. Rows of a keyed table follow ``seq``
    where the input has one, else the place of the row in its file (``_arrival``, see :func:`apply.with_arrival`), else the
    input order inside the batch. The batch is staged below the registry's root under a name of its own, which a repeated run
    replaces. ``compact_every`` and ``vacuum_every`` as in :func:`apply.stream_apply`. Returns the load report per table; skipped
    rows are counted under ``""``.
    """
    spark = batch.sparkSession
    options = dict(options or {})
    path = staging(registry, "route", query_id, batch_id)
    inside = F.monotonically_increasing_id()
    ordered = batch if "seq" in batch.columns else batch.withColumn("seq", F.struct(ARRIVAL, inside.alias("at")) if ARRIVAL in batch.columns else inside)
    obs = Observation(f"route_{uuid.uuid4().hex[:8]}")
    metrics = [F.count_if(_incomplete()).alias("skipped_rows"), F.count(F.lit(1)).alias("total_rows")]
    good, _ = addressed(ordered.observe(obs, *metrics))
    targeted = good.select("row", "seq", F.concat_ws(".", "database", "table").alias("_target"))
    stage(targeted, "_target", path)
    try:
        jobs = {}
        for target in staged_targets(spark, path, "_target"):
            staged = spark.read.schema(targeted.schema).parquet(path)
            rows = staged.where(F.col("_target") == target).drop("_target")
            own = {**options.get(ANY, {}), **options.get(target, {})}
            jobs[target] = lambda t=target, r=rows, o=own: _load_target(registry, t, r, o, query_id, batch_id, stream_id, compact_every, vacuum_every)
        reports = in_parallel(jobs, width)
    finally:
        Files(spark, path).delete(path)
    reports[""] = observed(obs, ordered.agg(*metrics))
    return reports


def staging(registry: Registry, kind: str, query_id: str, batch_id: int) -> str:
    """Folder of a staged batch, shared like the tables themselves; what a crashed run of the batch left there goes."""
    path = f"{registry.root}/_staging/{kind}-{_safe(query_id)}-{batch_id}"
    Files(registry.spark, path).delete(path)
    return path


def _load_target(
    registry: Registry, target: str, rows: DataFrame, options: dict, query_id: str, batch_id: int, stream_id: str | None,
    compact_every: int | None, vacuum_every: int | None,
) -> dict:
    database, _, name = target.partition(".")
    table = registry.table(database, name)
    spec = table.spec
    options = {**spec.options.get("load", {}), **options}
    mapping = options.get("columns")
    partial = str(options.get("partial_update", "false")).lower() == "true"
    if mapping:
        entries = split_mapping(mapping)
        fields = [n for n, e in entries if e is None]
    elif partial and options.get("partial_columns"):
        entries, fields = [], list(options["partial_columns"])
    else:
        entries, fields = [], list(spec.names)
    has_op = "__op" in fields
    keep = {"rejects": True, "max_filter_ratio": 1.0} if str(options.get("rejects", "false")).lower() == "true" else {"max_filter_ratio": 0.0}
    if "max_filter_ratio" in options:
        keep["max_filter_ratio"] = float(options["max_filter_ratio"])
    rows = rows.withColumn(RECORD, F.col("row")) if "rejects" in keep else rows
    text = decode_text(rows, fields, options.get("format", "json"), options, "row")
    if has_op:
        text = text.withColumn("__op", F.col("__op").try_cast("int"))
    columns = None
    if partial:
        columns = [c for c in spec.names if c in fields or c in {n for n, _ in entries}]
    extra = [c for c in text.columns if c not in (*spec.names, *fields, "__op", "_reasons", "seq", RECORD)]
    if partial and not mapping and not options.get("partial_columns") and options.get("format", "json") == "json":
        raise ValueError(f"a partial load of {target} needs columns or partial_columns: absent fields of a record would become null")
    report = table.load(
        text.drop(*extra), "seq", mode="partial" if partial else "full", columns=columns,
        merge_condition=options.get("merge_condition"), strict=options.get("strict", True),
        query_id=query_id, batch_id=batch_id, stream_id=stream_id, mapping=mapping, **keep,
    )
    upkeep(table, batch_id, compact_every, 8, vacuum_every)
    return report


def route(
    stream: DataFrame,
    registry: Registry,
    checkpoint: str,
    options: Mapping[str, Mapping] | None = None,
    query_id: str | None = None,
    trigger: str = "availableNow",
    on_report: Callable[[dict], None] | None = None,
    width: int = 8,
    compact_every: int | None = None,
    vacuum_every: int | None = None,
    records: Callable | None = None,
) -> StreamingQuery:
    """Streaming form of :func:`route_batch`; every table records the batch, so a replay skips the tables already done.

    ``records`` turns records of any schema into addressed rows first (:func:`sources.records.custom_records`).

    Records are kept under the checkpoint's id (see :func:`apply.stream_apply`). Without ``seq`` the source must be files.
    """
    stream = stream if "seq" in stream.columns else with_arrival(stream)
    stream = custom_records(stream, records, keep=("seq", ARRIVAL)) if records else stream

    def on_batch(batch: DataFrame, batch_id: int, stream_id: str) -> None:
        reports = route_batch(batch, registry, options, query_id or stream_id, batch_id, width, stream_id, compact_every, vacuum_every)
        if on_report:
            on_report(reports)

    return start_query(stream, on_batch, checkpoint, trigger)
