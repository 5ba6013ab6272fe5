"""Streaming loads, routing, streaming lookup, keyed tables and the registry."""

from __future__ import annotations

import contextlib
import json
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from .. import operators as op, streaming
from ..session import Files, work_dir
from ..spec import ColumnSpec, TableSpec
from ..store import KeyedTable, Registry, Rejects
from . import encoding
from .changes import ORDER_SEQ, SEQ, order_log
from .encoding import raw_events
from .reads import C, table

EVENT_SPEC = TableSpec(
    "db", "last_event", (ColumnSpec("user_id", "BIGINT", False), ColumnSpec("event_type", "STRING"), ColumnSpec("value", "DOUBLE"), ColumnSpec("props", "STRING")),
    keys=("user_id",), buckets=8,
)


def _table(spark, spec=EVENT_SPEC):
    return KeyedTable.create(spark, f"{work_dir(spark, 'table')}/{spec.table}", spec)


def _stream(spark, d, name):
    """File stream over one given table."""
    schema = table(spark, d, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(d)


def _log(df):
    kind = F.when(C("event_type") == "error", "-D").otherwise("+U")
    return df.select("user_id", "event_type", "value", "props", *SEQ, kind.alias("_kind"))


def stream_apply(spark, d):
    t = _table(spark)
    streaming.stream_apply(_log(_stream(spark, d, "events")), t, work_dir(spark, "checkpoint"), SEQ).awaitTermination()
    return t.read()


def _restored(spark, checkpoint):
    """Copy of a checkpoint from before its last commit: its last batch will be delivered again."""
    copy, files = work_dir(spark, "checkpoint"), Files(spark, checkpoint)
    files.mkdirs(copy)
    for name in files.names(checkpoint):
        if name != "commits":
            files.copy(f"{checkpoint}/{name}", f"{copy}/{name}")
    return copy


def stream_replay(spark, d):
    """A batch that a restored checkpoint delivers again is loaded once."""
    t, first = _table(spark), work_dir(spark, "checkpoint")
    streaming.stream_apply(_log(_stream(spark, d, "events")), t, first, SEQ).awaitTermination()
    streaming.stream_apply(_log(_stream(spark, d, "events")), t, _restored(spark, first), SEQ).awaitTermination()
    return t.read().select("user_id", "event_type", F.lit(t.manifest()["version"]).alias("version"))


def stream_two_sources(spark, d):
    """Two streams with default options into one table: both arrive."""
    t = _table(spark)
    for part in ("user_id % 2 = 0", "user_id % 2 = 1"):
        streaming.stream_apply(_log(_stream(spark, d, "events").where(part)), t, work_dir(spark, "checkpoint"), SEQ).awaitTermination()
    return t.read()


def stream_bounded(spark, d):
    """Events as several files, admitted one per batch."""
    t, path = _table(spark), work_dir(spark, "in")
    table(spark, d, "events").repartition(4, "user_id").write.parquet(path)
    stream = spark.readStream.schema(table(spark, d, "events").schema).options(**streaming.admission(max_files=1)).parquet(path)
    streaming.stream_apply(_log(stream), t, work_dir(spark, "checkpoint"), SEQ).awaitTermination()
    return t.read().withColumn("batches", F.lit(t.manifest()["version"]))


def stream_bounded_rows(spark, d):
    """One large micro-batch as commits of at most so many rows; the job fails after the second one and goes on from there."""
    t, first, sizes = _table(spark), work_dir(spark, "checkpoint"), []
    most = -(-table(spark, d, "events").count() // 5)

    def report(r):
        if not r["skipped"]:
            sizes.append(r["total_rows"])
        if len(sizes) == 2:
            sizes.append(0)  # once
            raise RuntimeError("the job fails")

    log = _log(_stream(spark, d, "events"))
    run = lambda **options: streaming.stream_apply(log, t, first, SEQ, max_rows=most, report=report, **options).awaitTermination()
    with contextlib.suppress(StreamingQueryException):
        run()
    run()
    return t.read().withColumns({"commits": F.lit(t.manifest()["version"]), "bounded": F.lit(max(sizes) <= most)})


def stream_at_least_once(spark, d):
    """Without a record of batches a replay loads again; the fold by key gives the same rows."""
    t, first = _table(spark), work_dir(spark, "checkpoint")
    for checkpoint in (first, None):
        streaming.stream_apply(_log(_stream(spark, d, "events")), t, checkpoint or _restored(spark, first), SEQ, exactly_once=False).awaitTermination()
    return t.read().withColumn("version", F.lit(t.manifest()["version"]))


def keyed_table_batches(spark, d, on_read=False):
    """Customers loaded, then orders applied as three consecutive batches by date."""
    spec = TableSpec(
        "db", "customer", (ColumnSpec("c_custkey", "BIGINT", False), ColumnSpec("c_name", "STRING"), ColumnSpec("c_acctbal", "DECIMAL(12,2)"), ColumnSpec("c_mktsegment", "STRING")),
        keys=("c_custkey",), buckets=8,
    )
    t = _table(spark, spec)
    t.load(table(spark, d, "customer").drop("c_nationkey").withColumn("_seq", F.lit(0)), "_seq")
    log, at = order_log(spark, d), C("o_orderdate")
    cuts = [at < F.lit("1997-01-01").cast("timestamp_ntz"), at < F.lit("1999-01-01").cast("timestamp_ntz")]
    for i, part in enumerate([cuts[0], ~cuts[0] & cuts[1], ~cuts[1]]):
        t.load(log.where(part), ORDER_SEQ, query_id="orders", batch_id=i, merge_on_read=on_read)
    return t.read()


def keyed_table_deltas(spark, d):
    """The same loads, kept as deltas and merged when the table is read."""
    return keyed_table_batches(spark, d, True)


def gated_load(spark, d):
    """Unchecked text into a keyed table: misfits are rejected, counted and held against the allowed ratio."""
    spec = TableSpec(
        "db", "checked", (ColumnSpec("event_id", "BIGINT", False), ColumnSpec("kind", "VARCHAR(6)"), ColumnSpec("level", "TINYINT"), ColumnSpec("owner", "BIGINT", False)),
        keys=("event_id",), buckets=8,
    )
    t = _table(spark, spec)
    t.load(raw_events(spark, d).withColumn("_seq", F.lit(0)), "_seq", max_filter_ratio=0.9)
    return t.read()


CHECKED = TableSpec(
    "db", "checked", (ColumnSpec("event_id", "BIGINT", False), ColumnSpec("kind", "VARCHAR(6)"), ColumnSpec("level", "TINYINT"), ColumnSpec("owner", "BIGINT", False)),
    keys=("event_id",), buckets=8,
)


def _with_rejects(spark, d):
    """Unchecked text through a stream that keeps what it filters; the last batch is delivered twice."""
    t, path, first = _table(spark, CHECKED), work_dir(spark, "in"), work_dir(spark, "checkpoint")
    raw_events(spark, d).withColumn("_seq", F.lit(0)).write.parquet(path)
    for checkpoint in (first, None):
        stream = spark.readStream.schema("event_id string, kind string, level string, owner string, _seq int").parquet(path)
        streaming.stream_apply(stream, t, checkpoint or _restored(spark, first), "_seq", rejects=True).awaitTermination()
    return t


def rejects_table(spark, d):
    """Rows that a load filtered, with their input and with reasons that show no values; good rows are in the table."""
    t = _with_rejects(spark, d)
    bad = Rejects(t).read().select(F.variant_get("row", "$.event_id", "bigint").alias("event_id"), F.variant_get("row", "$.level", "string").alias("level"), "reasons")
    return bad.union(t.read().select("event_id", C("level").cast("string"), F.lit(None)))


def rejects_replay(spark, d):
    """Rejected rows are corrected and loaded again; those that still do not fit stay open."""
    t = _with_rejects(spark, d)

    def fix(rows):
        level = F.when(C("level").cast("int") > 200, C("level")).otherwise(F.least(C("level").cast("int"), F.lit(127)).cast("string"))
        return rows.withColumns({"kind": F.substring("kind", 1, 6), "level": level, "owner": F.coalesce("owner", F.lit("0"))})

    rejects = Rejects(t)
    rejects.replay(fix, "_seq")
    left = [rejects.rows(n).select("event_id", "kind", "level", "owner", F.lit(True).alias("open")) for n in rejects.open()]
    loaded = t.read().select(C("event_id").cast("string"), "kind", C("level").cast("string"), C("owner").cast("string"), F.lit(False).alias("open"))
    return reduce(lambda a, b: a.union(b), left, loaded)


def stream_lookup(spark, d):
    orders = _stream(spark, d, "orders").select("o_orderkey", C("o_custkey").alias("c_custkey"))
    out = work_dir(spark, "joined")
    reader = lambda: table(spark, d, "customer", columns=["c_custkey", "c_mktsegment"])
    write = lambda df, batch_id: df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    first = work_dir(spark, "checkpoint")
    for checkpoint in (first, None):  # the last batch is delivered twice and replaces what it wrote
        streaming.stream_lookup_join(orders, reader, ["c_custkey"], write, checkpoint or _restored(spark, first), "left").awaitTermination()
    return spark.read.parquet(out).drop("batch")


def stream_lookup_cached(spark, d):
    """Orders in three runs of one stream; the dimension changes before each. Keys that are known and not expired keep what was read for them.

    The clock says 0, 1 and 2 s, rows are kept for 1.5 s; the last batch is delivered twice.
    """
    root, now = work_dir(spark, "lookup"), [0]
    orders = table(spark, d, "orders").select("o_orderkey", C("o_custkey").alias("c_custkey"))
    customers = table(spark, d, "customer").where("c_custkey % 11 <> 0")
    reader = lambda: customers.select("c_custkey", F.lit(now[0]).alias("read_at"))
    write = lambda df, batch_id: df.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")
    run = lambda checkpoint: streaming.stream_lookup_join(
        spark.readStream.schema(orders.schema).parquet(f"{root}/in"), reader, ["c_custkey"], write, checkpoint, "left",
        keys=streaming.KeyCache(spark, f"{root}/keys", 1500, clock=lambda: now[0])).awaitTermination()
    for now[0] in range(3):
        orders.where(C("o_orderkey") % 3 == now[0]).write.mode("append").parquet(f"{root}/in")
        run(f"{root}/checkpoint")
    run(_restored(spark, f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/out").drop("batch")


def load_latencies(spark, d):
    """Reports of loads (events stand for them) recorded in four parts with folds between: quantiles of merged sketches against exact ranks."""
    reports, e = streaming.LoadReports(spark, work_dir(spark, "reports")), table(spark, d, "events")
    rows = e.select(C("event_type").alias("query_id"), F.lit("t").alias("target"), C("event_id").alias("batch_id"), F.lit(0).cast("bigint").alias("at"),
                    (C("value") * 100).cast("bigint").alias("load_ms"), C("user_id").cast("bigint").alias("rows"), (C("event_id") % 2).cast("bigint").alias("filtered"), (C("user_id") * 8).cast("bigint").alias("bytes"))
    for i in range(4):
        for _ in range(2):  # a part that is recorded again replaces itself
            reports.record_rows(rows.where(C("batch_id") % 4 == i), f"part-{i}")
        if i % 2:
            reports.fold()
    found = reports.latencies()
    ranks = rows.join(F.broadcast(found.select("query_id", "p50_ms", "p95_ms")), "query_id").groupBy("query_id").agg(
        (F.abs(F.avg((C("load_ms") <= C("p50_ms")).cast("int")) - 0.5) < 0.04).alias("p50_fits"), (F.abs(F.avg((C("load_ms") <= C("p95_ms")).cast("int")) - 0.95) < 0.04).alias("p95_fits"))
    return found.select("query_id", "batches", "rows", "filtered", "bytes").join(ranks, "query_id")


def stream_route(spark, d):
    """Suppliers and nations as one stream of addressed JSON rows, with incomplete rows among them."""
    root = work_dir(spark, "route")
    registry = Registry(spark, f"{root}/tables")
    specs = [
        TableSpec("db", "supplier", (ColumnSpec("id", "BIGINT", False), ColumnSpec("name", "STRING")), keys=("id",), buckets=4),
        TableSpec("db", "part", (ColumnSpec("id", "BIGINT", False), ColumnSpec("name", "STRING"), ColumnSpec("size", "INT")), keys=("id",), buckets=4),
    ]
    registry.ensure_tables(specs)
    s = table(spark, d, "supplier").select(F.lit("db").alias("database"), F.lit("supplier").alias("table"), F.to_json(F.struct(C("s_suppkey").alias("id"), C("s_name").alias("name"))).alias("row"))
    p = table(spark, d, "part").select(
        F.lit("db"), F.when(C("p_size") != 13, F.lit("part")), F.array_join(F.array(C("p_partkey").cast("string"), "p_name", C("p_size").cast("string")), "|"))
    s.union(p).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("database string, table string, row string").parquet(f"{root}/in")
    options = {"*": {"format": "json"}, "db.part": {"format": "csv", "column_separator": "|", "columns": "id,name,size"}}
    streaming.route(stream, registry, f"{root}/checkpoint", options).awaitTermination()
    return registry.read("db", "supplier").select("id", "name", F.lit(None).cast("int").alias("size")).union(registry.read("db", "part"))


PARTS = TableSpec("db", "part", (ColumnSpec("id", "BIGINT", False), ColumnSpec("name", "STRING"), ColumnSpec("size", "INT")), keys=("id",), buckets=4)


def _parts(df, *fields):
    return df.select(F.lit("db").alias("database"), F.lit("part").alias("table"), F.to_json(F.struct(*fields)).alias("row"))


def _routed(spark, root, options):
    """Files of addressed rows below ``root``/in, routed into a registry in one batch."""
    registry = Registry(spark, f"{root}/tables")
    registry.ensure_tables([PARTS])
    stream = spark.readStream.schema("database string, table string, row string").parquet(f"{root}/in")
    streaming.route(stream, registry, f"{root}/checkpoint", options).awaitTermination()
    return registry.read("db", "part")


def stream_route_order(spark, d):
    """A few rows in an early file, all rows in a later and larger one, some again in a last one: the latest file wins."""
    root, p = work_dir(spark, "route"), table(spark, d, "part")
    row = lambda note: (C("p_partkey").alias("id"), F.concat(F.lit(note), "p_name").alias("name"), C("p_size").alias("size"))
    for df, note in ((p.where("p_size < 5"), "first "), (p, "second "), (p.where("p_size > 45"), "third ")):
        _parts(df, *row(note)).write.mode("append").parquet(f"{root}/in")
    return _routed(spark, root, {"*": {"format": "json"}})


def stream_route_partial(spark, d):
    """Whole rows, then partial JSON records of one column: the others keep their values."""
    root, p = work_dir(spark, "route"), table(spark, d, "part")
    registry = Registry(spark, f"{root}/tables")
    registry.ensure_tables([PARTS])
    whole = p.select(C("p_partkey").alias("id"), C("p_name").alias("name"), C("p_size").alias("size"), F.lit(0).alias("_seq"))
    registry.apply("db", "part", whole, seq="_seq")
    _parts(p.where("p_size > 25"), C("p_partkey").alias("id"), (C("p_size") + 100).alias("size")).write.parquet(f"{root}/in")
    return _routed(spark, root, {"*": {"format": "json", "partial_update": "true", "partial_columns": ["id", "size"]}})


def stream_route_arrays(spark, d):
    """Payloads that are arrays of records: one row per element."""
    root, p = work_dir(spark, "route"), table(spark, d, "part")
    registry = Registry(spark, f"{root}/tables")
    registry.ensure_tables([PARTS])
    record = F.to_json(F.struct(C("p_partkey").alias("id"), C("p_name").alias("name"), C("p_size").alias("size")))
    p.groupBy((C("p_partkey") % 100).alias("g"), "p_size").agg(F.collect_list(record).alias("row")).select(
        F.lit("db").alias("database"), F.lit("part").alias("table"), "row").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("database string, table string, row array<string>").parquet(f"{root}/in")
    streaming.route(stream, registry, f"{root}/checkpoint", {"*": {"format": "json"}}).awaitTermination()
    return registry.read("db", "part")


def _turns(batch):
    """Two rows for a user's turn, one for an assistant's, none for others."""
    out = []
    for conv, turn, role, chars in zip(*(c.to_pylist() for c in batch.columns)):
        row = ("db", "turn", json.dumps({"id": conv * 1000 + turn, "role": role, "chars": chars}))
        out.append([row, ("db", "asked", json.dumps({"id": conv * 1000 + turn, "chars": chars}))] if role == "user" else [row] if role == "assistant" else [])
    return out


def custom_route(spark, d):
    """Records through a function that gives none, one or two addressed rows for each, on a stream, into two tables."""
    root, seen = work_dir(spark, "route"), []
    registry = Registry(spark, f"{root}/tables")
    registry.ensure_tables([
        TableSpec("db", "turn", (ColumnSpec("id", "BIGINT", False), ColumnSpec("role", "STRING"), ColumnSpec("chars", "INT")), keys=("id",), buckets=4),
        TableSpec("db", "asked", (ColumnSpec("id", "BIGINT", False), ColumnSpec("chars", "INT")), keys=("id",), buckets=4)])
    records = table(spark, d, "conversations").select("conv_id", "turn", "role", F.length("text").alias("chars"))
    records.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(records.schema).parquet(f"{root}/in")
    streaming.route(stream, registry, f"{root}/checkpoint", {"*": {"format": "json"}}, records=_turns, on_report=seen.append).awaitTermination()
    skipped = sum(r[""]["skipped_rows"] for r in seen)
    turns, asked = registry.read("db", "turn"), registry.read("db", "asked")
    return turns.select(F.lit("turn").alias("t"), "id", "role", "chars").union(asked.select(F.lit("asked"), "id", F.lit(None), "chars")).withColumn("skipped", F.lit(skipped))


def aggregate_load(spark, d):
    """Orders per customer in two loads into an aggregate table: sums and maxima are merged, not replaced."""
    spec = TableSpec(
        "db", "spent", (ColumnSpec("custkey", "BIGINT", False), ColumnSpec("n", "BIGINT", aggregate="sum"), ColumnSpec("total", "DECIMAL(18,2)", aggregate="sum"), ColumnSpec("last", "DATETIME", aggregate="max"), ColumnSpec("least", "BIGINT", aggregate="min")),
        model="aggregate", keys=("custkey",), buckets=4,
    )
    root = work_dir(spark, "registry")
    registry = Registry(spark, root)
    KeyedTable.create(spark, f"{root}/db/spent", spec)
    o, early = table(spark, d, "orders"), C("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    row = [C("o_custkey").alias("custkey"), F.lit(1).cast("bigint").alias("n"), C("o_totalprice").cast("decimal(18,2)").alias("total"), C("o_orderdate").alias("last"), C("o_orderkey").alias("least")]
    for i, part in enumerate([o.where(early), o.where(~early), o.where(early)]):
        registry.apply("db", "spent", part.select(*row), query_id="spent", batch_id=min(i, 1))
    return registry.read("db", "spent")


DAILY = op.sketch_table(TableSpec(
    "db", "daily", (ColumnSpec("kind", "STRING", False), ColumnSpec("day", "DATE", False), ColumnSpec("n", "BIGINT", aggregate="sum"), ColumnSpec("top", "DOUBLE", aggregate="max"),
                    ColumnSpec("users", "BITMAP"), ColumnSpec("events", "BITMAP"), ColumnSpec("about", "HLL")),
    model="aggregate", keys=("kind", "day"), buckets=4))
MAPPING = "event_id,ts,kind,user_id,value,day=to_date(ts),n=1,top=value,users=to_bitmap(user_id),events=to_bitmap(event_id * 3),about=hll_hash(user_id)"


def aggregate_columns_load(spark, d):
    """Aggregate functions in a load's columns: bitmaps and HLL are built per key before they meet the table, in three loads, one of them twice."""
    root = work_dir(spark, "registry")
    KeyedTable.create(spark, f"{root}/db/daily", DAILY)
    registry, e = Registry(spark, root), table(spark, d, "events").select("event_id", "ts", "event_type", "user_id", "value")
    for i in (0, 1, 1, 2):
        registry.apply("db", "daily", e.where(C("event_id") % 3 == i), query_id="daily", batch_id=i, mapping=MAPPING)
    return _daily(registry)


def _daily(registry):
    rows = registry.read("db", "daily", columns=DAILY.names)
    by_day = op.aggregate_values(rows, DAILY).select("kind", C("day").cast("string").alias("day"), "n", "top", "users", "events", C("about") > 0)
    near = F.abs(C("about") - C("users")) <= 0.1 * C("users") + 1
    return by_day.union(op.aggregate_values(rows, DAILY, ["kind"]).select("kind", F.lit("all"), "n", "top", "users", "events", near)).toDF("kind", "day", "n", "top", "users", "events", "estimate_fits")


def route_aggregate_columns(spark, d):
    """The same through routed CSV records; those that fit no bitmap are kept as rejected rows."""
    root = work_dir(spark, "route")
    KeyedTable.create(spark, f"{root}/tables/db/daily", DAILY)
    e = table(spark, d, "events")
    user = F.when(C("event_id") % 10 == 0, F.lit("-1")).otherwise(C("user_id").cast("string"))
    row = F.concat_ws("|", C("event_id"), C("ts"), "event_type", user, "value")
    e.select(F.lit("db").alias("database"), F.lit("daily").alias("table"), row.alias("row")).write.parquet(f"{root}/in")
    registry = Registry(spark, f"{root}/tables")
    stream = spark.readStream.schema("database string, table string, row string").parquet(f"{root}/in")
    options = {"*": {"format": "csv", "column_separator": "|", "columns": MAPPING, "rejects": "true"}}
    streaming.route(stream, registry, f"{root}/checkpoint", options).awaitTermination()
    bad = Rejects(registry.table("db", "daily")).read().groupBy("reasons").agg(F.count("*").alias("n"))
    return _daily(registry).union(bad.select("reasons", F.lit("bad"), "n", F.lit(None), F.lit(None), F.lit(None), F.lit(None)))


def registry_evolve(spark, d):
    """A table loses and gains columns; a partial load fills the new one."""
    registry = Registry(spark, work_dir(spark, "registry"))
    spec = TableSpec.from_schema("db", "part", table(spark, d, "part").drop("p_retailprice").schema, ["p_partkey"], buckets=8)
    registry.ensure_tables([spec])
    registry.apply("db", "part", table(spark, d, "part").drop("p_retailprice").withColumn("_seq", F.lit(0)), seq="_seq")
    registry.evolve("db", "part", add=[ColumnSpec("grade", "INT", True, "7")], drop=["p_type"])
    cheap = table(spark, d, "part", where=C("p_size") > 25).select("p_partkey", (C("p_size") + 100).alias("grade"), F.lit(1).alias("_seq"))
    registry.apply("db", "part", cheap, seq="_seq", mode="partial", columns=["grade"])
    return registry.read("db", "part", columns=["p_partkey", "p_name", "grade"])


def registry_select(spark, d):
    """Selections through the registry; key conditions whose literal has another type than the key find the rows that a scan finds."""
    registry = Registry(spark, work_dir(spark, "registry"), source_options={"scan.columns": "n_name, n_nationkey"})
    nation = table(spark, d, "nation").withColumn("_seq", F.lit(0))
    registry.ensure_tables([TableSpec.from_schema("db", "nation", table(spark, d, "nation").schema, ["n_nationkey"], buckets=2)])
    registry.apply("db", "nation", nation, seq="_seq")
    # numbers as text, with and without leading zeros
    text = table(spark, d, "part").select(F.concat(F.repeat(F.lit("0"), C("p_size") % 3), C("p_partkey").cast("string")).alias("code"), "p_name", F.lit(0).alias("_seq"))
    registry.ensure_tables([TableSpec("db", "code", (ColumnSpec("code", "STRING", False), ColumnSpec("p_name", "STRING")), keys=("code",), buckets=8)])
    registry.apply("db", "code", text, seq="_seq")
    found = [registry.read("db", "nation", where="n_regionkey >= 2").select("n_name", "n_nationkey"), registry.read("db", "nation", where="n_nationkey IN ('3', '5')").select("n_name", "n_nationkey")]
    for where in ("code = 7", "code IN (8, 9)", "code = '10'", "code IN ('011', '0012')"):
        found.append(registry.read("db", "code", columns=["p_name", "code"], where=where).select("p_name", C("code").cast("int")))
    return reduce(lambda a, b: a.union(b), found)


def aggregate_table(spark, d):
    """Bitmaps of users per event type, loaded in two batches into an aggregate-key table."""
    spec = TableSpec(
        "db", "uv", (ColumnSpec("event_type", "STRING", False), ColumnSpec("bitmap_bucket", "BIGINT", False), ColumnSpec("bitmap", "BITMAP")),
        model="aggregate", keys=("event_type", "bitmap_bucket"), buckets=4,
    )
    t = _table(spark, spec)
    events, early = table(spark, d, "events"), C("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for i, part in enumerate([events.where(early), events.where(~early)]):
        t.merge_aggregate(op.bitmap_rollup(part, ["event_type"], "user_id"), {"bitmap": F.bitmap_or_agg}, "uv", i)
    return op.bitmap_ndv(t.read(), ["event_type"])


_LAST = "SELECT user_id, event_type, value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'"

_CUSTOMERS = """
        WITH ch AS (SELECT o_custkey AS k, 'order ' || o_orderkey AS name, CAST(o_totalprice AS DECIMAL(12,2)) AS bal, o_orderpriority AS seg, o_orderstatus,
                           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
        SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT k FROM ch)
        UNION ALL SELECT k, name, bal, seg FROM ch WHERE rn = 1 AND o_orderstatus <> 'P'"""

_DAILY = """
        SELECT event_type AS kind, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, max(value) AS top, count(DISTINCT user_id) AS users, count(DISTINCT event_id) AS events, true AS estimate_fits
        FROM events WHERE {where} GROUP BY ALL
        UNION ALL SELECT event_type, 'all', count(*), max(value), count(DISTINCT user_id), count(DISTINCT event_id), true FROM events WHERE {where} GROUP BY ALL"""

QUERIES = {
    "stream_apply": (stream_apply, _LAST),
    "stream_replay": (stream_replay, f"SELECT user_id, event_type, 1 AS version FROM ({_LAST})"),
    "stream_two_sources": (stream_two_sources, _LAST),
    "stream_bounded": (stream_bounded, f"SELECT *, 4 AS batches FROM ({_LAST})"),
    "stream_bounded_rows": (stream_bounded_rows, f"SELECT *, (SELECT ceil(count(*) / ceil(count(*) / 5.0))::INT FROM events) AS commits, true AS bounded FROM ({_LAST})"),
    "stream_at_least_once": (stream_at_least_once, f"SELECT *, 2 AS version FROM ({_LAST})"),
    "stream_route_order": (stream_route_order, "SELECT p_partkey AS id, CASE WHEN p_size > 45 THEN 'third ' ELSE 'second ' END || p_name AS name, p_size AS size FROM part"),
    "stream_route_partial": (stream_route_partial, "SELECT p_partkey AS id, p_name AS name, CASE WHEN p_size > 25 THEN p_size + 100 ELSE p_size END AS size FROM part"),
    "stream_route_arrays": (stream_route_arrays, "SELECT p_partkey AS id, p_name AS name, p_size AS size FROM part"),
    "custom_route": (custom_route, """
        WITH c AS (SELECT conv_id * 1000 + turn AS id, role, length(text) AS chars, (SELECT count(*) FROM conversations WHERE role NOT IN ('user', 'assistant') OR role IS NULL) AS skipped FROM conversations)
        SELECT 'turn' AS t, id, role, chars, skipped FROM c WHERE role IN ('user', 'assistant') UNION ALL SELECT 'asked', id, NULL, chars, skipped FROM c WHERE role = 'user'"""),
    "aggregate_load": (aggregate_load, "SELECT o_custkey AS custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DECIMAL(18,2) AS total, max(o_orderdate) AS last, min(o_orderkey) AS least FROM orders GROUP BY o_custkey"),
    "keyed_table_batches": (keyed_table_batches, _CUSTOMERS),
    "keyed_table_deltas": (keyed_table_deltas, _CUSTOMERS),
    "gated_load": (gated_load, encoding.QUERIES["quality_good"][1]),
    "rejects_table": (rejects_table, encoding.RAW_EVENTS + """
        SELECT event_id, CAST(level AS VARCHAR) AS level, nullif(concat_ws('; ', CASE WHEN long_kind THEN 'column value does not fit VARCHAR(6) of ''kind''' END,
               CASE WHEN high THEN 'column value does not fit TINYINT of ''level''' END, CASE WHEN no_owner THEN 'NULL value in non-nullable column ''owner''' END), '') AS reasons FROM q"""),
    "rejects_replay": (rejects_replay, encoding.RAW_EVENTS + """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN fine THEN kind ELSE kind[:6] END AS kind, CAST(CASE WHEN fine OR level > 200 THEN level ELSE least(level, 127) END AS VARCHAR) AS level,
               CAST(coalesce(owner, 0) AS VARCHAR) AS owner, NOT fine AND level > 200 AS open FROM (SELECT *, NOT (long_kind OR high OR no_owner) AS fine FROM q)"""),
    "stream_lookup": (stream_lookup, "SELECT o_custkey AS c_custkey, o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey"),
    "stream_lookup_cached": (stream_lookup_cached, """
        WITH o AS (SELECT o_orderkey, o_custkey AS k, o_orderkey % 3 AS b FROM orders), s AS (SELECT k, bool_or(b = 0) AS in0, bool_or(b = 1) AS in1 FROM o GROUP BY k)
        SELECT k AS c_custkey, o_orderkey, CASE WHEN c_custkey IS NOT NULL AND k % 11 <> 0 THEN CASE b WHEN 0 THEN 0 WHEN 1 THEN CASE WHEN in0 THEN 0 ELSE 1 END ELSE CASE WHEN in1 AND NOT in0 THEN 1 ELSE 2 END END END AS read_at
        FROM o JOIN s USING (k) LEFT JOIN customer ON k = c_custkey"""),
    "load_latencies": (load_latencies, """
        SELECT event_type AS query_id, count(*) AS batches, sum(user_id)::BIGINT AS rows, sum(event_id % 2)::BIGINT AS filtered, sum(user_id * 8)::BIGINT AS bytes, true AS p50_fits, true AS p95_fits FROM events GROUP BY event_type"""),
    "stream_route": (stream_route, "SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS INTEGER) AS size FROM supplier UNION ALL SELECT p_partkey, p_name, p_size FROM part WHERE p_size <> 13"),
    "aggregate_columns_load": (aggregate_columns_load, _DAILY.format(where="true")),
    "route_aggregate_columns": (route_aggregate_columns, _DAILY.format(where="event_id % 10 <> 0") + """
        UNION ALL SELECT 'column value does not fit BITMAP of ''users''', 'bad', count(*), NULL, NULL, NULL, NULL FROM events WHERE event_id % 10 = 0 HAVING count(*) > 0"""),
    "registry_evolve": (registry_evolve, "SELECT p_partkey, p_name, CASE WHEN p_size > 25 THEN p_size + 100 ELSE 7 END AS grade FROM part"),
    "registry_select": (registry_select, """
        WITH code AS (SELECT repeat('0', p_size % 3) || p_partkey AS code, p_name, p_partkey AS k FROM part)
        SELECT n_name, n_nationkey FROM nation WHERE n_regionkey >= 2 UNION ALL SELECT n_name, n_nationkey FROM nation WHERE n_nationkey IN (3, 5)
        UNION ALL SELECT p_name, k FROM code WHERE k IN (7, 8, 9) OR code IN ('10', '011', '0012')"""),
    "aggregate_table": (aggregate_table, "SELECT event_type, count(DISTINCT user_id) AS ndv FROM events GROUP BY event_type"),
}
