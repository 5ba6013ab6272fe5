"""Debezium change feeds built from the tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from .. import cdc, operators as op
from ..session import work_dir
from ..spec import ColumnSpec, TableSpec
from ..store import Registry
from .reads import C, table

ORDER_SPEC = TableSpec(
    "ods", "orders",
    (ColumnSpec("o_orderkey", "BIGINT", False), ColumnSpec("o_custkey", "BIGINT"), ColumnSpec("o_totalprice", "DECIMAL(12,2)"), ColumnSpec("o_orderpriority", "VARCHAR(60)")),
    keys=("o_orderkey",), buckets=8,
)
SUPPLIER_SPEC = TableSpec(
    "ods", "supplier", (ColumnSpec("s_suppkey", "BIGINT", False), ColumnSpec("s_name", "STRING"), ColumnSpec("s_nationkey", "INT")), keys=("s_suppkey",), buckets=4,
)


def envelope(df, name, op_letter, before, after, ts_ms):
    """Change events as JSON text."""
    source = F.struct(F.lit("shop").alias("db"), F.lit(name).alias("table"), ts_ms.alias("ts_ms"), F.lit("binlog.1").alias("file"), ts_ms.alias("pos"))
    return df.select(F.to_json(F.struct(op_letter.alias("op"), before.alias("before"), after.alias("after"), source.alias("source"), ts_ms.alias("ts_ms"))).alias("value"))


def order_events(spark, d):
    """Orders are read in the snapshot; F orders are updated (priority), P orders deleted."""
    o = table(spark, d, "orders").withColumn("price", C("o_totalprice").cast("decimal(12,2)"))
    image = lambda priority: F.struct("o_orderkey", "o_custkey", C("price").alias("o_totalprice"), priority.alias("o_orderpriority"))
    old, new = image(C("o_orderpriority")), image(F.concat(F.lit("late "), "o_orderpriority"))
    none = F.lit(None).cast("string")
    made = envelope(o, "orders", F.lit("r"), none, old, C("o_orderkey") * 2)
    late = envelope(o.where("o_orderstatus = 'F'"), "orders", F.lit("u"), old, new, C("o_orderkey") * 2 + 1)
    gone = envelope(o.where("o_orderstatus = 'P'"), "orders", F.lit("d"), old, none, C("o_orderkey") * 2 + 1)
    return made.union(late).union(gone)


def debezium_parse(spark, d):
    events = cdc.parse_debezium(order_events(spark, d))
    number = lambda image: F.try_variant_get(image, "$.o_totalprice", "string")
    return events.select("op", "src_db", "src_table", C("_src_ts").alias("ts_ms"), F.coalesce(number("after"), number("before")).cast("decimal(12,2)").alias("price"))


def debezium_changes(spark, d):
    changes = cdc.debezium_to_changes(cdc.parse_debezium(order_events(spark, d)), ORDER_SPEC, keep=["_src_ts"])
    return changes.select(C("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderpriority", "__op", C("_src_ts").alias("ts_ms"))


def debezium_apply(spark, d):
    changes = cdc.debezium_to_changes(cdc.parse_debezium(order_events(spark, d)), ORDER_SPEC, keep=["_src_ts"])
    typed, _ = op.split_valid(changes, ORDER_SPEC)
    return op.apply_changes(None, typed, ["o_orderkey"], ["_src_ts", "_sub"], columns=ORDER_SPEC.values)


def ddl_statements(spark, d):
    """One DDL event per part: additions of several types, removals, an index, and statements of another kind."""
    p = table(spark, d, "part")
    name = F.concat(F.lit("ALTER TABLE shop.t"), C("p_partkey").cast("string"))
    ddl = (
        F.when(C("p_type") == "SMALL", F.concat(name, F.lit(" ADD COLUMN `c"), "p_size", F.lit("` VARCHAR("), "p_size", F.lit(") NOT NULL")))
        .when(C("p_type") == "ECONOMY", F.concat(name, F.lit(" drop c"), "p_size"))
        .when(C("p_size") > 30, F.concat(name, F.lit(" ADD INDEX i"), "p_size", F.lit(" (c1)")))
        .when(C("p_size") > 20, F.concat(name, F.lit(" RENAME TO x")))
        .when(C("p_size") > 15, F.concat(name, F.lit(" ADD COLUMN a VARCHAR(5) DEFAULT '--' COMMENT 'x, add c int', ADD COLUMN `b,"), "p_size", F.lit("` INT DEFAULT (f(1, 2)) -- the last, add d int\n")))
        .when(C("p_size") > 10, F.concat(name, F.lit(" /* a, b */ ADD COLUMN (`n "), "p_size", F.lit("` INT UNSIGNED, e ENUM('x','y'))")))
        .otherwise(F.concat(name, F.lit(" add c"), "p_size", F.lit(" DECIMAL(10,2), ADD COLUMN more INT FIRST, DROP old, RENAME COLUMN a TO b")))
    )
    record = F.to_json(F.struct(ddl.alias("ddl")))
    source = F.struct(F.lit("shop").alias("db"), F.concat(F.lit("t"), "p_partkey").alias("table"), C("p_partkey").alias("ts_ms"))
    return p.select(F.to_json(F.struct(source.alias("source"), record.alias("historyRecord"))).alias("value"))


def ddl_actions(spark, d):
    events = cdc.parse_debezium(ddl_statements(spark, d))
    return cdc.ddl_to_actions(cdc.parse_ddl(events)).select("src_table", "clause_no", "action", "column", "type")


_TYPES = ["TINYINT UNSIGNED", "BIGINT UNSIGNED", "DECIMAL", "VARCHAR", "CHAR", "DATETIME", "JSON", "mediumint"]


def source_metadata(spark, d):
    """Column metadata rows of a source with one table per part name and size."""
    p = table(spark, d, "part")
    kind = F.element_at(F.array(*[F.lit(t) for t in _TYPES]), (C("p_partkey") % len(_TYPES)).cast("int") + 1)
    return p.select(
        F.lit("shop").alias("table_schema"), F.concat("p_brand", F.lit("."), "p_type").alias("table_name"), F.concat(F.lit("c"), "p_partkey").alias("column_name"),
        C("p_partkey").cast("int").alias("ordinal_position"), kind.alias("type_name"), C("p_size").alias("column_size"), F.lit(2).alias("decimal_digits"),
        F.lit(1).alias("nullable"), C("p_name").alias("remarks"),
    )


def source_type_map(spark, d):
    return cdc.map_source_columns(source_metadata(spark, d)).select("table_name", "column_name", "type")


def table_select(spark, d):
    """Tables by regular expressions on the whole name; a table needs a key column (named here by size 1)."""
    columns = source_metadata(spark, d)
    keys = columns.where("column_size = 1").select("table_schema", "table_name", "column_name")
    names = columns.select("table_name").distinct()
    chosen = cdc.select_tables(names, include=r"Brand#1.*", exclude=r".*\.SMALL", keys=keys)
    return chosen.select("table_name", cdc.target_name(C("table_name"), "ods_", "_s").alias("target"))


def _synced(spark, d, lines, specs, **options):
    """Feed the text through a stream into a new registry and return the registry."""
    root = work_dir(spark, "feed")
    lines.write.text(f"{root}/in")
    registry = Registry(spark, f"{root}/tables")
    stream = spark.readStream.schema("value string").text(f"{root}/in")
    cdc.sync_database(stream, registry, specs, f"{root}/checkpoint", **options).awaitTermination()
    return registry


def sync_database(spark, d):
    """Two source tables through one stream into two keyed tables."""
    s = table(spark, d, "supplier", columns=["s_suppkey", "s_name", "s_nationkey"])
    none = F.lit(None).cast("string")
    suppliers = envelope(s, "supplier", F.lit("c"), none, F.struct(*s.columns), C("s_suppkey"))
    specs = {("shop", "orders"): ORDER_SPEC, ("shop", "supplier"): SUPPLIER_SPEC}
    registry = _synced(spark, d, order_events(spark, d).union(suppliers), specs)
    orders, supplier = registry.read("ods", "orders"), registry.read("ods", "supplier")
    return orders.select(F.lit("orders").alias("t"), C("o_orderkey").alias("id"), C("o_orderpriority").alias("text")).union(
        supplier.select(F.lit("supplier"), "s_suppkey", "s_name")
    )


def sync_temporals(spark, d):
    """Dates and times of orders in the encodings of a change feed: days, milli- and microseconds, text with a zone."""
    day = F.date_trunc("day", C("o_orderdate")).cast("timestamp_ntz")
    micros = F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400000000
    image = F.struct(
        "o_orderkey", F.unix_date(F.to_date("o_orderdate")).alias("day"), (F.expr("unix_date(to_date(o_orderdate))").cast("bigint") * 86400000 + C("o_orderkey")).alias("at"),
        (micros + C("o_orderkey")).alias("fine"), F.concat(F.to_date(day).cast("string"), F.lit("T00:00:00Z")).alias("seen"))
    spec = TableSpec("ods", "dated", (ColumnSpec("o_orderkey", "BIGINT", False), ColumnSpec("day", "DATE"), ColumnSpec("at", "DATETIME"), ColumnSpec("fine", "DATETIME"), ColumnSpec("seen", "DATETIME")),
                     keys=("o_orderkey",), buckets=8, options={"temporals": {"day": "date", "at": "datetime_ms", "fine": "datetime", "seen": "timestamp"}})
    made = envelope(table(spark, d, "orders"), "dated", F.lit("c"), F.lit(None).cast("string"), image, C("o_orderkey"))
    return _synced(spark, d, made, {("shop", "dated"): spec}).read("ods", "dated")


def _logged(df, op_letter, before, after, at):
    """Change events of orders with their position beside them, as a feed kept in files has it: log files of 10,000 places."""
    file, pos = F.concat(F.lit("binlog."), F.lpad(F.floor(at / 10000).cast("string"), 6, "0")), (at % 10000).cast("bigint")
    source = F.struct(F.lit("shop").alias("db"), F.lit("orders").alias("table"), at.alias("ts_ms"), file.alias("file"), pos.alias("pos"))
    value = F.to_json(F.struct(op_letter.alias("op"), before.alias("before"), after.alias("after"), source.alias("source"), at.alias("ts_ms")))
    return df.select(value.alias("value"), at.alias("ts_ms"), file.alias("file"))


def _order_images():
    image = lambda priority: F.struct("o_orderkey", "o_custkey", C("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"), priority.alias("o_orderpriority"))
    return image(C("o_orderpriority")), image(F.concat(F.lit("late "), "o_orderpriority"))


def _shop_log(spark, d):
    """The log of a shop, position = 2 x key + 1: F orders get their priority late, P orders are deleted."""
    o, (old, new), none, at = table(spark, d, "orders"), _order_images(), F.lit(None).cast("string"), C("o_orderkey").cast("bigint") * 2 + 1
    return _logged(o.where("o_orderstatus = 'F'"), F.lit("u"), old, new, at).union(_logged(o.where("o_orderstatus = 'P'"), F.lit("d"), old, none, at))


def sync_snapshot_then_log(spark, d):
    """A snapshot read while the log goes on: rows of some customers were read before the changes of the window, others after; then the log."""
    o = table(spark, d, "orders")
    top = o.agg(F.max("o_orderkey")).first()[0] * 2 + 1
    low, high = cdc.Position(ts_ms=top // 3), cdc.Position(ts_ms=2 * top // 3)
    at = C("o_orderkey") * 2 + 1
    seen = (at <= top // 3) | ((at <= 2 * top // 3) & (C("o_custkey") % 2 == 0))
    rows = o.where(~(seen & (C("o_orderstatus") == "P"))).select(
        "o_orderkey", "o_custkey", C("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
        F.when(seen & (C("o_orderstatus") == "F"), F.concat(F.lit("late "), "o_orderpriority")).otherwise(C("o_orderpriority")).alias("o_orderpriority"))
    root, specs = work_dir(spark, "feed"), {("shop", "orders"): ORDER_SPEC}
    _shop_log(spark, d).write.parquet(f"{root}/in")
    registry, log = Registry(spark, f"{root}/tables"), spark.read.parquet(f"{root}/in")
    for _ in range(2):  # run again, the snapshot is not loaded again
        cdc.load_snapshot(registry, specs, {("shop", "orders"): rows}, log, low, high)
    read = lambda: registry.read("ods", "orders").select("o_orderkey", "o_orderpriority")
    at_high = read()
    middle = work_dir(spark, "at-high")
    at_high.write.parquet(middle)
    stream = spark.readStream.schema(log.schema).parquet(f"{root}/in")
    cdc.sync_database(stream, registry, specs, f"{root}/checkpoint", start=replace(high, after=True)).awaitTermination()
    return spark.read.parquet(middle).select(F.lit("high").alias("t"), "o_orderkey", "o_orderpriority").union(read().select(F.lit("end"), "*"))


def log_files(rows: int) -> int:
    """Files of a log, at least four; their number follows the rows, so no task's share does."""
    return max(4, rows // 200_000)


def sync_from_position(spark, d):
    """The log alone, from a time on and from a file and place on: earlier files are skipped, earlier events of the same file too."""
    last, rows = table(spark, d, "orders").agg(F.max("o_orderkey"), F.count("*")).first()
    root, place, out, running = work_dir(spark, "feed"), (last * 2 + 1) // 2, [], []
    _shop_log(spark, d).repartitionByRange(log_files(rows), "ts_ms").write.parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    for start in ({"ts_ms": place}, {"file": f"binlog.{place // 10000:06d}", "pos": place % 10000}):
        name = next(iter(start))
        registry = Registry(spark, f"{root}/{name}")
        running.append((name, registry, cdc.sync_database(spark.readStream.schema(schema).parquet(f"{root}/in"), registry, {("shop", "orders"): ORDER_SPEC}, f"{root}/checkpoint-{name}", start=start)))
    for name, registry, sync in running:
        sync.awaitTermination()
        out.append(registry.read("ods", "orders").select(F.lit(name).alias("start"), "o_orderkey", "o_orderpriority"))
    return out[0].union(out[1])


def infer_specs(spark, d):
    """Columns of all source tables with a key, one row each."""
    columns = source_metadata(spark, d).withColumn("decimal_digits", F.lit(2))
    keys = columns.where("column_size = 1").select("table_schema", "table_name", "column_name", C("ordinal_position").alias("key_seq"))
    return cdc.spec_rows(columns, keys).select("table_name", "column_name", F.when(C("key_seq").isNotNull(), 1).otherwise(0).alias("is_key"))


def sync_schema_change(spark, d):
    """A column is dropped and another added between the snapshot and the updates of one batch."""
    ddl = lambda text, at: F.to_json(F.struct(
        F.struct(F.lit("shop").alias("db"), F.lit("orders").alias("table"), F.lit(at).alias("ts_ms")).alias("source"),
        F.to_json(F.struct(F.lit(text).alias("ddl"))).alias("historyRecord"),
    ))
    o = table(spark, d, "orders")
    none = F.lit(None).cast("string")
    before = envelope(o, "orders", F.lit("r"), none, F.struct("o_orderkey", "o_custkey", "o_orderpriority"), F.lit(1))
    after = envelope(
        o.where("o_orderstatus = 'F'"), "orders", F.lit("u"), none,
        F.struct("o_orderkey", "o_custkey", F.concat(F.lit("st "), "o_orderstatus").alias("state")), F.lit(5),
    )
    changes = o.groupBy().agg(F.min("o_orderkey")).select(F.explode(F.array(
        ddl("ALTER TABLE orders DROP COLUMN o_orderpriority", 2), ddl("ALTER TABLE orders ADD COLUMN state VARCHAR(10)", 3))).alias("value"))
    registry = _synced(spark, d, before.union(changes).union(after), {("shop", "orders"): ORDER_SPEC}, schema_evolution=True)
    return registry.read("ods", "orders").drop("o_totalprice")


_P = "CAST(o_totalprice AS DECIMAL(12,2))"
_FINAL = "CASE WHEN o_orderstatus = 'F' THEN 'late ' || o_orderpriority ELSE o_orderpriority END"

QUERIES = {
    "debezium_parse": (debezium_parse, f"""
        SELECT 'r' AS op, 'shop' AS src_db, 'orders' AS src_table, o_orderkey * 2 AS ts_ms, {_P} AS price FROM orders
        UNION ALL SELECT CASE o_orderstatus WHEN 'F' THEN 'u' ELSE 'd' END, 'shop', 'orders', o_orderkey * 2 + 1, {_P} FROM orders WHERE o_orderstatus IN ('F', 'P')"""),
    "debezium_changes": (debezium_changes, """
        SELECT o_orderkey, o_orderpriority, 0 AS __op, o_orderkey * 2 AS ts_ms FROM orders
        UNION ALL SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'late ' ELSE '' END || o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END, o_orderkey * 2 + 1 FROM orders WHERE o_orderstatus IN ('F', 'P')"""),
    "debezium_apply": (debezium_apply, f"SELECT o_orderkey, o_custkey, {_P} AS o_totalprice, {_FINAL} AS o_orderpriority FROM orders WHERE o_orderstatus <> 'P'"),
    "ddl_actions": (ddl_actions, """
        WITH p AS (SELECT 't' || p_partkey AS src_table, p_size AS s, p_type AS t FROM part),
        few AS (SELECT src_table, s FROM p WHERE t NOT IN ('SMALL', 'ECONOMY') AND s <= 10), listed AS (SELECT src_table, s FROM p WHERE t NOT IN ('SMALL', 'ECONOMY') AND s BETWEEN 11 AND 15),
        quoted AS (SELECT src_table, s FROM p WHERE t NOT IN ('SMALL', 'ECONOMY') AND s BETWEEN 16 AND 20)
        SELECT src_table, 0 AS clause_no, 'add' AS action, 'c' || s AS "column", 'varchar(' || least(s * 3, 65533) || ')' AS type FROM p WHERE t = 'SMALL'
        UNION ALL SELECT src_table, 0, 'drop', 'c' || s, NULL FROM p WHERE t = 'ECONOMY'
        UNION ALL SELECT src_table, 0, 'add', 'c' || s, 'DECIMAL(10,2)' FROM few UNION ALL SELECT src_table, 1, 'add', 'more', 'INT' FROM few UNION ALL SELECT src_table, 2, 'drop', 'old', NULL FROM few
        UNION ALL SELECT src_table, 0, 'add', 'a', 'varchar(15)' FROM quoted UNION ALL SELECT src_table, 1, 'add', 'b,' || s, 'INT' FROM quoted
        UNION ALL SELECT src_table, 0, 'add', 'n ' || s, 'INT UNSIGNED' FROM listed UNION ALL SELECT src_table, 1, 'add', 'e', 'ENUM(''x'',''y'')' FROM listed"""),
    "sync_temporals": (sync_temporals, """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, date_trunc('day', o_orderdate) + to_milliseconds(o_orderkey) AS at, date_trunc('day', o_orderdate) + to_microseconds(o_orderkey) AS fine,
               date_trunc('day', o_orderdate) + INTERVAL 8 HOUR AS seen FROM orders"""),
    "sync_snapshot_then_log": (sync_snapshot_then_log, f"""
        WITH top AS (SELECT max(o_orderkey) * 2 + 1 AS t FROM orders), h AS (SELECT *, o_orderkey * 2 + 1 <= 2 * t // 3 AS seen FROM orders, top)
        SELECT 'high' AS t, o_orderkey, CASE WHEN o_orderstatus = 'F' AND seen THEN 'late ' || o_orderpriority ELSE o_orderpriority END AS o_orderpriority FROM h WHERE NOT (o_orderstatus = 'P' AND seen)
        UNION ALL SELECT 'end', o_orderkey, {_FINAL} FROM orders WHERE o_orderstatus <> 'P'"""),
    "sync_from_position": (sync_from_position, """
        SELECT s AS start, o_orderkey, 'late ' || o_orderpriority AS o_orderpriority FROM orders, (SELECT (max(o_orderkey) * 2 + 1) // 2 AS m FROM orders), (VALUES ('ts_ms'), ('file')) v(s)
        WHERE o_orderstatus = 'F' AND o_orderkey * 2 + 1 >= m"""),
    "infer_specs": (infer_specs, """
        SELECT p_brand || '.' || p_type AS table_name, 'c' || p_partkey AS column_name, (p_size = 1)::INT AS is_key FROM part
        WHERE p_brand || '.' || p_type IN (SELECT p_brand || '.' || p_type FROM part WHERE p_size = 1)"""),
    "source_type_map": (source_type_map, """
        SELECT p_brand || '.' || p_type AS table_name, 'c' || p_partkey AS column_name,
               CASE p_partkey % 8 WHEN 0 THEN 'SMALLINT' WHEN 1 THEN 'LARGEINT' WHEN 2 THEN CASE WHEN p_size <= 38 THEN 'DECIMAL(' || p_size || ',2)' ELSE 'STRING' END
                    WHEN 3 THEN 'VARCHAR(' || p_size * 3 || ')' WHEN 4 THEN 'CHAR(' || p_size || ')' WHEN 5 THEN 'DATETIME' WHEN 6 THEN 'JSON' ELSE 'INT' END AS type FROM part"""),
    "table_select": (table_select, r"""
        SELECT DISTINCT n AS table_name, 'ods_' || n || '_s' AS target FROM (SELECT p_brand || '.' || p_type AS n, p_size FROM part) t
        WHERE n LIKE 'Brand#1%' AND n NOT LIKE '%.SMALL' AND n IN (SELECT p_brand || '.' || p_type FROM part WHERE p_size = 1)"""),
    "sync_database": (sync_database, f"SELECT 'orders' AS t, o_orderkey AS id, {_FINAL} AS text FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier"),
    "sync_schema_change": (sync_schema_change, "SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'st F' END AS state FROM orders"),
}
