"""Change-log loads: events as a log keyed by user, orders as a log against customers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from .. import operators as op
from .reads import C, table

SEQ = ["ts", "event_id"]


def event_log(spark, d):
    """Events as change rows of a table keyed by user: ``error`` deletes, ``signup`` inserts, the rest update."""
    kind = F.when(C("event_type") == "error", "-D").when(C("event_type") == "signup", "+I").otherwise("+U")
    return table(spark, d, "events").select("user_id", "event_type", "value", "props", *SEQ, kind.alias("_kind"))


def customers(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name", C("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"), "c_mktsegment")


def order_log(spark, d):
    """Orders as change rows against customers; status P deletes the customer."""
    return table(spark, d, "orders").select(
        C("o_custkey").alias("c_custkey"), F.concat(F.lit("order "), "o_orderkey").alias("c_name"),
        C("o_totalprice").cast("decimal(12,2)").alias("c_acctbal"), C("o_orderpriority").alias("c_mktsegment"),
        "o_orderdate", "o_orderkey", F.when(C("o_orderstatus") == "P", "-D").otherwise("+U").alias("_kind"),
    )


ORDER_SEQ = ["o_orderdate", "o_orderkey"]


def upsert_delete(spark, d):
    return op.apply_changes(None, event_log(spark, d).withColumn("last_ts", C("ts")), ["user_id"], SEQ)


def upsert_delete_target(spark, d):
    return op.apply_changes(customers(spark, d), order_log(spark, d), ["c_custkey"], ORDER_SEQ)


def row_kinds(spark, d):
    kind = F.when(C("event_type") == "error", "-D").when(C("event_type") == "view", "-U").when(C("event_type") == "click", "+U").otherwise("+I")
    log = table(spark, d, "events").select("event_id", kind.alias("_kind"))
    return op.to_op(op.filter_kinds(log, has_pk=True, ignore_update_before=True)).select("event_id", "__op")


def row_kinds_no_key(spark, d):
    kind = F.when(C("event_type") == "error", "-D").when(C("event_type") == "view", "-U").when(C("event_type") == "click", "+U").otherwise("+I")
    log = table(spark, d, "events").select("event_id", kind.alias("_kind"))
    return op.to_op(op.filter_kinds(log, has_pk=False)).select("event_id", "__op")


def pk_change(spark, d, ignore=False):
    """Every order is created; orders of status F then move to the next key."""
    o = table(spark, d, "orders")
    image = lambda key, text: F.struct(key.alias("k"), F.concat(F.lit(text), C("o_orderkey")).alias("v"))
    none = F.lit(None).cast("struct<k: bigint, v: string>")
    made = o.select(F.lit("c").alias("op"), none.alias("before"), image(C("o_orderkey"), "made ").alias("after"), (C("o_orderkey") * 2).alias("seq"))
    moved = o.where("o_orderstatus = 'F'").select(
        F.lit("u").alias("op"), image(C("o_orderkey"), "made ").alias("before"), image(C("o_orderkey") + 1, "moved ").alias("after"),
        (C("o_orderkey") * 2 + 1).alias("seq"),
    )
    load = op.expand_updates(made.unionByName(moved), "before", "after", C("op"), ignore)
    return op.apply_changes(None, load.select("_row.k", "_row.v", "__op", "seq", "_sub"), ["k"], ["seq", "_sub"])


def pk_change_ignored(spark, d):
    return pk_change(spark, d, True)


def partial_update(spark, d):
    """Clicks supply ``value``, views supply ``props``, other events supply both."""
    log = table(spark, d, "events").select("user_id", "value", "props", "event_type", *SEQ)
    present = {"value": C("event_type") != "view", "props": C("event_type") != "click"}
    return op.apply_changes(None, log, ["user_id"], SEQ, mode="partial", columns=["value", "props"], present=present).select("user_id", "value", "props")


def partial_update_delete(spark, d):
    log = event_log(spark, d)
    present = {"value": C("event_type") != "view", "props": C("event_type") != "click"}
    return op.apply_changes(None, log, ["user_id"], SEQ, mode="partial", columns=["value", "props"], present=present).select("user_id", "value", "props")


def partial_update_target(spark, d):
    log = order_log(spark, d).drop("c_name", "c_acctbal")
    return op.apply_changes(customers(spark, d), log, ["c_custkey"], ORDER_SEQ, mode="partial", columns=["c_custkey", "c_mktsegment"])


def conditional_update(spark, d):
    log = event_log(spark, d).withColumn("id", C("event_id"))
    return op.apply_changes(None, log, ["user_id"], SEQ, columns=["value", "id"], merge_condition="value").select("user_id", "value", "id")


def conditional_update_target(spark, d):
    return op.apply_changes(customers(spark, d), order_log(spark, d), ["c_custkey"], ORDER_SEQ, merge_condition="c_acctbal")


def append_by_name(spark, d):
    base = table(spark, d, "customer").select(C("c_custkey").alias("id"), C("c_name").alias("name"), C("c_mktsegment").alias("segment"))
    extra = table(spark, d, "supplier").select(C("s_name").alias("NAME"), C("s_suppkey").alias("id"))
    return op.append(base, extra)


def unique_model(spark, d):
    return op.apply_changes(None, event_log(spark, d).withColumn("id", C("event_id")), ["user_id"], SEQ, columns=["id"], model="unique").select("user_id", "id")


def bitmap_uv(spark, d):
    roll = op.bitmap_rollup(table(spark, d, "events"), ["event_type"], "user_id")
    return op.bitmap_ndv(roll, ["event_type"], keys=["event_type"])


def bitmap_merged_rollup(spark, d):
    """Two loads into one aggregate table, then counted by a coarser key."""
    lines = table(spark, d, "lineitem", columns=["l_returnflag", "l_linestatus", "l_orderkey", "l_shipdate"])
    keys, early = ["l_returnflag", "l_linestatus"], C("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    both = op.bitmap_merge(op.bitmap_rollup(lines.where(early), keys, "l_orderkey"), op.bitmap_rollup(lines.where(~early), keys, "l_orderkey"), keys)
    return op.bitmap_ndv(both, ["l_returnflag"])


def bitmap_sparse_uv(spark, d):
    """Distinct ids that are scattered over 64 bits, and dense ones, merged from two loads: lists while few, bitmaps when dense."""
    e = table(spark, d, "events").select("event_type", F.col("user_id").cast("bigint").alias("dense"), (F.xxhash64("event_id").bitwiseAND((1 << 62) - 1)).alias("scattered"), (F.col("event_id") % 2).alias("load"))
    out = []
    for col in ("dense", "scattered"):
        loads = [op.mixed_rollup(e.where(F.col("load") == i), ["event_type"], col) for i in range(2)]
        merged = reduce(lambda a, b: op.mixed_merge(a, b, ["event_type"]), loads)
        out.append(op.mixed_ndv(merged, ["event_type"], ["event_type"]).select("event_type", F.lit(col).alias("ids"), "ndv"))
    return out[0].union(out[1])


def hll_uv(spark, d):
    roll = op.hll_rollup(table(spark, d, "events"), ["event_type", "user_id"], "event_id")
    return op.hll_ndv(roll, ["event_type"])


def column_mapping(spark, d):
    fields = table(spark, d, "part", columns=["p_partkey", "p_name", "p_size"])
    return op.map_columns(fields, "`id`, name, size, label = concat(name, ',', size), double_size = size * 2")


def mapped_bitmap(spark, d):
    mapping = "event_type, day, uid, users=to_bitmap(uid)"
    visits = op.map_columns(table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"), "user_id"), mapping)
    (name, (_, _field)), = op.sketch_columns(mapping).items()
    return op.bitmap_ndv(op.bitmap_rollup(visits, ["event_type", "day"], name), ["event_type", "day"])


_ORDERS_CTE = """
WITH ch AS (
  SELECT o_custkey AS k, 'order ' || o_orderkey AS name, CAST(o_totalprice AS DECIMAL(12,2)) AS bal, o_orderpriority AS seg,
         o_orderstatus = 'P' AS del, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n
  FROM orders),
ld AS (SELECT k, max(CASE WHEN del THEN n END) AS last_del, max(n) AS last_n FROM ch GROUP BY k)
"""

_EVENTS_CTE = """
WITH ch AS (
  SELECT user_id, event_id, event_type, value, props, ts, event_type = 'error' AS del,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
  FROM events),
ld AS (SELECT user_id, max(CASE WHEN del THEN n ELSE 0 END) AS last_del, max(n) AS last_n FROM ch GROUP BY user_id)
"""

_PARTIAL = """
SELECT l.user_id,
       (SELECT c.value FROM ch c WHERE c.user_id = l.user_id AND c.n = v.vn) AS value,
       (SELECT c.props FROM ch c WHERE c.user_id = l.user_id AND c.n = v.pn) AS props
FROM ld l JOIN (
  SELECT ch.user_id, max(CASE WHEN event_type <> 'view' THEN n END) AS vn, max(CASE WHEN event_type <> 'click' THEN n END) AS pn
  FROM ch JOIN ld ON ch.user_id = ld.user_id AND ch.n > ld.last_del GROUP BY ch.user_id) v ON v.user_id = l.user_id
"""

def hll_close(spark, d):
    """Whether each estimate is within 5 % of the exact count."""
    exact = table(spark, d, "events").groupBy("event_type").agg(F.count_distinct("event_id").alias("exact"))
    near = F.abs(C("ndv") - C("exact")) <= F.greatest(F.lit(2.0), C("exact") * 0.05)
    return hll_uv(spark, d).join(exact, "event_type").select("event_type", near.alias("close"))


QUERIES = {
    "hll_close": (hll_close, "SELECT DISTINCT event_type, true AS close FROM events"),
    "upsert_delete": (upsert_delete, "SELECT user_id, event_type, value, props, last_ts FROM (SELECT user_id, event_type, value, props, ts AS last_ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'"),
    "upsert_delete_target": (upsert_delete_target, _ORDERS_CTE + """
        SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT k FROM ld)
        UNION ALL SELECT ch.k, name, bal, seg FROM ch JOIN ld ON ch.k = ld.k AND n = last_n WHERE NOT del"""),
    "row_kinds": (row_kinds, "SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS __op FROM events WHERE event_type <> 'view'"),
    "row_kinds_no_key": (row_kinds_no_key, "SELECT event_id, 0 AS __op FROM events WHERE event_type NOT IN ('view', 'error')"),
    "pk_change": (pk_change, """
        WITH i AS (
          SELECT o_orderkey AS k, 'made ' || o_orderkey AS v, 0 AS op, o_orderkey * 2 AS seq, 1 AS sub FROM orders
          UNION ALL SELECT o_orderkey, 'made ' || o_orderkey, 1, o_orderkey * 2 + 1, 0 FROM orders WHERE o_orderstatus = 'F'
          UNION ALL SELECT o_orderkey + 1, 'moved ' || o_orderkey, 0, o_orderkey * 2 + 1, 1 FROM orders WHERE o_orderstatus = 'F')
        SELECT k, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC, sub DESC) AS rn FROM i) WHERE rn = 1 AND op = 0"""),
    "pk_change_ignored": (pk_change_ignored, """
        WITH i AS (
          SELECT o_orderkey AS k, 'made ' || o_orderkey AS v, o_orderkey * 2 AS seq FROM orders
          UNION ALL SELECT o_orderkey + 1, 'moved ' || o_orderkey, o_orderkey * 2 + 1 FROM orders WHERE o_orderstatus = 'F')
        SELECT k, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS rn FROM i) WHERE rn = 1"""),
    "partial_update": (partial_update, _EVENTS_CTE.replace("event_type = 'error' AS del", "false AS del") + _PARTIAL),
    "partial_update_delete": (partial_update_delete, _EVENTS_CTE + _PARTIAL),
    "partial_update_target": (partial_update_target, _ORDERS_CTE + """
        SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT k FROM ld)
        UNION ALL SELECT ch.k, CASE WHEN last_del IS NULL THEN c_name END, CASE WHEN last_del IS NULL THEN CAST(c_acctbal AS DECIMAL(12,2)) END, seg
        FROM ch JOIN ld ON ch.k = ld.k AND n = last_n LEFT JOIN customer ON c_custkey = ch.k WHERE NOT del"""),
    "conditional_update": (conditional_update, """
        WITH e AS (SELECT *, count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING) AS deletes_after FROM events)
        SELECT user_id, value, event_id AS id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, ts DESC, event_id DESC) AS rn FROM e WHERE deletes_after = 0) WHERE rn = 1"""),
    "conditional_update_target": (conditional_update_target, _ORDERS_CTE + """
        , best AS (
          SELECT * FROM (SELECT ch.*, row_number() OVER (PARTITION BY ch.k ORDER BY bal DESC, n DESC) AS rn FROM ch JOIN ld ON ch.k = ld.k
                         WHERE last_del IS NULL OR n > last_del) WHERE rn = 1)
        SELECT coalesce(c.c_custkey, b.k) AS c_custkey,
               CASE WHEN keep THEN c.c_name ELSE b.name END AS c_name,
               CASE WHEN keep THEN c.bal ELSE b.bal END AS c_acctbal,
               CASE WHEN keep THEN c.c_mktsegment ELSE b.seg END AS c_mktsegment
        FROM (SELECT c.c_custkey, c.c_name, CAST(c.c_acctbal AS DECIMAL(12,2)) AS bal, c.c_mktsegment FROM customer c LEFT JOIN ld ON ld.k = c.c_custkey WHERE last_del IS NULL) c
        FULL JOIN best b ON b.k = c.c_custkey
        CROSS JOIN LATERAL (SELECT b.k IS NULL OR (c.c_custkey IS NOT NULL AND c.bal > b.bal) AS keep)"""),
    "append_by_name": (append_by_name, "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier"),
    "unique_model": (unique_model, "SELECT user_id, event_id AS id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type <> 'error') WHERE rn = 1"),
    "bitmap_uv": (bitmap_uv, "SELECT event_type, count(DISTINCT user_id) AS ndv FROM events GROUP BY event_type"),
    "bitmap_merged_rollup": (bitmap_merged_rollup, "SELECT l_returnflag, count(DISTINCT l_orderkey) AS ndv FROM lineitem GROUP BY l_returnflag"),
    "bitmap_sparse_uv": (bitmap_sparse_uv, """
        SELECT event_type, 'dense' AS ids, count(DISTINCT user_id) AS ndv FROM events GROUP BY event_type
        UNION ALL SELECT event_type, 'scattered', count(DISTINCT event_id) FROM events GROUP BY event_type"""),
    "hll_uv": (hll_uv, None),
    "column_mapping": (column_mapping, "SELECT p_partkey AS id, p_name AS name, p_size AS size, p_name || ',' || p_size AS label, p_size * 2 AS double_size FROM part"),
    "mapped_bitmap": (mapped_bitmap, "SELECT event_type, CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS ndv FROM events GROUP BY event_type, CAST(ts AS DATE)"),
}
