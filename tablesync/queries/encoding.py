"""Row encoding and decoding, record functions, load checks, reject messages."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from .. import functions as fn, operators as op, sources as src
from ..session import work_dir
from ..spec import ColumnSpec, TableSpec
from .reads import C, table


def encode_json(spark, d):
    return fn.encode_json(table(spark, d, "part", columns=["p_partkey", "p_name", "p_size"]), out="row")


def encode_json_nulls(spark, d):
    """Null fields are left out; the operation column is added for keyed tables."""
    df = table(spark, d, "orders").select(
        "o_orderkey", F.when(C("o_orderstatus") != "P", C("o_orderstatus")).alias("o_orderstatus"),
        F.to_date("o_orderdate").alias("day"), F.when(C("o_orderstatus") == "F", 1).otherwise(0).alias("__op"),
    )
    return fn.encode_json(df, with_op=True, out="row")


def encode_csv(spark, d):
    df = table(spark, d, "orders").select(
        "o_orderkey", (C("o_orderstatus") == "F").alias("done"), F.to_date("o_orderdate").alias("day"),
        F.when(C("o_orderstatus") != "P", C("o_orderpriority")).alias("priority"), C("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.array("o_orderkey", "o_custkey").alias("ids"),
    )
    return fn.encode_csv(df, "\\x01", out="row", fail_on_separator=True)


def normalized_rows(spark, d):
    df = table(spark, d, "events").select(
        "event_id", (C("value") > 50).alias("big"), "ts", F.to_date("ts").alias("day"), C("value").cast("decimal(10,2)").alias("value"),
        F.unhex(F.lpad(F.hex("user_id"), 8, "0")).alias("code"),
    )
    return fn.normalize_for_load(df)


def json_promotion(spark, d):
    """``props`` bound for a JSON column becomes a document, plain text bound for one becomes a JSON string."""
    spec = TableSpec("d", "t", (ColumnSpec("event_id", "BIGINT", False), ColumnSpec("props", "JSON"), ColumnSpec("kind", "JSON")), keys=("event_id",))
    df = table(spark, d, "events").select("event_id", "props", C("event_type").alias("kind"))
    return fn.encode_json(df, spec, out="row")


def nested_to_load(spark, d):
    o = table(spark, d, "orders")
    day = F.to_date("o_orderdate")
    df = o.select(
        "o_orderkey", F.struct(C("o_custkey").alias("c"), day.alias("d")).alias("as_text"),
        F.array(F.struct(C("o_custkey").alias("c"), day.alias("d"))).alias("rows"), F.array(F.array(day)).alias("days"),
        F.create_map("o_custkey", day).alias("by_customer"),
    )
    spec = TableSpec("d", "t", (
        ColumnSpec("o_orderkey", "BIGINT", False), ColumnSpec("as_text", "STRING"), ColumnSpec("rows", "ARRAY<STRING>"),
        ColumnSpec("days", "ARRAY<ARRAY<STRING>>"), ColumnSpec("by_customer", "MAP<STRING,STRING>")), keys=("o_orderkey",))
    loaded = fn.nested_to_load(df, spec)
    return loaded.select(
        "o_orderkey", "as_text", C("rows")[0].alias("row"), C("days")[0][0].alias("day"),
        F.element_at(F.map_keys("by_customer"), 1).alias("customer"), F.element_at(F.map_values("by_customer"), 1).alias("customer_day"),
    )


NATION = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()), T.StructField("n_regionkey", T.IntegerType())])
ORDERS = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()), T.StructField("price", T.DecimalType(12, 2)),
])
_ORDERS_SQL = "SELECT o_orderkey, o_orderdate, o_orderpriority, CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders"


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", C("o_totalprice").cast("decimal(12,2)").alias("price"))


def decode_csv(spark, d):
    return src.decode(fn.encode_csv(_orders(spark, d)), ORDERS, "csv")


def decode_json(spark, d):
    return src.decode(fn.encode_json(_orders(spark, d)), ORDERS, "json")


def decode_json_arrays(spark, d):
    """Payloads that are arrays of rows, stripped on load."""
    rows = fn.encode_json(_orders(spark, d))
    payloads = src.frame_chunks(rows, "json", max_bytes=64 << 10).select(C("payload").alias("value"))
    return src.decode(payloads, ORDERS, "json", {"strip_outer_array": "true"})


def decode_mapped_csv(spark, d):
    text = fn.encode_csv(table(spark, d, "nation"), "|")
    schema = T.StructType([*NATION.fields, T.StructField("label", T.StringType())])
    return src.decode(text, schema, "csv", {"column_separator": "|", "columns": "n_nationkey,n_name,n_regionkey,label=upper(concat(n_name,'/',n_regionkey))"})


def text_files(spark, d):
    """Compressed text files with a custom row delimiter, written and read back."""
    path = work_dir(spark, "text")
    src.write_text(fn.encode_csv(_orders(spark, d), "\\x01"), path, "csv", row_delimiter="\x02", compression="lz4")
    return src.decode(spark.read.option("lineSep", "\x02").text(path), ORDERS, "csv", {"column_separator": "\\x01"})


def framed_payloads(spark, d):
    rows = fn.encode_csv(table(spark, d, "lineitem", columns=["l_orderkey", "l_linenumber"]), ",")
    framed = src.frame_chunks(rows, "csv", row_delimiter=";", max_bytes=1 << 20)
    return framed.agg(F.sum("n_rows").alias("n_rows"), F.sum(F.length("payload")).alias("chars"))


def custom_records(spark, d):
    def build(batches):
        for b in batches:
            b["words"] = b["text"].str.split().str.len()
            yield b[["conv_id", "turn", "words"]]

    return src.map_records(table(spark, d, "conversations", columns=["conv_id", "turn", "text"]), build, "conv_id bigint, turn bigint, words bigint")


EVENT_SPEC = TableSpec(
    "d", "t",
    (ColumnSpec("event_id", "BIGINT", False), ColumnSpec("kind", "VARCHAR(6)"), ColumnSpec("level", "TINYINT"), ColumnSpec("owner", "BIGINT", False)),
    model="duplicate",
)


def raw_events(spark, d):
    return table(spark, d, "events").select(
        C("event_id").cast("string").alias("event_id"), C("event_type").alias("kind"), F.floor("value").cast("string").alias("level"),
        F.when(C("event_type") != "view", C("user_id").cast("string")).alias("owner"),
    )


def quality_good(spark, d):
    return op.split_valid(raw_events(spark, d), EVENT_SPEC)[0]


def quality_bad(spark, d):
    bad = op.split_valid(raw_events(spark, d), EVENT_SPEC)[1]
    return bad.select("event_id", C("_reasons").alias("reasons"))


def quality_lenient(spark, d):
    return op.split_valid(raw_events(spark, d), EVENT_SPEC, strict=False)[0]


def load_report(spark, d):
    return op.load_report(raw_events(spark, d), EVENT_SPEC, C("kind") != "click")


def redacted_messages(spark, d):
    e = table(spark, d, "events")
    text = F.concat(
        F.lit("Error: Value '"), C("value").cast("decimal(10,2)").cast("string"), F.lit("' is out of range for "), "event_type",
        F.lit(". Row: ["), C("user_id").cast("string"), F.lit(", "), "props", F.lit("]\r\n\nline "), C("event_id").cast("string"),
    )
    only_row = F.concat(F.lit("Row: "), "props")
    return fn.redact(e.select("event_id", F.when(C("event_type") == "error", only_row).otherwise(text).alias("message")), "message")


def temporal_text(spark, d):
    df = table(spark, d, "orders").select(
        "o_orderkey", F.unix_date(F.to_date("o_orderdate")).alias("day"), C("o_orderdate").alias("at"),
        (F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400000000 + C("o_orderkey")).alias("utc_micros"),
        ((C("o_orderkey") % 86400) * 1000000).alias("clock"),
    )
    return fn.format_temporals(df, {"day": "date", "at": "datetime", "utc_micros": "timestamp", "clock": "time"})


RAW_EVENTS = """
WITH r AS (SELECT event_id, event_type AS kind, CAST(floor(value) AS BIGINT) AS level, CASE WHEN event_type <> 'view' THEN user_id END AS owner FROM events),
q AS (SELECT *, length(kind) > 6 AS long_kind, level > 127 AS high, owner IS NULL AS no_owner FROM r)
"""

QUERIES = {
    "encode_json": (encode_json, """SELECT '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_size":' || p_size || '}' AS row FROM part"""),
    "encode_json_nulls": (encode_json_nulls, """
        SELECT '{"o_orderkey":' || o_orderkey || CASE WHEN o_orderstatus <> 'P' THEN ',"o_orderstatus":"' || o_orderstatus || '"' ELSE '' END ||
               ',"day":"' || strftime(o_orderdate, '%Y-%m-%d') || '","__op":' || CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END || '}' AS row FROM orders"""),
    "encode_csv": (encode_csv, """
        SELECT concat_ws(chr(1), o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, strftime(o_orderdate, '%Y-%m-%d'),
               CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '\\N' END, CAST(o_totalprice AS DECIMAL(12,2)),
               '[' || o_orderkey || ',' || o_custkey || ']') AS row FROM orders"""),
    "normalized_rows": (normalized_rows, """
        SELECT event_id, CAST(value > 50 AS INTEGER) AS big, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, strftime(ts, '%Y-%m-%d') AS day,
               CAST(value AS DECIMAL(10,2)) AS value, user_id AS code FROM events"""),
    "json_promotion": (json_promotion, """SELECT '{"event_id":' || event_id || ',"props":' || replace(props, ' ', '') || ',"kind":"' || event_type || '"}' AS row FROM events"""),
    "nested_to_load": (nested_to_load, """
        SELECT o_orderkey, '{"c":' || o_custkey || ',"d":"' || strftime(o_orderdate, '%Y-%m-%d') || '"}' AS as_text,
               '{"c":' || o_custkey || ',"d":"' || strftime(o_orderdate, '%Y-%m-%d') || '"}' AS row,
               strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(o_custkey AS VARCHAR) AS customer, strftime(o_orderdate, '%Y-%m-%d') AS customer_day FROM orders"""),
    "decode_csv": (decode_csv, _ORDERS_SQL),
    "decode_json": (decode_json, _ORDERS_SQL),
    "decode_json_arrays": (decode_json_arrays, _ORDERS_SQL),
    "decode_mapped_csv": (decode_mapped_csv, "SELECT *, upper(n_name || '/' || n_regionkey) AS label FROM nation"),
    "text_files": (text_files, _ORDERS_SQL),
    "framed_payloads": (framed_payloads, "SELECT count(*) AS n_rows, CAST(sum(length(l_orderkey || ',' || l_linenumber || ';')) AS BIGINT) AS chars FROM lineitem"),
    "custom_records": (custom_records, r"SELECT conv_id, turn, len(string_split_regex(trim(text, E' \n\t\r'), '\s+')) AS words FROM conversations"),
    "quality_good": (quality_good, RAW_EVENTS + "SELECT event_id, kind, CAST(level AS TINYINT) AS level, owner FROM q WHERE NOT long_kind AND NOT high AND NOT no_owner"),
    "quality_bad": (quality_bad, RAW_EVENTS + """
        SELECT event_id, concat_ws('; ', CASE WHEN long_kind THEN 'Value ''' || kind || ''' does not fit VARCHAR(6) of ''kind''' END,
               CASE WHEN high THEN 'Value ''' || level || ''' does not fit TINYINT of ''level''' END,
               CASE WHEN no_owner THEN 'NULL value in non-nullable column ''owner''' END) AS reasons
        FROM q WHERE long_kind OR high OR no_owner"""),
    "quality_lenient": (quality_lenient, RAW_EVENTS + "SELECT event_id, CASE WHEN NOT long_kind THEN kind END AS kind, CASE WHEN NOT high THEN CAST(level AS TINYINT) END AS level, owner FROM q WHERE NOT no_owner"),
    "load_report": (load_report, RAW_EVENTS + """
        SELECT count(*) AS total_rows, count(*) FILTER (kind <> 'click' AND NOT (long_kind OR high OR no_owner)) AS loaded_rows,
               count(*) FILTER (kind <> 'click' AND (long_kind OR high OR no_owner)) AS filtered_rows, count(*) FILTER (kind = 'click') AS unselected_rows,
               CAST(coalesce(sum(strlen(CAST(event_id AS VARCHAR)) + strlen(kind) + coalesce(strlen(CAST(level AS VARCHAR)), 0) + coalesce(strlen(CAST(owner AS VARCHAR)), 0))
                   FILTER (kind <> 'click' AND NOT (long_kind OR high OR no_owner)), 0) AS BIGINT) AS loaded_bytes FROM q"""),
    "redacted_messages": (redacted_messages, """
        SELECT event_id, CASE WHEN event_type = 'error' THEN 'Data validation errors detected. Row data has been redacted for security.'
               ELSE 'Error: column value is out of range for ' || event_type || '. ' || chr(10) || 'line ' || event_id END AS message FROM events"""),
    "temporal_text": (temporal_text, """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at,
               strftime(date_trunc('day', o_orderdate) + to_microseconds(o_orderkey) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS utc_micros,
               strftime(TIMESTAMP '2000-01-01' + to_seconds(o_orderkey % 86400), '%H:%M:%S') AS clock FROM orders"""),
}
