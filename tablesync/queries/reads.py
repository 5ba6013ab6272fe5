"""Scans, predicates and lookup joins."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from .. import operators as op, sources as src
from ..plans import split_filters
from ..session import work_dir


def table(spark, d, name, **kw):
    return src.scan(spark, f"{d}/{name}.parquet", **kw)


def _where(name, columns, condition):
    """A scan of ``columns`` under ``condition()``, built when a session exists."""
    return lambda spark, d: table(spark, d, name, columns=columns, where=condition())


C = F.col
PART = ["p_partkey", "p_size", "p_name"]
ORDER = ["o_orderkey", "o_orderdate"]


def _simple(sql_condition, condition, name="part", columns=PART):
    return _where(name, columns, condition), f"SELECT {', '.join(columns)} FROM {name} WHERE {sql_condition}"


def scan_full(spark, d):
    return table(spark, d, "customer")


def filter_boolean_column(spark, d):
    df = table(spark, d, "lineitem").withColumn("returned", C("l_returnflag") == "R")
    return df.where("returned").select("l_orderkey", "l_linenumber", "l_partkey")


def residual_filters(spark, d):
    df = table(spark, d, "part")
    predicates = [C("p_name").like("%ring%"), C("p_size").isin(3, 7, 11, 19), C("p_size").between(2, 15), F.char_length("p_brand") > 7]
    pushed, residual = split_filters(df, predicates)
    for p in [*pushed, *residual]:
        df = df.where(p)
    return df.select("p_partkey", "p_name", "p_size", "p_brand")


def scan_text_options(spark, d):
    options = {"scan.columns": "o_custkey, o_orderkey", "scan.filter": "o_orderstatus = 'F' and o_totalprice >= 100000"}
    return src.scan_options(spark, f"{d}/orders.parquet", options)


def scan_count(spark, d):
    return src.scan_count(spark, f"{d}/lineitem.parquet", "l_quantity > 25")


def scan_count_all(spark, d):
    return src.scan_options(spark, f"{d}/lineitem.parquet", {"scan.columns": "count(*)"})


def scan_limit(spark, d):
    return table(spark, d, "lineitem", limit=1000).agg(F.count("*").alias("n"))


def observed_scan(spark, d):
    """The counter of a scan, read after the scan has run."""
    df, seen = src.observe_scan(table(spark, d, "supplier", columns=["s_suppkey", "s_name"]), "supplier")
    df.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(int(v),) for v in seen.get.values()][:1], "scanned bigint")


def schema_on_read(spark, d):
    wire = table(spark, d, "orders").select(
        C("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_day"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(".123456789")).alias("o_at"), "o_orderpriority",
    )
    declared = T.StructType([
        T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_day", T.DateType()),
        T.StructField("o_at", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType()),
    ])
    return op.conform(wire, declared)


def nested_columns(spark, d):
    """Nested values written to Parquet and read back from there."""
    path = work_dir(spark, "nested")
    nested = table(spark, d, "orders").select(
        "o_orderkey", F.struct(C("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("day")).alias("s"),
        F.create_map("o_orderkey", "o_orderpriority").alias("m"), F.array("o_orderkey", "o_custkey").alias("a"),
        F.array(F.array("o_custkey")).alias("aa"),
    )
    nested.write.parquet(path)
    return src.scan(spark, path).select(
        "o_orderkey", "s.status", "s.day", F.element_at("m", C("o_orderkey")).alias("priority"), C("a")[1].alias("custkey"),
        C("aa")[0][0].alias("inner_custkey"), F.size("aa").alias("n"),
    )


def array_scan(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.size("embedding").alias("dims"), C("embedding")[0].cast("double").alias("first"), "label")


def array_elements(spark, d):
    """Every element of an array column with its place."""
    return table(spark, d, "embeddings", columns=["vec_id", "embedding"]).select("vec_id", F.posexplode("embedding").alias("at", "value")).select("vec_id", "at", C("value").cast("double").alias("value"))


def lookup_join_inner(spark, d):
    dim = table(spark, d, "customer", columns=["c_custkey", "c_name", "c_nationkey"])
    orders = table(spark, d, "orders", columns=["o_orderkey", "o_custkey"]).withColumnRenamed("o_custkey", "c_custkey")
    return op.lookup_join(orders, dim, ["c_custkey"])


def lookup_join_left(spark, d):
    dim = table(spark, d, "customer", columns=["c_custkey", "c_mktsegment"], where=C("c_acctbal") > 5000)
    orders = table(spark, d, "orders", columns=["o_orderkey", "o_custkey"]).withColumnRenamed("o_custkey", "c_custkey")
    return op.lookup_join(orders, dim, ["c_custkey"], "left")


def lookup_join_multi_key(spark, d):
    lines = table(spark, d, "lineitem", columns=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    dim = lines.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("pair_lines"))
    return op.lookup_join(lines, dim, ["l_partkey", "l_suppkey"])


def lookup_join_many_matches(spark, d):
    dim = table(spark, d, "orders", columns=["o_custkey", "o_orderkey"]).withColumnRenamed("o_custkey", "c_custkey")
    probe = table(spark, d, "customer", columns=["c_custkey", "c_mktsegment"])
    return op.lookup_join(probe, dim, ["c_custkey"]).groupBy("c_custkey", "c_mktsegment").agg(F.count("*").alias("matches"), F.max("o_orderkey").alias("top"))


def _some_null(spark, d):
    """Parts of which some have no type, as a stored table: the null filters reach the files."""
    path = work_dir(spark, "nulls")
    table(spark, d, "part").select("p_partkey", F.when(C("p_size") > 10, C("p_type")).alias("kind")).write.parquet(path)
    return path


def filter_is_null(spark, d):
    return src.scan(spark, _some_null(spark, d), where=C("kind").isNull())


def filter_is_not_null(spark, d):
    return src.scan(spark, _some_null(spark, d), where=C("kind").isNotNull())


def lookup_join_heavy_keys(spark, d):
    """A third of the orders ask for one customer, some for none; the dimension counts as too big to broadcast."""
    key = F.when(C("o_orderkey") % 3 == 0, F.lit(1).cast("bigint")).when(C("o_orderkey") % 7 != 0, C("o_custkey").cast("bigint"))
    orders = table(spark, d, "orders").select("o_orderkey", key.alias("c_custkey"))
    customers = table(spark, d, "customer").select(C("c_custkey").cast("bigint").alias("c_custkey"), "c_name")
    return op.heavy_join(orders, customers, ["c_custkey"], "left", share=0.1)


def lookup_by_many_keys(spark, d):
    """Keys that count as too many to broadcast: a filter of them is tested where the dimension is scanned."""
    asked = table(spark, d, "lineitem", where=C("l_quantity") > 45).select(C("l_orderkey").alias("o_orderkey"))
    return op.lookup_by_keys(asked, table(spark, d, "orders"), ["o_orderkey"], max_broadcast_bytes=0).select("o_orderkey", "o_custkey", "o_orderdate")


def lookup_by_keys(spark, d):
    asked = table(spark, d, "orders", where=C("o_totalprice") > 400000).select(C("o_custkey").alias("c_custkey"))
    return op.lookup_by_keys(asked, table(spark, d, "customer"), ["c_custkey"]).select("c_custkey", "c_name", "c_nationkey")


QUERIES = {
    "scan_full": (scan_full, "SELECT * FROM customer"),
    "scan_project_filter": _simple("o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1998-01-01'", lambda: [C("o_orderstatus") == "O", "o_orderdate < timestamp_ntz'1998-01-01'"], "orders", ["o_totalprice", "o_orderkey"]),
    "filter_eq": _simple("p_size = 11", lambda: C("p_size") == 11),
    "filter_ne": _simple("p_size <> 11", lambda: C("p_size") != 11),
    "filter_gt": _simple("p_size > 11", lambda: C("p_size") > 11),
    "filter_ge": _simple("p_size >= 11", lambda: C("p_size") >= 11),
    "filter_lt": _simple("p_size < 11", lambda: C("p_size") < 11),
    "filter_le": _simple("p_size <= 11", lambda: C("p_size") <= 11),
    "filter_and": _simple("p_size > 11 AND p_type = 'SMALL'", lambda: [C("p_size") > 11, C("p_type") == "SMALL"]),
    "filter_or": _simple("p_size = 1 OR (p_size = 50 AND p_type = 'ECONOMY')", lambda: (C("p_size") == 1) | ((C("p_size") == 50) & (C("p_type") == "ECONOMY"))),
    "filter_is_null": (filter_is_null, "SELECT p_partkey, CAST(NULL AS VARCHAR) AS kind FROM part WHERE p_size <= 10"),
    "filter_is_not_null": (filter_is_not_null, "SELECT p_partkey, p_type AS kind FROM part WHERE p_size > 10"),
    "filter_not": _simple("NOT (p_size > 11)", lambda: ~(C("p_size") > 11)),
    "filter_boolean_column": (filter_boolean_column, "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'R'"),
    "filter_cast": _simple("CAST(p_size AS VARCHAR) = '7'", lambda: C("p_size").cast("string") == "7"),
    "filter_time_literals": _simple("o_orderdate >= TIMESTAMP '1996-06-01 00:00:00' AND o_orderdate < DATE '1996-09-01'", lambda: "o_orderdate >= timestamp_ntz'1996-06-01 00:00:00' and o_orderdate < date'1996-09-01'", "orders", ORDER),
    "residual_filters": (residual_filters, "SELECT p_partkey, p_name, p_size, p_brand FROM part WHERE p_name LIKE '%ring%' AND p_size IN (3, 7, 11, 19) AND p_size BETWEEN 2 AND 15 AND length(p_brand) > 7"),
    "scan_text_options": (scan_text_options, "SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 100000"),
    "scan_count": (scan_count, 'SELECT count(*) AS "count" FROM lineitem WHERE l_quantity > 25'),
    "scan_count_all": (scan_count_all, 'SELECT count(*) AS "count" FROM lineitem'),
    "scan_limit": (scan_limit, "SELECT count(*) AS n FROM (SELECT * FROM lineitem LIMIT 1000)"),
    "observed_scan": (observed_scan, "SELECT count(*) AS scanned FROM supplier"),
    "schema_on_read": (schema_on_read, "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_day, o_orderdate + INTERVAL 123456 MICROSECOND AS o_at, o_orderpriority FROM orders"),
    "nested_columns": (nested_columns, "SELECT o_orderkey, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS day, o_orderpriority AS priority, o_custkey AS custkey, o_custkey AS inner_custkey, CAST(1 AS INTEGER) AS n FROM orders"),
    "array_scan": (array_scan, "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims, CAST(embedding[1] AS DOUBLE) AS first, label FROM embeddings"),
    "array_elements": (array_elements, "SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS at, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings"),
    "lookup_join_inner": (lookup_join_inner, "SELECT c_custkey, o_orderkey, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey"),
    "lookup_join_left": (lookup_join_left, "SELECT o_custkey AS c_custkey, o_orderkey, c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) ON o_custkey = c_custkey"),
    "lookup_join_multi_key": (lookup_join_multi_key, "SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS pair_lines FROM lineitem"),
    "lookup_join_many_matches": (lookup_join_many_matches, "SELECT c_custkey, c_mktsegment, count(*) AS matches, max(o_orderkey) AS top FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL"),
    "lookup_join_heavy_keys": (lookup_join_heavy_keys, """
        SELECT k AS c_custkey, o_orderkey, c_name FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS k FROM orders) LEFT JOIN customer ON k = c_custkey"""),
    "lookup_by_many_keys": (lookup_by_many_keys, "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)"),
    "lookup_by_keys": (lookup_by_keys, "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)"),
}
