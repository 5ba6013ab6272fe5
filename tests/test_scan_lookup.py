import os

import pytest
from pyspark.sql import functions as F

import tablesync as ts
from tablesync.plans import pushed_filters, read_columns, shuffles, split_filters

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def path(t):
    return f"{SF}/{t}.parquet"


def test_projection_and_pushdown(spark):
    df = ts.scan(spark, path("orders"), columns=["o_totalprice", "o_orderkey"], where=[F.col("o_orderstatus") == "F", "o_totalprice > 1000"])
    assert df.columns == ["o_totalprice", "o_orderkey"]
    assert set(read_columns(df)) == {"o_totalprice", "o_orderkey", "o_orderstatus"}
    assert {p.split("(")[0] for p in pushed_filters(df)} >= {"EqualTo", "GreaterThan"}
    with pytest.raises(ValueError, match="not in the table"):
        ts.scan(spark, path("orders"), columns=["nope"])


def test_every_comparison_is_pushed(spark):
    df = spark.read.parquet(path("part"))
    c = F.col("p_size")
    preds = [c == 1, c != 1, c > 1, c >= 1, c < 1, c <= 1, (c > 1) & (c < 5), (c == 1) | ((c == 2) & (F.col("p_name") == "x")), c.isNull(), c.isNotNull(), ~(c > 3)]
    pushed, residual = split_filters(df, preds)
    assert len(pushed) == len(preds) and not residual
    odd = [F.char_length("p_name") > 3, F.col("p_name").like("%ring%x"), (c > 1) & (F.char_length("p_name") > 3)]
    pushed, residual = split_filters(df, odd)
    assert not pushed and len(residual) == 3


def test_text_options(spark):
    opts = {"scan.columns": " p_name , p_partkey", "scan.filter": "p_size = 11"}
    df = ts.scan_options(spark, path("part"), opts)
    assert df.columns == ["p_name", "p_partkey"]
    n = ts.scan_options(spark, path("part"), {"scan.columns": "count(*)", "scan.filter": "p_size = 11"})
    assert n.first()[0] == df.count()
    assert read_columns(ts.scan_count(spark, path("lineitem"), "l_quantity > 10")) == ["l_quantity"]
    assert ts.scan(spark, path("part"), limit=3).count() == 3


def test_observed_rows(spark):
    df, seen = ts.observe_scan(spark.read.parquet(path("nation")), "scan")
    df.collect()
    assert seen.get["total_scanned_rows"] == 25


def test_nested_columns(spark, tmp_path, rows):
    df = spark.sql(
        "select 0 c0, array(array(date'2024-03-27')) c1, named_struct('ts', date'2024-03-27', 'score', 8.9bd) c2, "
        "map(date'2024-03-27', cast(1.5 as decimal(38,10))) c3, named_struct('a', 1, 'b', array(1, 11), 'c', map(1, 'x')) c4"
    )
    df.write.parquet(str(tmp_path / "t"))
    back = ts.scan(spark, str(tmp_path / "t"), schema=df.schema, columns=["c4", "c3", "c0"])
    assert rows(back) == rows(df.select("c4", "c3", "c0"))
    assert spark.read.parquet(str(tmp_path / "t")).select("c4.a")._jdf.queryExecution().executedPlan().toString().count("array<int>") == 0


def test_lookup_join(spark, rows):
    dim = spark.createDataFrame([(True, "row2", 1), (True, "row2", 2), (None, "row1", 3)], "k1 boolean, k2 string, v int")
    probe = spark.createDataFrame([(False, "row1"), (True, "row2"), (None, "row1")], "k1 boolean, k2 string")
    assert rows(ts.lookup_join(probe, dim, ["k1", "k2"])) == [(True, "row2", 1), (True, "row2", 2)]
    assert ts.lookup_join(probe, dim, ["k1", "k2"], "left").count() == 4
    with pytest.raises(ValueError):
        ts.lookup_join(probe, dim, ["k1"], "full")
    assert rows(ts.lookup_by_keys(probe.union(probe), dim, ["k1", "k2"])) == [(True, "row2", 1), (True, "row2", 2)]


def test_lookup_broadcast_is_bounded(spark):
    dim, probe = spark.read.parquet(path("customer")), spark.read.parquet(path("orders")).withColumnRenamed("o_custkey", "c_custkey")
    assert shuffles(ts.lookup_join(probe, dim, ["c_custkey"]))[0] in ("IdentityBroadcastMode", "HashedRelationBroadcastMode")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "hashpartitioning" in shuffles(ts.lookup_join(probe, dim, ["c_custkey"], max_broadcast_bytes=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the estimate is below the bound, the rows are not
    wide = dim.selectExpr("c_custkey", "repeat(c_name, 5000) t")
    many = probe.crossJoin(spark.range(60)).select("c_custkey")
    plan = ts.lookup_join(many, wide, ["c_custkey"], max_broadcast_bytes=1 << 20)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    # a small probe sends its keys to the dimension, so only the rows found are joined
    few = probe.where("o_orderkey < 5").select("c_custkey", "o_orderkey")
    joined = ts.lookup_join(few, wide, ["c_custkey"], "left", max_broadcast_bytes=1 << 20)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == few.count()


def test_cached_dimension(spark):
    now = [0.0]
    cache = ts.CachedDimension(lambda: spark.range(int(now[0]) + 1), ttl_ms=5000, clock=lambda: now[0])
    assert cache.get().count() == 1
    now[0] = 4.9
    assert cache.get().count() == 1 and cache.loads == 1
    now[0] = 5.0
    assert cache.get().count() == 6 and cache.loads == 2


def test_heavy_keys_are_joined_apart(spark, rows):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7L WHEN id % 10 = 1 THEN null ELSE id % 500 END AS k", "CAST(id % 2 AS INT) AS j").repartition(4)
    dim = spark.range(400).selectExpr("id AS k", "CAST(id % 2 AS INT) AS j", "id * 2 AS v").unionAll(spark.sql("SELECT 7L, 1, -1L UNION ALL SELECT null, 0, -2L"))
    for on in (["k"], ["k", "j"]):
        right = dim if len(on) == 2 else dim.drop("j")
        for how in ("inner", "left"):
            want = rows(df.join(right, on, how).select(*df.columns, "v"))
            for options in ({}, {"share": 0.9}, {"max_broadcast_bytes": 0}):
                assert rows(ts.heavy_join(df, right, on, how, **options).select(*df.columns, "v")) == want
            assert rows(ts.lookup_join(df, right, on, how, max_broadcast_bytes=0, heavy_share=0.05).select(*df.columns, "v")) == want
    assert len(ts.heavy_keys(df, ["k"], 0.2)) == 1 and ts.heavy_keys(df.limit(0), ["k"], 0.2) == []
    plan = ts.heavy_join(df, dim.drop("j"), ["k"], "left", share=0.2)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    other = dim.select(dim.k.cast("int").alias("k"), "v")
    assert rows(ts.heavy_join(df, other, ["k"], "left").select(*df.columns, "v")) == rows(df.join(other, ["k"], "left").select(*df.columns, "v"))


def test_heavy_keys_leave_the_shuffle_even(spark):
    df = spark.range(20000).selectExpr("id", "IF(id % 2 = 0, 7L, id) AS k").repartition(8)
    dim = spark.range(20000).selectExpr("id AS k", "id AS v")
    rest = df.where(~ts.operators.lookup.key_hash(["k"]).isin(ts.heavy_keys(df, ["k"], 0.1)))
    sizes = [r["count"] for r in rest.repartition(8, "k").groupBy(__import__("pyspark").sql.functions.spark_partition_id()).count().collect()]
    assert max(sizes) < 1.2 * sum(sizes) / len(sizes) and ts.heavy_join(df, dim, ["k"], share=0.1).count() == 20000


def test_filter_of_many_keys(spark, rows):
    keys = spark.range(0, 40000, 4).selectExpr("id AS a", "CAST(id % 3 AS STRING) AS b").unionAll(spark.sql("SELECT null, 'x'"))
    dim = spark.range(100000).selectExpr("id AS a", "CAST(id % 3 AS STRING) AS b", "id * 2 AS v")
    wanted = ts.KeyFilter(keys.dropna(), ["a", "b"])
    passed = wanted.test(dim)
    hits = dim.join(keys, ["a", "b"], "left_semi")
    assert passed.count() < hits.count() * 1.2 and passed.join(keys, ["a", "b"], "left_semi").count() == hits.count() == 10000
    assert wanted.bytes == ts.KeyFilter.size(10000) < 10000 * 2
    got = ts.lookup_by_keys(keys, dim, ["a", "b"], max_broadcast_bytes=0)
    assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString() and rows(got) == rows(hits)
    assert rows(ts.lookup_by_keys(keys, dim, ["a", "b"], max_broadcast_bytes=0, max_filter_bytes=0)) == rows(hits)
    assert ts.lookup_by_keys(keys.limit(0), dim, ["a", "b"], max_broadcast_bytes=0).count() == 0
    import tablesync.operators.bloom as bloom
    old, bloom.SHARD_KEYS = bloom.SHARD_KEYS, 700
    try:
        assert ts.KeyFilter(keys.dropna(), ["a", "b"]).test(dim).join(keys, ["a", "b"], "left_semi").count() == 10000
    finally:
        bloom.SHARD_KEYS = old
