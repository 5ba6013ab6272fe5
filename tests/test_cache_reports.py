import pytest
from pyspark.sql import functions as F

import tablesync as ts


@pytest.fixture
def clock():
    return [100.0]


def test_keys_are_read_once_until_they_expire(spark, tmp_path, clock):
    cache = ts.KeyCache(spark, str(tmp_path / "c"), ttl_ms=5000, clock=lambda: clock[0])
    reads, version = [], [0]

    def reader():
        reads.append(version[0])
        return spark.sql(f"SELECT id AS k, CAST(id % 2 AS STRING) AS j, {version[0]} AS v FROM range(10)").unionAll(spark.sql(f"SELECT 3L, '1', {version[0] + 100}"))

    def ask(*keys):
        df = spark.createDataFrame([(k, None if k is None else str(k % 2)) for k in keys], "k bigint, j string")
        got = cache.rows(df, reader, ["k", "j"])
        return sorted(tuple(r) for r in df.distinct().join(got, ["k", "j"]).collect())

    assert ask(1, 3, 77, None, 1) == [(1, "1", 0), (3, "1", 0), (3, "1", 100)]
    clock[0], version[0] = 102.0, 1
    assert ask(1, 2, 77) == [(1, "1", 0), (2, "0", 1)]
    again = ts.KeyCache(spark, str(tmp_path / "c"), ttl_ms=5000, clock=lambda: clock[0])  # after a restart
    assert sorted(tuple(r) for r in again.rows(spark.createDataFrame([(1, "1"), (2, "0")], "k bigint, j string"), reader, ["k", "j"]).where("k < 3").collect()) == [(1, "1", 0), (2, "0", 1)]
    clock[0], version[0] = 105.5, 2
    assert ask(1, 2, 77) == [(1, "1", 2), (2, "0", 1)]
    clock[0] = 120.0
    assert ask() == [] and ask(2) == [(2, "0", 2)]


def test_known_keys_leave_the_dimension_alone(spark, tmp_path, clock):
    cache = ts.KeyCache(spark, str(tmp_path / "c"), clock=lambda: clock[0])
    keys = spark.range(5).selectExpr("id AS k")
    dim = str(tmp_path / "dim")
    spark.range(100).selectExpr("id AS k", "id * 2 AS v").write.parquet(dim)
    assert cache.rows(keys, lambda: spark.read.parquet(dim), ["k"]).count() == 5
    broken = spark.range(100).selectExpr("id AS k", "CAST(raise_error('read') AS BIGINT) AS v")
    assert cache.rows(keys, lambda: broken, ["k"]).count() == 5


def test_many_parts_are_merged_and_unfinished_ones_go(spark, tmp_path, clock):
    cache = ts.KeyCache(spark, str(tmp_path / "c"), ttl_ms=60000, max_parts=3, clock=lambda: clock[0])
    for k in range(6):
        clock[0] += 1
        cache.rows(spark.createDataFrame([(k,)], "k bigint"), lambda: spark.range(100).selectExpr("id AS k", "id AS v"), ["k"])
    (tmp_path / "c" / "999999999-x").mkdir()
    got = cache.rows(spark.range(6).selectExpr("id AS k"), lambda: spark.range(100).selectExpr("id AS k", "-1L AS v"), ["k"])
    assert sorted(tuple(r) for r in got.collect()) == [(k, k) for k in range(6)]
    assert len([p for p in (tmp_path / "c").iterdir()]) <= 4 and not (tmp_path / "c" / "999999999-x").exists()


def test_reports_merge_over_folds_and_restarts(spark, tmp_path):
    path = str(tmp_path / "r")
    assert ts.LoadReports(spark, path).latencies().count() == 0
    for k in range(30):
        reports = ts.LoadReports(spark, path)  # a new driver each time
        report = {"skipped": False, "load_ms": 10 * (k + 1), "loaded_rows": k, "filtered_rows": 1, "loaded_bytes": 8 * k}
        reports.record(report, "q", k)
        reports.record(report, "q", k)  # delivered again
        reports.record({"skipped": True}, "q", k + 1000)
        if k % 7 == 6:
            reports.fold()
    reports.record({"db.a": report, "db.b": report, "": {"total_rows": 5}}, "routed", 0)
    got = {r.query_id: r for r in ts.LoadReports(spark, path).latencies().collect()}
    assert (got["q"].batches, got["q"].rows, got["q"].filtered, got["q"].bytes) == (30, 435, 30, 8 * 435)
    assert abs(got["q"].p50_ms - 150) <= 10 and got["q"].p95_ms in (280, 290) and got["q"].p99_ms == 300 and got["routed"].batches == 2
    assert ts.LoadReports(spark, path).latencies(["target"]).where("target = 'db.a'").count() == 1
    reports.fold()
    reports.fold()
    assert reports.latencies().where("query_id = 'q'").first()["batches"] == 30


def test_reports_of_a_stream(spark, tmp_path):
    reg = ts.Registry(spark, str(tmp_path / "reg"))
    reg.ensure_tables([ts.TableSpec("db", "t", (ts.ColumnSpec("k", "BIGINT", False), ts.ColumnSpec("v", "STRING")), keys=("k",), buckets=2)])
    spark.range(10).selectExpr("id AS k", "'x' AS v", "id AS _seq").write.parquet(str(tmp_path / "in"))
    reports, stream = ts.LoadReports(spark, str(tmp_path / "r")), spark.readStream.schema("k bigint, v string, _seq bigint").parquet(str(tmp_path / "in"))
    ts.stream_apply(stream, reg.table("db", "t"), str(tmp_path / "ck"), "_seq", report=lambda r: reports.record(r, "s", r["version"], "db.t")).awaitTermination(120)
    row = reports.latencies(["query_id", "target"]).first()
    assert (row.query_id, row.target, row.batches, row.rows, row.bytes) == ("s", "db.t", 1, 10, 90) and row.p50_ms > 0
