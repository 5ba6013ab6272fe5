import pytest
from pyspark.sql import functions as F

import tablesync as ts

SPEC = (ts.ColumnSpec("k", "BIGINT", False), ts.ColumnSpec("a", "TINYINT"), ts.ColumnSpec("b", "VARCHAR(3)", False))
SCHEMA = "k string, a string, b string, _seq int"
ROWS = [("1", "5", "abc", 1), ("2", "500", "abc", 2), ("3", "7", None, 3), ("x", "1", "a", 4), ("5", "1", "abcd", 5)]


@pytest.fixture
def table(spark, tmp_path):
    reg = ts.Registry(spark, str(tmp_path / "reg"))
    reg.create_database("db")
    return reg.create(ts.TableSpec("db", "t", SPEC, keys=("k",), buckets=4))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_rejected_rows_are_kept_once(spark, table):
    df = spark.createDataFrame(ROWS, SCHEMA)
    report = table.load(df, "_seq", rejects=True, query_id="q", batch_id=0)
    assert (report["total_rows"], report["loaded_rows"], report["filtered_rows"], report["loaded_bytes"]) == (5, 1, 4, 12)
    assert "1 x column value does not fit TINYINT of 'a'" in report["reasons"] and not any("500" in r for r in report["reasons"])
    assert table.load(df, "_seq", rejects=True, query_id="q", batch_id=0)["skipped"]
    rejects = ts.Rejects(table)
    assert rows_of(table.read()) == [(1, 5, "abc")] and rejects.loads() == rejects.open() == [report["rejected_load"]]
    kept = rejects.rows(report["rejected_load"])
    assert rows_of(kept.drop("reasons")) == sorted((r for r in ROWS[1:]), key=repr) and kept.drop("reasons").dtypes == df.dtypes
    assert rejects.read().where("reasons LIKE '%abcd%' OR reasons LIKE '%500%'").count() == 0


def test_gate_shows_reasons(spark, table):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for options in ({}, {"rejects": True, "max_filter_ratio": 0.1}):
        with pytest.raises(ts.LoadRejected, match="4 of 5 rows") as e:
            table.load(df, "_seq", **options)
        assert len(e.value.samples) == 4 and "'500'" not in str(e.value) and "NULL value in non-nullable column 'b'" in str(e.value)
    assert ts.Rejects(table).loads() == [] and table.read().count() == 0
    assert table.load(df.where("k = '1'"), "_seq", rejects=True)["rejected_load"] is None and ts.Rejects(table).read().count() == 0


def test_replay_until_nothing_is_open(spark, table):
    table.load(spark.createDataFrame(ROWS, SCHEMA), "_seq", rejects=True, query_id="q", batch_id=0)
    rejects = ts.Rejects(table)
    fix = lambda d: d.where("k != 'x'").withColumn("b", F.substring(F.coalesce("b", F.lit("n")), 1, 3))
    first = rejects.replay(fix, "_seq")
    assert [r["loaded_rows"] for r in first.values()] == [2] and len(rejects.open()) == 1
    assert rejects.replay(fix, "_seq", loads=["no such load"]) == {}
    rejects.replay(lambda d: d.withColumn("a", F.lit("50")), "_seq")
    assert rejects.open() == [] and len(rejects.loads()) == 2 and rejects.replay(fix, "_seq") == {}
    assert rows_of(table.read()) == [(1, 5, "abc"), (2, 50, "abc"), (3, 7, "n"), (5, 1, "abc")]


def test_crash_between_commit_and_publication(spark, table, monkeypatch):
    df = spark.createDataFrame(ROWS, SCHEMA)

    def crash(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(ts.Rejects, "_publish", crash)
        with pytest.raises(KeyboardInterrupt):
            table.load(df, "_seq", rejects=True, query_id="q", batch_id=0)
    rejects = ts.Rejects(table)
    assert rejects.loads() == [] and table.finished("q", 0)
    assert table.load(df, "_seq", rejects=True, query_id="q", batch_id=0)["skipped"]
    assert len(rejects.loads()) == 1 and rejects.read().count() == 4
    with monkeypatch.context() as m:
        m.setattr(ts.KeyedTable, "load_once", crash)
        with pytest.raises(KeyboardInterrupt):
            table.load(df, "_seq", rejects=True, query_id="q", batch_id=1)
    assert rejects.settle() == [] and len(rejects.loads()) == 1


def test_types_kinds_and_partial_loads(spark, table):
    rows = spark.sql("""SELECT * FROM VALUES (1L, 300, CAST('x' AS STRING), '+I', TIMESTAMP_NTZ'2024-01-01 00:00:00.123456', 1.25BD, 1),
        (2L, 3, 'y', '+I', TIMESTAMP_NTZ'2024-01-01 00:00:00', 2BD, 2), (2L, 999, null, '-D', null, null, 3) AS t(k, a, b, _kind, at, price, _seq)""")
    report = table.load(rows.drop("at", "price"), "_seq", rejects=True)
    assert report["filtered_rows"] == 1 and table.read().count() == 0
    table.load(spark.createDataFrame([(1, 4, "q", 0)], "k long, a int, b string, _seq int"), "_seq")
    part = table.load(spark.createDataFrame([(1, 99, 1), (1, 200, 2)], "k long, a int, _seq int"), "_seq", mode="partial", rejects=True)
    assert part["filtered_rows"] == 1 and rows_of(table.read()) == [(1, 99, "q")]


def test_values_come_back_with_their_types(spark, tmp_path):
    spec = ts.TableSpec("db", "w", (ts.ColumnSpec("k", "TINYINT", False), ts.ColumnSpec("at", "DATETIME"), ts.ColumnSpec("price", "DECIMAL(10,3)"), ts.ColumnSpec("tags", "ARRAY<STRING>")), model="duplicate")
    t = ts.KeyedTable.create(spark, str(tmp_path / "w"), spec)
    df = spark.sql("SELECT 1000L AS k, TIMESTAMP_NTZ'2024-01-01 00:00:00.123456' AS at, CAST(1.125 AS DECIMAL(10,3)) AS price, array('a', null) AS tags")
    t.load(df, rejects=True)
    back = ts.Rejects(t).rows(ts.Rejects(t).loads()[0]).drop("reasons")
    assert back.dtypes == df.dtypes and back.collect() == df.collect()
