import random

import pytest
from pyspark.sql import functions as F

import tablesync as ts
from tablesync.streaming.parts import AT, cut, in_order

SCHEMA = "k bigint, v string, _kind string, _seq bigint"


def log(n, seed=1):
    r = random.Random(seed)
    return [(r.randrange(20), "x" * r.randrange(40), r.choice(("+U", "+U", "-D")), s) for s in range(n)]


def by_hand(rows):
    out = {}
    for k, v, kind, _ in sorted(rows, key=lambda x: x[3]):
        out.pop(k, None)
        if kind != "-D":
            out[k] = v
    return sorted(out.items())


@pytest.fixture
def table(spark, tmp_path):
    reg = ts.Registry(spark, str(tmp_path / "reg"))
    reg.ensure_tables([ts.TableSpec("db", "t", (ts.ColumnSpec("k", "BIGINT", False), ts.ColumnSpec("v", "STRING")), keys=("k",), buckets=2)])
    return reg.table("db", "t")


@pytest.mark.parametrize("rows,size", [(7, None), (None, 100), (7, 100), (1000, None), (1, None)])
def test_parts_are_consecutive_and_bounded(spark, tmp_path, rows, size):
    df = spark.createDataFrame(log(83), SCHEMA).repartition(5)
    staged = in_order(df, ["_seq"])
    staged.write.parquet(str(tmp_path / "s"))
    staged = spark.read.parquet(str(tmp_path / "s"))
    parts = cut(staged, rows, size)
    seen = []
    for p in parts:
        got = staged.where(F.col(AT).between(p.first, p.last)).orderBy(AT).collect()
        assert len(got) == p.rows and (rows is None or p.rows <= rows) and sum(r["_bytes"] for r in got) == p.bytes
        assert size is None or p.bytes - got[-1]["_bytes"] < size
        seen += [r["_seq"] for r in got]
    assert seen == list(range(83))
    if size is None:
        assert len(parts) == -(-83 // rows)
    assert cut(staged.limit(0), rows, size) == []


def test_loads_equal_one_load(spark, table):
    rows = log(60)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    reports = ts.load_in_parts(table, df, "_seq", max_rows=11, query_id="q", batch_id=0)
    assert [r["total_rows"] for r in reports] == [11, 11, 11, 11, 11, 5] and table.manifest()["version"] == 6
    assert sorted(map(tuple, table.read().collect())) == by_hand(rows)
    assert ts.load_in_parts(table, df, "_seq", max_rows=11, query_id="q", batch_id=0)[0]["skipped"] and table.manifest()["version"] == 6
    more = ts.load_in_parts(table, df.limit(0), "_seq", max_rows=11, query_id="q", batch_id=1)
    assert len(more) == 1 and table.finished("q", 1)
    # without limits the same id goes on
    table.load(spark.createDataFrame([(99, "z", "+U", 1)], SCHEMA), "_seq", query_id="q", batch_id=2)
    assert table.read().where("k = 99").count() == 1


@pytest.mark.parametrize("fail_after", [1, 3, 5])
def test_replay_goes_on_in_the_middle(spark, table, fail_after):
    rows, done = log(60, 2), []

    def report(r):
        done.append(r)
        if len(done) == fail_after:
            raise RuntimeError("stop")

    with pytest.raises(RuntimeError, match="stop"):
        ts.load_in_parts(table, spark.createDataFrame(rows, SCHEMA).repartition(3), "_seq", max_rows=11, query_id="q", batch_id=4, report=report)
    assert table.manifest()["version"] == fail_after and not table.finished("q", 4)
    again = ts.load_in_parts(table, spark.createDataFrame(rows[::-1], SCHEMA).repartition(7), "_seq", max_rows=11, query_id="q", batch_id=4)
    assert [r["skipped"] for r in again] == [k < fail_after for k in range(6)] and table.manifest()["version"] == 6
    assert sorted(map(tuple, table.read().collect())) == by_hand(rows)


def test_parts_keep_rejects(spark, table):
    df = spark.createDataFrame([("x" if s % 5 == 0 else str(s), "v", s) for s in range(20)], "k string, v string, _seq bigint")
    reports = ts.load_in_parts(table, df, "_seq", max_rows=8, query_id="q", batch_id=0, rejects=True)
    assert [r["filtered_rows"] for r in reports] == [2, 2, 0] and ts.Rejects(table).read().count() == 4
