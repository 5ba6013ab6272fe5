import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import tablesync as ts
from tablesync.operators import sketches


def make(spark, rows):
    return spark.createDataFrame(rows, "k string, v bigint")


def log():
    r = random.Random(4)
    rows = [("dense", r.randrange(40000)) for _ in range(6000)] + [("far", r.randrange(1 << 62)) for _ in range(500)] + [("one", 7)] * 5 + [("none", None)]
    rows += [("both", r.randrange(3000)) for _ in range(4000)] + [("both", 10 ** 12 + r.randrange(99)) for _ in range(50)] + [("edge", v) for v in (0, 32767, 32768, (1 << 63) - 1)]
    r.shuffle(rows)
    return rows


def by_hand(rows):
    out = {}
    for k, v in rows:
        if v is not None:
            out.setdefault(k, set()).add(v)
    return out


def test_rollups_merge_to_exact_counts(spark):
    rows, want = log(), by_hand(log())
    parts = [ts.mixed_rollup(make(spark, rows[i::3]), ["k"], "v") for i in range(3)]
    merged = ts.mixed_merge(ts.mixed_merge(parts[0], parts[1], ["k"]), parts[2], ["k"]).persist()
    assert {r.k: r.ndv for r in ts.mixed_ndv(merged, ["k"], ["k"]).collect()} == {k: len(v) for k, v in want.items()}
    assert ts.mixed_ndv(merged, [], ["k"]).first()["ndv"] == len(set().union(*want.values()))
    kinds = {(r.k, r.bitmap_bucket): (r.few, r.bitmap) for r in merged.collect()}
    assert all((few is None) != (bits is None) for few, bits in kinds.values()) and len(kinds) == merged.count()
    assert kinds["dense", 1][1] is not None and kinds["both", 1][1] is not None and kinds["edge", 0][0] == [0] and kinds["edge", 1][0] == [32766, 32767]
    again = ts.mixed_merge(merged, merged, ["k"])  # a union with itself changes nothing
    assert {r.k: r.ndv for r in ts.mixed_ndv(again, ["k"], ["k"]).collect()} == {k: len(v) for k, v in want.items()}
    assert ts.mixed_ndv(ts.mixed_rollup(make(spark, []), ["k"], "v"), ["k"], ["k"]).count() == 0
    with pytest.raises(Exception, match="negative"):
        ts.mixed_rollup(make(spark, [("a", -1)]), ["k"], "v").collect()


def test_lists_turn_into_bitmaps_at_the_bound(spark):
    n = sketches.MOST_LISTED
    a, b = (ts.mixed_rollup(spark.range(lo + 1, hi + 1).selectExpr("'x' AS k", "id AS v"), ["k"], "v") for lo, hi in ((0, n), (n // 2, n + 1)))
    assert a.where("few IS NOT NULL").count() == b.where("few IS NOT NULL").count() == 1
    merged = ts.mixed_merge(a, b, ["k"])
    assert merged.where("bitmap IS NOT NULL AND few IS NULL").count() == 1 and ts.mixed_ndv(merged, ["k"], ["k"]).first()["ndv"] == n + 1


def test_loads_are_merged_in_one_read_of_each_shuffle(spark):
    ids = spark.range(60000).selectExpr("'x' AS k", "if(id % 2 = 0, id, xxhash64(id) & 4611686018427387903) AS v", "id % 3 = 0 AS early")
    merged = ts.mixed_merge(*[ts.mixed_rollup(ids.where(w), ["k"], "v") for w in ("early", "NOT early")], ["k"])
    assert ts.mixed_ndv(merged, ["k"], ["k"]).first()["ndv"] == ids.select("v").distinct().count()
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan and "ShuffleQueryStage" in plan and "ReusedExchange" not in plan


def test_bitmaps_are_those_of_spark(spark):
    ids = spark.range(70000).where("id % 7 < 3 OR id BETWEEN 32760 AND 32830 OR id > 69000").selectExpr("'x' AS k", "id + 1 AS v", "id % 2 = 0 AS even")
    merged = ts.mixed_merge(*[ts.mixed_rollup(ids.where(w), ["k"], "v") for w in ("even", "NOT even")], ["k"])
    bits = lambda df: {r.bitmap_bucket: bytes(r.bitmap) for r in df.collect()}
    want = bits(ts.bitmap_rollup(ids, ["k"], "v"))
    assert len(want) == 3 and bits(ts.mixed_rollup(ids, ["k"], "v")) == bits(merged) == want


def test_scattered_ids_cost_about_their_size(spark, tmp_path):
    ids = spark.range(200000).selectExpr("'page' AS k", "xxhash64(id) & 4611686018427387903 AS v")
    ts.mixed_rollup(ids, ["k"], "v").coalesce(1).write.parquet(str(tmp_path / "m"))
    size = sum(p.stat().st_size for p in (tmp_path / "m").glob("*.parquet"))
    assert size <= 2 * 8 * 200000 and spark.read.parquet(str(tmp_path / "m")).count() > 190000


SCHEMA = "id bigint, kind string, seq bigint"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def lists(batch):
    return [None if k is None else [("db", "t", f'{{"k": {i}, "v": "{k}{n}"}}') for n in range(int(k))] for i, k in zip(batch.column("id").to_pylist(), batch.column("kind").to_pylist())]


def arrow_lists(batch):
    return pa.array([None if x is None else [{"database": d, "table": t, "row": r} for d, t, r in x] for x in lists(batch)])


@pytest.mark.parametrize("fn", [lists, arrow_lists])
def test_custom_records(spark, fn):
    df = spark.createDataFrame([(1, "0", 5), (2, "1", 6), (3, "3", 7), (4, None, 8)], SCHEMA).repartition(2)
    got = ts.custom_records(df, fn, keep=["seq"])
    assert got.columns == ["seq", "database", "table", "row"]
    assert rows_of(got.select("seq.seq", "row")) == sorted([(5, None), (6, '{"k": 2, "v": "10"}'), (8, None), *[(7, f'{{"k": 3, "v": "3{n}"}}') for n in range(3)]], key=repr)
    assert rows_of(got.where("seq.seq = 7").orderBy("seq").select("row")) == [(f'{{"k": 3, "v": "3{n}"}}',) for n in range(3)]
    with pytest.raises(Exception, match="1 lists for"):
        ts.custom_records(df.coalesce(1), lambda b: [[]]).collect()


def test_last_row_of_a_record_wins(spark, tmp_path):
    reg = ts.Registry(spark, str(tmp_path / "reg"))
    reg.ensure_tables([ts.TableSpec("db", "t", (ts.ColumnSpec("k", "BIGINT", False), ts.ColumnSpec("v", "STRING")), keys=("k",), buckets=2)])
    seen = []
    for n, schema in ((0, SCHEMA), (1, "id bigint, kind string")):
        df = spark.createDataFrame([(1, "2", 5), (2, "0", 6), (3, None, 7), (4, "3", 8)], SCHEMA).selectExpr(*[c.split()[0] for c in schema.split(", ")])
        df.write.parquet(str(tmp_path / f"in{n}"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / f"in{n}"))
        ts.route(stream, reg, str(tmp_path / f"ck{n}"), records=lists, on_report=seen.append).awaitTermination(120)
        assert rows_of(reg.read("db", "t")) == [(1, "21"), (4, "32")]
    assert [r[""]["skipped_rows"] for r in seen] == [2, 2]
