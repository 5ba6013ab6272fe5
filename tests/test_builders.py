import pytest
from pyspark.sql import functions as F

import tablesync as ts

C = ts.ColumnSpec
PAGES = ts.sketch_table(ts.TableSpec(
    "db", "pages", (C("page", "INT", False), C("day", "DATE", False), C("n", "BIGINT", aggregate="sum"), C("top", "INT", aggregate="max"), C("users", "BITMAP"), C("items", "BITMAP"), C("seen", "HLL")),
    model="aggregate", keys=("page", "day"), buckets=2))
MAPPING = "page,at,user,item,n=1,top=cast(item as int),day=to_date(at),users=to_bitmap(user),items=to_bitmap(cast(item as bigint) + 0),seen=hll_hash(user)"


def make(spark, tmp_path, spec=PAGES):
    return ts.KeyedTable.create(spark, str(tmp_path / "t"), spec)


def test_documented_example(spark, tmp_path):
    spec = ts.sketch_table(ts.TableSpec("db", "page_uv", (C("page_id", "INT", False), C("visit_date", "DATETIME", False), C("visit_users", "BITMAP")), model="aggregate", keys=("page_id", "visit_date"), buckets=2))
    assert spec.keys == ("page_id", "visit_date", "bitmap_bucket")
    t = make(spark, tmp_path, spec)
    rows = [(1, "2020-06-23 01:30:30", 13), (1, "2020-06-23 01:30:30", 23), (1, "2020-06-23 01:30:30", 33), (1, "2020-06-23 02:30:30", 13), (2, "2020-06-23 01:30:30", 23)]
    report = t.load(spark.createDataFrame(rows, "a int, b string, c int"), mapping="page_id,visit_date,visit_user_id,visit_users=to_bitmap(visit_user_id)")
    assert report["total_rows"] == report["loaded_rows"] == 5
    assert {r.page_id: r.visit_users for r in ts.aggregate_values(t.read(), spec, ["page_id"]).collect()} == {1: 3, 2: 1}


def by_hand(rows):
    out = {}
    for page, at, user, item in rows:
        e = out.setdefault((page, at[:10]), [0, None, set(), set()])
        e[0] += 1
        if item is not None:
            e[1] = max(e[1], int(item)) if e[1] is not None else int(item)
            e[3].add(int(item))
        if user is not None:
            e[2].add(int(user))
    return {k: (n, top, len(u), len(i)) for k, (n, top, u, i) in out.items()}


def test_several_sketches_of_one_row(spark, tmp_path):
    t = make(spark, tmp_path)
    rows = [(k % 3, f"2024-01-0{1 + k % 2} 10:00:00", None if k % 7 == 0 else str(k * 997 % 100000), None if k % 5 == 0 else str(k * 31 % 40000)) for k in range(400)]
    rows += [(9, "2024-01-01 00:00:00", None, None)]
    for i in range(3):
        for _ in range(2):  # each load is delivered twice
            t.load(spark.createDataFrame(rows[i::3], "page int, at string, user string, item string"), mapping=MAPPING, query_id="q", batch_id=i)
    got = ts.aggregate_values(t.read(), PAGES).collect()
    assert {(r.page, str(r.day)): (r.n, r.top, r.users, r.items) for r in got} == by_hand(rows)
    assert all(abs(r.seen - r.users) <= 3 for r in got)
    total = ts.aggregate_values(t.read(), PAGES, []).first()
    assert total.users == len({r[2] for r in rows} - {None}) and total.items == len({r[3] for r in rows} - {None}) and total.n == len(rows)
    assert t.read().where("bitmap_count(users) = 0 OR bitmap_count(items) = 0 OR hll_sketch_estimate(seen) = 0").count() == 0  # no sketch where there is no value
    assert t.read().where("page = 9 AND users IS NULL AND items IS NULL AND seen IS NULL").count() == 1


def test_values_that_fit_no_bitmap(spark, tmp_path):
    t = make(spark, tmp_path)
    rows = [(1, "2024-01-01", u, "1") for u in ("5", "-1", "x", "2.5", None, "99999999999999999999", "7")]
    df = spark.createDataFrame(rows, "page int, at string, user string, item string")
    with pytest.raises(ts.LoadRejected, match="BITMAP of 'users'"):
        t.load(df, mapping=MAPPING)
    report = t.load(df, mapping=MAPPING, rejects=True)
    rejects = ts.Rejects(t)
    assert report["filtered_rows"] == 4 and sorted(r.user for r in rejects.rows(report["rejected_load"]).collect()) == ["-1", "2.5", "99999999999999999999", "x"]
    rejects.replay(lambda d: d.where("user IN ('-1', '2.5')").withColumn("user", F.lit("8")), mapping=MAPPING)
    assert rejects.open() == [] and ts.aggregate_values(t.read(), PAGES).first()["users"] == 3


@pytest.mark.parametrize("mapping,message", [
    ("page,u,users=to_bitmap(u) + 1", "one call"), ("page,u,users=if(true, to_bitmap(u), null)", "one call"), ("page,u,seen=to_bitmap(u)", "BITMAP column"), ("page,u,users=hll_hash(u)", "HLL column"),
    ("page,u,n=to_bitmap(u)", "BITMAP column"), ("page,u,users=to_bitmap()", "arguments"), ("page,u,nothing=to_bitmap(u)", "no column"),
])
def test_mappings_that_cannot_be_loaded(spark, tmp_path, mapping, message):
    with pytest.raises(ValueError, match=message):
        ts.LoadColumns.compile(mapping, PAGES)


def test_other_tables_take_scalar_mappings(spark, tmp_path):
    spec = ts.TableSpec("db", "k", (C("id", "INT", False), C("name", "STRING")), keys=("id",), buckets=2)
    t = make(spark, tmp_path, spec)
    t.load(spark.createDataFrame([("1", "a", 1), ("2", "b", 2)], "id string, raw string, _seq int"), "_seq", mapping="id,raw,_seq,name=concat('to_bitmap(', raw, ')')")
    assert sorted(map(tuple, t.read().collect())) == [(1, "to_bitmap(a)"), (2, "to_bitmap(b)")]
    with pytest.raises(ValueError, match="aggregate table"):
        ts.LoadColumns.compile("id,raw,name=to_bitmap(raw)", spec)
    plain = ts.TableSpec("db", "k", (C("id", "INT", False), C("users", "BITMAP")), model="aggregate", keys=("id",))
    with pytest.raises(ValueError, match="sketch_table"):
        ts.LoadColumns.compile("id,u,users=to_bitmap(u)", plain)
    assert ts.LoadColumns.compile("id,users=bitmap_empty()", ts.sketch_table(plain)).builders[0].source is None
