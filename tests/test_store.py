import json
import random

import pytest
from pyspark.sql import functions as F

import tablesync as ts
from tablesync.store.table import evolve_manifest
from .replay import COLS, random_log, replay
from .test_changes import changes_df, state_of

KV = (ts.ColumnSpec("k", "INT", False), ts.ColumnSpec("a", "INT"), ts.ColumnSpec("b", "STRING"))


@pytest.fixture
def reg(spark, tmp_path):
    r = ts.Registry(spark, str(tmp_path / "reg"))
    r.create_database("db")
    return r


def make(reg, name="t", columns=KV, keys=("k",), **kw):
    return reg.create(ts.TableSpec("db", name, tuple(columns), keys=keys, **{"buckets": 4, **kw}))


@pytest.mark.parametrize("on_read", [False, True])
@pytest.mark.parametrize("mode,opts", [("full", {}), ("partial", {"columns": ["k", "b"]}), ("full", {"merge_condition": "a"})])
def test_loads_equal_replay_for_any_split(spark, reg, mode, opts, on_read):
    rng = random.Random(5)
    log = random_log(rng, 50)
    cols = ["b"] if "columns" in opts else list(COLS)
    for r in log:
        r["has"] = set(cols)
    want = replay({}, log, "conditional" if opts.get("merge_condition") else mode, cols, opts.get("merge_condition"))
    t = make(reg, f"t_{mode}_{len(opts)}")
    for i, (lo, hi) in enumerate([(0, 20), (20, 21), (21, 50)]):
        df = changes_df(spark, log[lo:hi], rng, lo).drop("has_a", "has_b")
        if "columns" in opts:
            df = df.drop("a")
        for _ in range(2):  # every batch is delivered twice
            t.load(df, "_seq", mode=mode, query_id="q", batch_id=i, merge_on_read=on_read, **opts)
    assert state_of(t.read()) == want
    assert bool(t.manifest()["deltas"]) == (on_read and "merge_condition" not in opts)
    t.compact()
    assert state_of(t.read()) == want


def test_untouched_buckets_stay(spark, reg):
    t = make(reg, buckets=16)
    t.load(spark.range(200).selectExpr("cast(id as int) k", "1 a", "'x' b", "id _seq"), "_seq")
    first = list(t.manifest()["live"])[0]
    r = t.load(spark.createDataFrame([(5, 2, "y", 1)], "k int, a int, b string, _seq int"), "_seq")
    live = t.manifest()["live"]
    assert r["buckets"] == 1 and len(live[first]["buckets"]) == 15 and len(live) == 2
    assert t.read().count() == 200 and t.read().where("k = 5").first()["b"] == "y"
    assert t.read(1).where("k = 5").first()["b"] == "x"  # older version is still readable
    assert t.vacuum(keep=1) == 1
    assert t.read().count() == 200


def test_merge_on_read_mixed_loads(spark, reg):
    """Full and partial deltas, a conditional rewrite over them, schema changes and compaction, against the replay."""
    rng = random.Random(11)
    t = make(reg, props={"merge_on_read": "true"})
    state, at = {}, 0
    for i, kind in enumerate(["full", "full", "partial", "full", "partial", "conditional", "partial"]):
        log = random_log(rng, 25)
        cols = ["b"] if kind == "partial" else list(COLS)
        for r in log:
            r["has"] = set(cols)
        state = replay(state, log, kind, cols, "a" if kind == "conditional" else None)
        df = changes_df(spark, log, rng, at).drop("has_a", "has_b")
        at += len(log)
        if kind == "partial":
            df = df.drop("a")
        t.load(df, "_seq", mode="partial" if kind == "partial" else "full", merge_condition="a" if kind == "conditional" else None, query_id="q", batch_id=i)
        assert state_of(t.read()) == state
        if i == 3:
            assert len(t.manifest()["deltas"]) == 3
            t.compact(min_deltas=3)
            assert state_of(t.read()) == state
            assert all(len(e["buckets"]) < 4 for e in t.manifest()["deltas"].values())
        if i == 4:
            t.evolve(add=[ts.ColumnSpec("c", "INT", True, "3"), ts.ColumnSpec("d", "INT")])
            assert not t.manifest()["deltas"]  # the default made it merge
            assert {tuple(r) for r in t.read().select("c", "d").collect()} == {(3, None)}
    t.compact()
    t.vacuum(1)
    assert state_of(t.read()) == state


def test_merge_on_read_does_not_rewrite(spark, reg):
    t = make(reg, buckets=8)
    t.load(spark.range(1000).selectExpr("cast(id as int) k", "1 a", "'x' b", "id _seq"), "_seq")
    live = t.manifest()["live"]
    for i in range(2):
        t.load(spark.range(0, 1000, 10).selectExpr("cast(id as int) k", f"{i} a", "'y' b", "id _seq"), "_seq", merge_on_read=True)
    assert t.manifest()["live"] == live and len(t.manifest()["deltas"]) == 2
    assert t.read().where("b = 'y' and a = 1").count() == 100 and t.read().count() == 1000
    t.evolve(drop=["a"], add=[ts.ColumnSpec("a", "STRING")])
    assert t.read().where("a is not null").count() == 0 and len(t.manifest()["deltas"]) == 2


def test_old_manifests_go(spark, reg):
    t = make(reg, props={"keep_versions": "3"})
    for i in range(5):
        t.evolve(add=[ts.ColumnSpec(f"x{i}", "INT")])
    assert t.versions() == [3, 4, 5]


def test_write_parallelism(spark, reg):
    t = make(reg, buckets=2)
    t.load(spark.range(1000).selectExpr("cast(id as int) k", "1 a", "'x' b", "id _seq"), "_seq", parallelism=3)
    files = [f for b in t._files.names(t._commit_dir(list(t.manifest()["live"])[0])) if b.startswith("_bucket") for f in t._files.names(f"{t._commit_dir(list(t.manifest()['live'])[0])}/{b}") if f.endswith(".parquet")]
    assert len(files) == 2 and t.read().count() == 1000  # a bucket is one task's work here


def test_delete_everything(spark, reg):
    t = make(reg)
    rows = spark.createDataFrame([(1, 1, "x", "+I", 1), (2, 1, "x", "+I", 2)], "k int, a int, b string, _kind string, _seq int")
    t.load(rows, "_seq")
    t.load(rows.withColumn("_kind", F.lit("-D")), "_seq")
    assert t.read().count() == 0 and t.manifest()["live"] == {}


def test_empty_load(spark, reg):
    t = make(reg)
    empty = spark.createDataFrame([], "k int, a int, b string, _seq int")
    for mode in ("full", "partial"):
        assert t.load(empty, "_seq", mode=mode)["total_rows"] == 0
    assert t.load(empty, "_seq", merge_condition="a")["total_rows"] == 0
    assert t.read().count() == 0


def test_gate_stops_before_commit(spark, reg):
    t = make(reg)
    df = spark.createDataFrame([("1", "1", "x", 1), ("z", "1", "x", 2)], "k string, a string, b string, _seq int")
    with pytest.raises(ts.LoadRejected):
        t.load(df, "_seq")
    assert t.manifest()["version"] == 0
    r = t.load(df, "_seq", max_filter_ratio=0.5)
    assert (r["total_rows"], r["loaded_rows"], r["filtered_rows"]) == (2, 1, 1)
    assert t.read().count() == 1


def test_crash_between_stage_and_publish(spark, reg, monkeypatch):
    t = make(reg)
    df = spark.createDataFrame([(1, 1, "x", 1)], "k int, a int, b string, _seq int")

    def crash(manifest):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(t, "_publish", crash)
    with pytest.raises(RuntimeError):
        t.load(df, "_seq", query_id="q", batch_id=0)
    monkeypatch.undo()
    assert t.read().count() == 0
    assert len(t.abort_stale("other")) == 0 and len(t.abort_stale("q")) == 1
    t.load(df, "_seq", query_id="q", batch_id=0)
    assert t.read().count() == 1 and t.abort_stale("q") == []  # published work is never undone
    assert t.finished("q", 0) and not t.finished("q", 1)


def test_two_writers(spark, reg, monkeypatch):
    t = make(reg)
    df = spark.createDataFrame([(1, 1, "x", 1)], "k int, a int, b string, _seq int")
    stale = t.manifest()
    t.load(df, "_seq")
    monkeypatch.setattr(t, "manifest", lambda version=None: stale)
    with pytest.raises(ts.ConcurrentCommit):
        t.load(df, "_seq")
    monkeypatch.undo()
    assert t.read().count() == 1 and len(t._files.names(f"{t.path}/data")) == 1


def test_key_reads_open_their_buckets_only(spark, reg):
    t = make(reg, buckets=16)
    t.load(spark.range(1000).selectExpr("cast(id as int) k", "cast(id as int) a", "'x' b", "id _seq"), "_seq")
    some = t.read(keys={"k": [7, 900]})
    assert sorted(r["k"] for r in some.collect()) == [7, 900] and len({f.split("_bucket=")[1].split("/")[0] for f in some.inputFiles()}) <= 2
    one = reg.read("db", "t", where="k = 7")
    assert [r["a"] for r in one.collect()] == [7] and len({f.split("_bucket=")[1].split("/")[0] for f in one.inputFiles()}) == 1
    assert reg.read("db", "t", where="k in (7, 8) and a > 7").count() == 1 and reg.read("db", "t", where="k > 7").count() == 992


def test_aggregate_loads_merge(spark, reg):
    spec = ts.TableSpec("db", "agg", (ts.ColumnSpec("k", "INT", False), ts.ColumnSpec("n", "BIGINT", aggregate="sum"), ts.ColumnSpec("top", "DOUBLE", aggregate="max"), ts.ColumnSpec("uv", "HLL")), model="aggregate", keys=("k",), buckets=2)
    t = ts.KeyedTable.create(spark, f"{reg.root}/db/agg", spec)
    for i in (0, 1, 1):
        rows = spark.range(100 * i, 100 * i + 100).groupBy(F.lit(1).alias("k")).agg(F.count("*").alias("n"), F.max("id").alias("top"), F.hll_sketch_agg("id").alias("uv"))
        reg.apply("db", "agg", rows, query_id="q", batch_id=i)
    r = t.read().select("k", "n", "top", F.hll_sketch_estimate("uv").alias("uv")).first()
    assert (r["k"], r["n"], r["top"]) == (1, 200, 199.0) and abs(r["uv"] - 200) <= 10
    with pytest.raises(ValueError, match="aggregate"):
        bad = ts.KeyedTable.create(spark, f"{reg.root}/db/agg2", ts.TableSpec("db", "agg2", (ts.ColumnSpec("k", "INT"), ts.ColumnSpec("v", "INT")), model="aggregate", keys=("k",)))
        bad.load(spark.sql("select 1 k, 2 v"))


def test_stale_commits_are_told_apart(spark, reg):
    from tablesync.store.table import _safe

    assert len({_safe(x) for x in ("a.b", "a_b", "a-b", "ab", "a_2e_b")}) == 5
    t = make(reg)
    df = spark.sql("select 1 k, 1 a, 'x' b, 1 _seq")
    t.load(df, "_seq", query_id="foo", batch_id=1)
    t._files.mkdirs(t._commit_dir("0000000009-foo-1-0123abcd"))
    assert t.abort_stale("1") == [] and t.abort_stale("foo") == ["0000000009-foo-1-0123abcd"] and t.read().count() == 1


def test_duplicate_model_appends(spark, reg):
    spec = ts.TableSpec("db", "dup", (ts.ColumnSpec("c0", "INT"), ts.ColumnSpec("c1", "FLOAT"), ts.ColumnSpec("c2", "STRING", False)), model="duplicate")
    t = ts.KeyedTable.create(spark, f"{reg.root}/db/dup", spec)
    df = spark.createDataFrame([("abc", 1), ("def", 2)], "c2 string, c0 int")
    for i in (0, 0, 1):
        t.load(df, query_id="q", batch_id=i)
    assert sorted(map(tuple, t.read().collect())) == [(1, None, "abc")] * 2 + [(2, None, "def")] * 2
    with pytest.raises(ts.LoadRejected):
        t.load(df.withColumn("c2", F.lit(None).cast("string")))
    with pytest.raises(ValueError, match="no column"):
        t.load(df.withColumn("zz", F.lit(1)))
    t.compact()
    assert t.read().count() == 4


def test_aggregate_model(spark, reg):
    cols = (ts.ColumnSpec("page", "INT", False), ts.ColumnSpec("bitmap_bucket", "BIGINT", False), ts.ColumnSpec("bitmap", "BITMAP"))
    t = make(reg, "uv", cols, ("page", "bitmap_bucket"), model="aggregate")
    for i, data in enumerate([[(1, 13), (1, 23), (2, 23)], [(1, 13), (1, 33)]]):
        roll = ts.bitmap_rollup(spark.createDataFrame(data, "page int, u long"), ["page"], "u")
        for _ in range(2):
            t.merge_aggregate(roll, {"bitmap": F.bitmap_or_agg}, "q", i)
    assert sorted(map(tuple, ts.bitmap_ndv(t.read(), ["page"]).collect())) == [(1, 3), (2, 1)]


def test_schema_changes(spark, reg):
    cols = [ts.ColumnSpec("c0", "INT", False), ts.ColumnSpec("c1", "INT"), ts.ColumnSpec("c2", "INT"), ts.ColumnSpec("c3", "STRING")]
    t = make(reg, "ev", cols, ("c0",))
    t.load(spark.createDataFrame([(1, 2, 3, "x", 1)], "c0 int, c1 int, c2 int, c3 string, _seq int"), "_seq")
    reg.evolve("db", "ev", add=[ts.ColumnSpec("c4", "BIGINT"), ts.ColumnSpec("c5", "DECIMAL(20,1)", True, "1.5"), ts.ColumnSpec("c6", "DATETIME")])
    assert [str(x) for x in t.read().first()] == ["1", "2", "3", "x", "None", "1.5", "None"]
    reg.evolve("db", "ev", drop=["c2", "C3"])
    assert t.read().columns == ["c0", "c1", "c4", "c5", "c6"]
    reg.evolve("db", "ev", add=[ts.ColumnSpec("c3", "INT")])
    assert t.read().first()["c3"] is None  # a dropped column's values never come back
    t.load(spark.createDataFrame([(1, 9, 2)], "c0 int, c3 int, _seq int"), "_seq", mode="partial")
    assert [str(x) for x in t.read().first()] == ["1", "2", "None", "1.5", "None", "9"]
    with pytest.raises(ValueError, match="key column"):
        reg.evolve("db", "ev", drop=["c0"])


def test_registry(spark, reg):
    cols = [("c15", "INT"), ("c0", "BOOLEAN"), ("c1", "TINYINT"), ("c4", "BIGINT"), ("c5", "LARGEINT"), ("c8", "DECIMAL(23,5)"), ("c9", "CHAR(7)"), ("c10", "VARCHAR(109)"), ("c12", "DATE"), ("c13", "DATETIME"), ("c14", "JSON")]
    spec = ts.TableSpec("db", "all", tuple(ts.ColumnSpec(*c) for c in cols), keys=("c0", "c1"), props={"replication_num": "1"}, comment="all types")
    reg.create(spec)
    assert reg.databases() == ["db"] and reg.tables("db") == ["all"] and reg.exists("db", "all")
    d = {r["column_name"]: r for r in reg.describe("db", "all").collect()}
    assert [d["c0"]["position"], d["c1"]["position"], d["c15"]["position"]] == [1, 2, 3]
    assert (d["c8"]["type"], d["c8"]["size"], d["c8"]["digits"]) == ("DECIMAL", 23, 5)
    assert d["c0"]["key_position"] == 1 and not d["c0"]["nullable"] and d["c10"]["size"] == 109
    kept = reg.table("db", "all").spec
    assert kept.props == {"replication_num": "1"} and kept.comment == "all types"
    with pytest.raises(ValueError, match="exists"):
        reg.create(spec)
    reg.create(spec, if_not_exists=True)
    with pytest.raises(ValueError, match="exists"):
        reg.create_database("db")
    with pytest.raises(ValueError, match="no primary key"):
        reg.create(ts.TableSpec("db", "nokey", KV, model="duplicate"))
    with pytest.raises(ValueError, match="no database"):
        reg.tables("other")
    reg.drop("db", "all")
    assert reg.tables("db") == []
    with pytest.raises(ValueError, match="no table"):
        reg.drop("db", "all")
    reg.drop("db", "all", if_exists=True)


def test_registry_select_and_insert(spark, reg):
    reg.create(ts.TableSpec("db", "s", KV, keys=("k",), buckets=2, options={"source": {"scan.filter": "a > 1"}, "load": {"seq": "_seq"}}))
    reg.apply("db", "s", spark.createDataFrame([(1, 1, "x", 1), (2, 2, "y", 2)], "k int, a int, b string, _seq int"))
    assert [tuple(r) for r in reg.read("db", "s").collect()] == [(2, 2, "y")]
    assert [tuple(r) for r in reg.read("db", "s", columns=["b"], where="k = 1").collect()] == [("x",)]
    with pytest.raises(ValueError, match="does not fit"):
        reg.apply("db", "s", spark.createDataFrame([("1", 1)], "k string, _seq int"), declared_keys=["k"])
    with pytest.raises(ValueError, match="primary keys"):
        reg.apply("db", "s", spark.createDataFrame([(1, 1)], "k int, _seq int"), declared_keys=["a"])
    reg.apply("db", "s", reg.read("db", "s", where="true").withColumn("a", F.col("a") + 10).withColumn("_seq", F.col("k")))
    assert sorted(r["a"] for r in reg.read("db", "s", where="true").collect()) == [11, 12]


def test_spec_round_trip():
    s = ts.TableSpec("d", "t", KV, keys=("k",), options={"load": {"x": 1}})
    assert ts.TableSpec.from_dict(json.loads(json.dumps(s.to_dict()))) == s
    with pytest.raises(ValueError):
        ts.TableSpec("d", "t", KV)
    m = {"version": 0, "spec": s.to_dict(), "physical": {c.name: c.name for c in KV}, "used": ["k", "a", "b"], "born": {}, "live": {}, "ledger": {}}
    out = evolve_manifest(m, [ts.ColumnSpec("a", "STRING")], ["a"])
    assert out["physical"]["a"] == "a__1" and out["born"] == {"a": 1}


def test_key_conditions_of_other_types_scan(spark, reg):
    t = make(reg, "text_key", (ts.ColumnSpec("k", "STRING", False), ts.ColumnSpec("a", "INT")), buckets=8)
    t.load(spark.createDataFrame([("7", 1, 0), ("07", 2, 0), (" 7", 3, 0), ("8", 4, 0)], "k string, a int, _seq int"), "_seq")
    for where in ("k = 7", "k IN (7, 8)", "k = '7'", "k IN ('07', '8')", "k = '7' AND a = 1", "k IN (7, '8')"):
        assert sorted(reg.read("db", "text_key", where=where).collect()) == sorted(t.read().where(where).collect()), where
    n = make(reg, "number_key", (ts.ColumnSpec("k", "TINYINT", False), ts.ColumnSpec("a", "INT")), buckets=8)
    n.load(spark.createDataFrame([(7, 1, 0), (8, 2, 0)], "k int, a int, _seq int"), "_seq")
    for where in ("k = 7", "k = '7'", "k = ' 7'", "k IN (7, 300)", "k = 99999999999999999999"):
        assert sorted(reg.read("db", "number_key", where=where).collect()) == sorted(n.read().where(where).collect()), where


def test_loads_without_keys_become_one(spark, tmp_path):
    t = ts.KeyedTable.create(spark, str(tmp_path / "dup"), ts.TableSpec("db", "dup", (ts.ColumnSpec("a", "INT"), ts.ColumnSpec("b", "STRING")), model="duplicate"))
    load = lambda n: t.load(spark.createDataFrame([(n, "x"), (n, "x")], "a int, b string"), query_id="q", batch_id=n)
    rows = lambda: sorted(r.a for r in t.read().collect())
    for n in range(4):
        load(n)
    t.compact(5)
    assert len(t.manifest()["live"]) == 4
    t.compact(2)
    assert len(t.manifest()["live"]) == 1 and rows() == [0, 0, 1, 1, 2, 2, 3, 3] and t.finished("q", 3)
    t.evolve(add=[ts.ColumnSpec("c", "INT", True, "7")])
    load(4)
    t.compact(2)
    assert len(t.manifest()["live"]) == 2  # one load since is too few
    load(5)
    t.compact(2)
    assert len(t.manifest()["live"]) == 2 and rows() == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    t.compact()
    assert len(t.manifest()["live"]) == 1 and t.read().where("c = 7").count() == 12
    t.vacuum(keep=1)
    assert len(rows()) == 12
