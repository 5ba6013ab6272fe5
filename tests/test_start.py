import json

import pytest

import tablesync as ts
from tablesync.cdc.debezium import parse_debezium

from .test_streaming import ROW, SPEC, TARGETS, event, read, reg, text  # noqa: F401


def at(op, before, after, ts_ms, file="bin.000007", pos=0, **kw):
    return event(op, before, after, ts_ms, file=file, pos=pos, **kw)


def test_positions(spark):
    lines = [at("c", None, ROW(k, 1.0, "x"), ts_ms, f, p) for k, (ts_ms, f, p) in enumerate([(1, "bin.000009", 5), (2, "bin.000009", 6), (3, "bin.000010", 1), (4, "bin.1000000", 0), (5, "old", 9)])]
    events = parse_debezium(text(spark, lines))
    since = lambda p: sorted(r["_ts"] for r in p.since(events).collect())
    until = lambda p: sorted(r["_ts"] for r in p.until(events).collect())
    assert since(ts.Position(ts_ms=3)) == [3, 4, 5] and since(ts.Position(ts_ms=3, after=True)) == [4, 5] and until(ts.Position(ts_ms=3)) == [1, 2, 3]
    assert since(ts.Position(file="bin.000009", pos=6)) == [2, 3, 4, 5]  # an event without such a position stays
    assert since(ts.Position(file="bin.000009", pos=6, after=True)) == [3, 4, 5] and until(ts.Position(file="bin.000010", pos=1)) == [1, 2, 3]
    assert since(ts.Position(file="bin.999999")) == [4, 5]
    feed = spark.createDataFrame([("bin.000009",), ("bin.000010",), ("bin.1000000",), (None,), ("bin.000008",)], "file string")
    assert {r.file for r in ts.Position(file="bin.000010").skip(feed).collect()} == {"bin.000010", "bin.1000000", None}
    assert {r.file for r in ts.Position(file="bin.9").skip(spark.createDataFrame([("bin.9",), ("bin.10",), ("bin.0",)], "file string")).collect()} == {"bin.9", "bin.10"}
    for bad in ({}, {"ts_ms": 1, "file": "bin.1"}, {"file": "bin"}):
        with pytest.raises(ValueError):
            ts.Position(**bad)
    assert ts.Position.of("initial") is None and ts.Position.of({"ts_ms": 5}) == ts.Position(ts_ms=5)
    with pytest.raises(ValueError, match="latest"):
        ts.Position.of("latest")


def test_files_are_skipped_by_statistics(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(1000).selectExpr("'{}' AS value", "id AS ts_ms", "concat('bin.', lpad(cast(id div 100 AS string), 6, '0')) AS file").repartitionByRange(5, "ts_ms").write.parquet(path)
    for p, want in ((ts.Position(ts_ms=900), "GreaterThanOrEqual(ts_ms,900)"), (ts.Position(file="bin.000009"), "GreaterThanOrEqual(file,bin.000009)")):
        kept = p.skip(spark.read.parquet(path))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters" in plan and want in plan.replace("[", "").replace("Or(", "") and kept.count() == 100


def by_hand(snapshot, changes):
    out = {r["c0"]: (r["c0"], r["c1"], r["c2"]) for r in snapshot}
    for op, before, after in changes:
        if op == "d":
            out.pop(before["c0"], None)
        else:
            out[after["c0"]] = (after["c0"], after["c1"], after["c2"])
    return sorted(out.values())


def test_snapshot_meets_its_log(spark, reg, tmp_path):  # noqa: F811
    log = [
        ("c", None, ROW(1, 1.0, "wrong if read again"), 5), ("d", ROW(2, 0.0, "x"), None, 10),  # up to low: in the snapshot already
        ("u", ROW(1, 1.0, "a"), ROW(1, 2.0, "b"), 11), ("d", ROW(3, 0.0, "x"), None, 12), ("c", None, ROW(4, 4.0, "new"), 13), ("u", None, ROW(5, 1.0, "first"), 14),
        ("u", None, ROW(5, 2.0, "second"), 15), ("d", ROW(6, 1.0, "x"), None, 16), ("c", None, ROW(6, 6.0, "again"), 20),
        ("u", None, ROW(7, 7.5, "after"), 21), ("d", ROW(4, 4.0, "new"), None, 22),
    ]
    # 1 read before its change, 3 before its delete, 5 between its changes, 4 not yet there, 6 after it came back
    rows = [ROW(1, 1.0, "a"), ROW(3, 0.0, "x"), ROW(5, 1.0, "first"), ROW(6, 6.0, "again"), ROW(7, 7.0, "before"), ROW(8, 8.0, None)]
    feed = spark.createDataFrame([(at(o, b, a, t), t) for o, b, a, t in log], "value string, ts_ms bigint").repartition(3)
    feed.write.parquet(str(tmp_path / "in"))
    snapshot = {("src", "kv"): spark.createDataFrame([(r["c0"], r["c1"], r["c2"]) for r in rows], "c0 int, c1 float, C2 string")}
    specs, low, high = {("src", "kv"): SPEC}, {"ts_ms": 10}, {"ts_ms": 20}
    for _ in range(2):
        reports = ts.load_snapshot(reg, specs, snapshot, spark.read.parquet(str(tmp_path / "in")), low, high)
    assert reports["db.ods_kv"]["skipped"] and reg.table("db", "ods_kv").manifest()["version"] == 1
    assert read(reg) == by_hand(rows, [x[:3] for x in log if 10 < x[3] <= 20])
    stream = lambda: spark.readStream.schema(feed.schema).parquet(str(tmp_path / "in"))
    seen = []
    ts.sync_database(stream(), reg, specs, str(tmp_path / "ck"), start=ts.Position(ts_ms=20, after=True), on_report=seen.append).awaitTermination(120)
    assert seen[0][""]["total_events"] == 2 and read(reg) == by_hand(rows, [x[:3] for x in log if x[3] > 10])


def test_tables_without_a_snapshot_and_wrong_rows(spark, reg):  # noqa: F811
    specs = {("src", "kv"): SPEC}
    log = text(spark, [at("c", None, ROW(1, 1.0, "x"), 5), at("c", None, ROW(2, 1.0, "x"), 15), at("c", None, {"c0": "no number", "c1": 1.0, "c2": "x"}, 16)])
    with pytest.raises(ts.LoadRejected, match="INT of 'c0'"):
        ts.load_snapshot(reg, specs, {}, log, {"ts_ms": 10}, {"ts_ms": 20})
    report = ts.load_snapshot(reg, specs, {}, log, {"ts_ms": 10}, {"ts_ms": 20}, rejects=True)["db.ods_kv"]
    assert read(reg) == [(2, 1.0, "x")] and report["filtered_rows"] == 1


def test_start_inside_a_file(spark, reg, tmp_path):  # noqa: F811
    lines = [at("c", None, ROW(k, 1.0, "x"), 100 - k, f"bin.{6 + k // 4:06d}", k % 4) for k in range(12)]
    text(spark, lines).write.text(str(tmp_path / "in"))
    stream = spark.readStream.schema("value string").text(str(tmp_path / "in"))
    ts.sync_database(stream, reg, {("src", "kv"): SPEC}, str(tmp_path / "ck"), start={"file": "bin.000007", "pos": 2}).awaitTermination(120)
    assert [r[0] for r in read(reg)] == list(range(6, 12))


def test_files_of_a_log_follow_its_rows():
    from tablesync.queries.feed import log_files

    assert log_files(150) == 4 and log_files(9_000_000) == 45 and log_files(54_000_000) == 270
