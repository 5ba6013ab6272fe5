import json
import shutil

import pytest

import tablesync as ts
from tablesync.streaming.route import addressed

KV = (ts.ColumnSpec("k", "BIGINT", False), ts.ColumnSpec("v", "STRING"))


@pytest.fixture
def reg(spark, tmp_path):
    r = ts.Registry(spark, str(tmp_path / "reg"))
    r.ensure_tables([ts.TableSpec("db", "t", KV, keys=("k",), buckets=2)])
    return r


def feed(spark, path, part, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def read_stream(spark, path, schema, **options):
    return spark.readStream.schema(schema).options(**options).parquet(path)


SCHEMA = "k bigint, v string, _kind string, _seq bigint"


def test_stream_apply_exactly_once(spark, reg, tmp_path):
    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    feed(spark, src, 0, [(1, "a", "+I", 1), (2, "b", "+I", 2)], SCHEMA)
    feed(spark, src, 1, [(1, "c", "+U", 3), (2, "b", "-D", 4)], SCHEMA)
    t = reg.table("db", "t")
    run = lambda: ts.stream_apply(read_stream(spark, src, SCHEMA, **ts.admission(max_files=1)), t, ck, "_seq").awaitTermination(120)
    run()
    assert [tuple(r) for r in t.read().collect()] == [(1, "c")]
    version = t.manifest()["version"]
    assert version == 2  # one commit per micro-batch
    # a restored checkpoint that doesn't know of its last commit replays the batch, which is recorded already
    shutil.copytree(ck, str(tmp_path / "restored"), ignore=shutil.ignore_patterns("commits"))
    ts.stream_apply(read_stream(spark, src, SCHEMA, **ts.admission(max_files=1)), t, str(tmp_path / "restored"), "_seq").awaitTermination(120)
    assert t.manifest()["version"] == version
    feed(spark, src, 2, [(5, "z", "+I", 5)], SCHEMA)
    run()
    assert sorted(r["k"] for r in t.read().collect()) == [1, 5]
    ts.stream_apply(read_stream(spark, src, SCHEMA), t, str(tmp_path / "ck3"), "_seq", exactly_once=False).awaitTermination(120)
    assert t.manifest()["version"] == 4 and sorted(r["k"] for r in t.read().collect()) == [1, 5]


def test_two_streams_into_one_table(spark, reg, tmp_path):
    t = reg.table("db", "t")
    for i, name in enumerate("ab"):
        feed(spark, str(tmp_path / name), 0, [(i, name, "+I", 1)], SCHEMA)
        ts.stream_apply(read_stream(spark, str(tmp_path / name), SCHEMA), t, str(tmp_path / f"ck{name}"), "_seq").awaitTermination(120)
    assert sorted(tuple(r) for r in t.read().collect()) == [(0, "a"), (1, "b")]
    ts.stream_apply(read_stream(spark, str(tmp_path / "a"), SCHEMA), t, str(tmp_path / "ck1"), "_seq", query_id="mine").awaitTermination(120)
    with pytest.raises(Exception, match="id of another stream"):
        ts.stream_apply(read_stream(spark, str(tmp_path / "b"), SCHEMA), t, str(tmp_path / "ck2"), "_seq", query_id="mine").awaitTermination(120)


def test_later_file_wins_whatever_its_size(spark, reg, tmp_path):
    src = str(tmp_path / "src")
    row = "database string, table string, row string"
    reg.ensure_tables([ts.TableSpec("test", "tbl1", (ts.ColumnSpec("id", "INT", False), ts.ColumnSpec("name", "STRING"), ts.ColumnSpec("score", "INT")), keys=("id",), buckets=2)])
    old = [("test", "tbl1", '{"id": %d, "name": "old", "score": 1}' % k) for k in range(3)]
    new = [("test", "tbl1", '{"id": %d, "name": "new", "score": 2}' % k) for k in range(3000)]
    for rows in (old, new, old[:1]):
        spark.createDataFrame(rows, row).coalesce(1).write.mode("append").parquet(src)
    ts.route(read_stream(spark, src, row), reg, str(tmp_path / "ck"), {"*": {"format": "json"}}).awaitTermination(120)
    got = {r["id"]: r["name"] for r in reg.read("test", "tbl1").collect()}
    assert got[0] == "old" and got[1] == got[2] == got[2999] == "new"


def test_stream_merge_on_read(spark, reg, tmp_path):
    src = str(tmp_path / "src")
    for i in range(4):
        feed(spark, src, i, [(k, f"v{i}", "+U", i * 10 + k) for k in range(6)], SCHEMA)
    t = reg.table("db", "t")
    stream = read_stream(spark, src, SCHEMA, **ts.admission(max_files=1))
    ts.stream_apply(stream, t, str(tmp_path / "ck"), "_seq", merge_on_read=True, compact_every=3, compact_min_deltas=2, vacuum_every=4).awaitTermination(120)
    m = t.manifest()
    assert len(m["deltas"]) == 1 and len(t.versions()) == 2
    assert sorted(map(tuple, t.read().collect())) == [(k, "v3") for k in range(6)]


def test_noop_sink_and_listener(spark, reg, tmp_path):
    src = str(tmp_path / "src")
    feed(spark, src, 0, [(1, "a", "+I", 1), (2, None, "+I", 2)], SCHEMA)
    listener = ts.LoadListener()
    spark.streams.addListener(listener)
    try:
        ts.stream_apply(read_stream(spark, src, SCHEMA), None, str(tmp_path / "c1"), sink="noop").awaitTermination(120)
        t = reg.table("db", "t")
        q = ts.stream_apply(read_stream(spark, src, SCHEMA), t, str(tmp_path / "c2"), "_seq", report=listener.report)
        q.awaitTermination(120)
        for _ in range(50):
            if listener.counters["ended"] == 2:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    c = listener.counters
    assert c["rows"] == 4 and c["loaded"] == 2 and c["filtered"] == 0 and c["failed"] == 0 and c["started"] == 2
    assert listener.latencies(spark).count() == 2


def test_lookup_sees_later_dimension_files(spark, tmp_path):
    src, dim, out = (str(tmp_path / d) for d in ("src", "dim", "out"))
    feed(spark, dim, 0, [(1, "one")], "k bigint, name string")
    feed(spark, src, 0, [(1,), (2,)], "k bigint")
    write = lambda df, i: df.write.mode("append").parquet(out)
    run = lambda ttl: ts.stream_lookup_join(
        read_stream(spark, src, "k bigint"), lambda: spark.read.parquet(dim), ["k"], write, str(tmp_path / "ck"), "left", ttl_ms=ttl
    ).awaitTermination(120)
    run(0)
    feed(spark, dim, 1, [(2, "two")], "k bigint, name string")
    feed(spark, src, 1, [(2,)], "k bigint")
    run(0)
    assert sorted((r["k"], r["name"] or "") for r in spark.read.parquet(out).collect()) == [(1, "one"), (2, ""), (2, "two")]


def test_start_positions():
    assert ts.start_position("initial") == {"startingOffsets": "earliest"}
    assert ts.start_position("latest") == {"startingOffsets": "latest"}
    assert ts.start_position("timestamp", offset=5) == {"startingTimestamp": "5"}
    assert ts.start_position("offset", offset='{"t":{"0":7}}') == {"startingOffsets": '{"t":{"0":7}}'}
    assert ts.start_position("timestamp", "file", "2024-01-01T00:00:00") == {"modifiedAfter": "2024-01-01T00:00:00"}
    with pytest.raises(ValueError):
        ts.start_position("latest", "file")
    assert ts.admission(max_bytes=10) == {"maxBytesPerTrigger": "10"}


# -- route -----------------------------------------------------------------------------------------------------------

TBL1 = ts.TableSpec("test", "tbl1", (ts.ColumnSpec("id", "INT", False), ts.ColumnSpec("name", "STRING"), ts.ColumnSpec("score", "INT")), keys=("id",), buckets=2)
TBL2 = ts.TableSpec("test", "tbl2", (ts.ColumnSpec("order_id", "BIGINT", False), ts.ColumnSpec("order_state", "INT"), ts.ColumnSpec("total_price", "BIGINT")), keys=("order_id",), buckets=2)
RECORDS = [
    ("test", "tbl1", '{"id":1,"name":"json-one","score":100}'), ("test", "tbl1", '{"id":2,"name":"json-two"}'),
    ("test", "tbl2", '{"order_id":1,"order_state":1,"total_price":100}'), ("test", "tbl2", '{"order_id":2,"order_state":2}'),
    ("", "tbl2", "{}"), ("test", None, "{}"), ("test", "tbl1", None),
]
OPTIONS = {"*": {"format": "json"}, "test.tbl2": {"partial_update": "true", "columns": "`order_id`,`order_state`"}}


def test_route_batch(spark, reg):
    reg.ensure_tables([TBL1, TBL2])
    reg.apply("test", "tbl2", spark.createDataFrame([(2, 7, 70, 1)], "order_id bigint, order_state int, total_price bigint, _seq int"), seq="_seq")
    df = spark.createDataFrame(RECORDS, "database string, table string, row string")
    for _ in range(2):
        reports = ts.route_batch(df, reg, OPTIONS, batch_id=0)
    assert reports[""] == {"skipped_rows": 3, "total_rows": 7} and reports["test.tbl1"]["skipped"]
    read = lambda t: sorted(map(tuple, reg.read("test", t).collect()))
    assert read("tbl1") == [(1, "json-one", 100), (2, "json-two", None)]
    assert read("tbl2") == [(1, 1, None), (2, 2, 70)]


def test_route_array_payload_csv_and_delete(spark, reg):
    reg.ensure_tables([TBL1])
    df = spark.createDataFrame([("test", "tbl1", ["1|a|5|0", "2|b|6|0"]), ("test", "tbl1", ["1|||1"])], "database string, table string, row array<string>").coalesce(1)
    assert addressed(df)[0].count() == 3
    ts.route_batch(df, reg, {"test.tbl1": {"format": "csv", "column_separator": "|", "columns": "id,name,score,__op"}})
    assert [tuple(r) for r in reg.read("test", "tbl1").collect()] == [(2, "b", 6)]


def test_route_unknown_table_fails(spark, reg):
    df = spark.createDataFrame([("test", "nope", "{}")], "database string, table string, row string")
    with pytest.raises(ValueError, match="no table"):
        ts.route_batch(df, reg)


def test_route_stream(spark, reg, tmp_path):
    reg.ensure_tables([TBL1, TBL2])
    src = str(tmp_path / "src")
    schema = "database string, table string, row string"
    feed(spark, src, 0, RECORDS, schema)
    seen = []
    ts.route(read_stream(spark, src, schema), reg, str(tmp_path / "ck"), OPTIONS, on_report=seen.append).awaitTermination(120)
    assert len(seen) == 1 and reg.read("test", "tbl2").count() == 2


# -- change feed -----------------------------------------------------------------------------------------------------

def event(op, before=None, after=None, ts_ms=0, table="kv", db="src", **source):
    return json.dumps({"op": op, "before": before, "after": after, "ts_ms": ts_ms, "source": {"db": db, "table": table, "ts_ms": ts_ms, "file": "bin.1", "pos": 5, **source}})


def ddl(text, ts_ms, table="kv"):
    return json.dumps({"source": {"db": "src", "table": table, "ts_ms": ts_ms}, "historyRecord": json.dumps({"ddl": text})})


def text(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)


ROW = lambda c0, c1, c2: {"c0": c0, "c1": c1, "c2": c2}
SPEC = ts.TableSpec("db", "ods_kv", (ts.ColumnSpec("c0", "INT", False), ts.ColumnSpec("c1", "FLOAT"), ts.ColumnSpec("c2", "STRING")), keys=("c0",), buckets=2)
TARGETS = {("src", "kv"): ("db", "ods_kv")}


def read(reg, *cols):
    return sorted(map(tuple, reg.read("db", "ods_kv", columns=cols or None).collect()))


def test_feed_upsert_and_delete(spark, reg):
    reg.ensure_tables([SPEC])
    lines = [event("r", None, ROW(1, 1.0, "row1")), event("c", None, ROW(2, 2.0, "row2")), event("c", None, ROW(3, 3.0, "row3")), event("u", ROW(1, 1.0, "row1"), ROW(1, 2.0, "row1")), event("d", ROW(3, 3.0, "row3"))]
    r = ts.sync_batch(text(spark, lines + ["junk", event("x")]), reg, TARGETS)
    assert read(reg) == [(1, 2.0, "row1"), (2, 2.0, "row2")]
    assert r[""] == {"total_events": 7, "invalid_events": 2, "unlisted_events": 0}


def test_feed_without_usable_events(spark, reg):
    reg.ensure_tables([SPEC])
    for lines in (["junk"], [event("c", None, ROW(1, 1.0, "x"), table="other")]):
        r = ts.sync_batch(text(spark, lines), reg, TARGETS, schema_evolution=True)
        assert list(r) == [""] and r[""]["total_events"] == 1
    assert ts.sync_batch(spark.createDataFrame([], "value string"), reg, TARGETS)[""]["total_events"] == 0
    empty = spark.createDataFrame([(None, "t", "{}")], "database string, table string, row string")
    assert ts.route_batch(empty, reg) == {"": {"skipped_rows": 1, "total_rows": 1}}


@pytest.mark.parametrize("ignore,want", [(False, [(2, 2.0, "row2")]), (True, [(1, 1.0, "row1"), (2, 2.0, "row2")])])
def test_feed_key_change(spark, reg, ignore, want):
    reg.ensure_tables([SPEC])
    lines = [event("c", None, ROW(1, 1.0, "row1")), event("u", ROW(1, 1.0, "row1"), ROW(2, 2.0, "row2"))]
    ts.sync_batch(text(spark, lines), reg, TARGETS, ignore_update_before=ignore)
    assert read(reg) == want


def test_feed_schema_changes_inside_a_batch(spark, reg):
    reg.ensure_tables([SPEC])
    ts.sync_batch(text(spark, [event("c", None, ROW(9, 9.0, "old"), 1)]), reg, TARGETS, batch_id=0)
    lines = [
        event("c", None, ROW(1, 1.0, "before"), 2),
        ddl("/* tool */ ALTER TABLE kv DROP COLUMN `c2`", 3), ddl("alter table kv add column c2 varchar(10) not null", 4),
        ddl("ALTER TABLE kv ADD d1 DECIMAL(10, 2) default 1", 5), ddl("ALTER TABLE kv ADD INDEX idx (c1)", 5),
        ddl("ALTER TABLE kv ADD COLUMN gone INT, ADD COLUMN more INT", 5), ddl("ALTER TABLE kv DROP COLUMN gone", 6),
        ddl("CREATE TABLE kv2 (id int)", 6), ddl("ALTER TABLE kv ADD COLUMN shape GEOMETRY", 6), ddl("ALTER TABLE kv DROP COLUMN nothere", 6),
        event("c", None, {**ROW(2, 2.0, "after"), "d1": "1.25"}, 7),
    ]
    r = ts.sync_batch(text(spark, lines), reg, TARGETS, batch_id=1, schema_evolution=True)
    assert r["db.ods_kv"]["filtered_rows"] == 0
    got = reg.read("db", "ods_kv")
    assert got.columns == ["c0", "c1", "c2", "d1", "more"] and r["db.ods_kv"]["unknown_columns"] == ["shape GEOMETRY"]
    assert [c.type for c in reg.table("db", "ods_kv").spec.columns] == ["INT", "FLOAT", "VARCHAR(30)", "DECIMAL(10,2)", "INT"]
    assert [(r["c0"], r["c2"], str(r["d1"])) for r in got.orderBy("c0").collect()] == [(1, None, "None"), (2, "after", "1.25"), (9, None, "None")]
    # off by default
    ts.sync_batch(text(spark, [ddl("ALTER TABLE kv DROP COLUMN d1", 8)]), reg, TARGETS, batch_id=2)
    assert "d1" in reg.read("db", "ods_kv").columns


@pytest.mark.parametrize("text_of, want", [
    ("ALTER TABLE t ADD COLUMN a INT, ADD COLUMN b VARCHAR(10)", [("add", "a", "INT"), ("add", "b", "varchar(30)")]),
    ("alter table `my db`.`t x` add (a INT, b DECIMAL(10, 2) NOT NULL)", [("add", "a", "INT"), ("add", "b", "DECIMAL(10, 2)")]),
    ("ALTER TABLE t /* c, d */ DROP COLUMN `a b`, ADD u BIGINT UNSIGNED AFTER x, ADD INDEX i (a, b);", [("drop", "a b", None), ("add", "u", "BIGINT UNSIGNED")]),
    ("ALTER TABLE t ADD e ENUM('x','y') FIRST, RENAME TO z, ADD `key` INT", [("add", "e", "ENUM('x','y')"), ("add", "key", "INT")]),
    ("CREATE TABLE t (a INT)", []), ("ALTER TABLE t ADD PRIMARY KEY (a)", []),
])
def test_clauses(spark, text_of, want):
    got = ts.ddl_to_actions(spark.createDataFrame([(text_of,)], "ddl string")).orderBy("clause_no").collect()
    assert [(r["action"], r["column"], r["type"]) for r in got] == want


def test_types_of_added_columns():
    from pyspark.sql import Row

    from tablesync.cdc.ddl import column_of

    kind = lambda t: (c := column_of(Row(action="add", column="c", type=t))) and c.type
    assert [kind(t) for t in ("INT UNSIGNED", "BIGINT UNSIGNED", "ENUM('a','b')", "GEOMETRY", "DECIMAL(10, 2)")] == ["BIGINT", "LARGEINT", "STRING", None, "DECIMAL(10,2)"]


def test_feed_temporals(spark, reg):
    spec = ts.TableSpec("db", "tm", (ts.ColumnSpec("id", "INT", False), ts.ColumnSpec("d", "DATE"), ts.ColumnSpec("m", "DATETIME"), ts.ColumnSpec("u", "DATETIME"), ts.ColumnSpec("z", "DATETIME")), keys=("id",))
    reg.ensure_tables([spec])
    rows = [
        {"id": 1, "d": 19000, "m": 1700000000000, "u": 1700000000000001, "z": "2023-11-14T22:13:20Z"}, {"id": 2, "d": "2022-01-08", "m": None, "u": None, "z": 1700000000000000},
        {"id": 3, "d": 1700000000000, "m": 1, "u": 1, "z": None},
    ]
    at = {("db", "tm"): {"d": "date", "m": "datetime_ms", "u": "datetime", "z": "timestamp"}}
    lines = [event("c", None, r, table="tm") for r in rows] + [event("c", None, {"id": 1}, table="other")]
    r = ts.sync_batch(text(spark, lines), reg, {("src", "tm"): ("db", "tm")}, temporals=at, max_filter_ratio=0.5)
    assert r["db.tm"]["filtered_rows"] == 1 and r[""]["unlisted_events"] == 1
    got = {x["id"]: [str(v) for v in x[1:]] for x in reg.read("db", "tm").collect()}
    assert got[1] == ["2022-01-08", "2023-11-14 22:13:20", "2023-11-14 22:13:20.000001", "2023-11-15 06:13:20"]
    assert got[2] == ["2022-01-08", "None", "None", "2023-11-15 06:13:20"]
    # without encodings a number is rejected, never taken for a year
    r = ts.sync_batch(text(spark, lines[:1]), reg, {("src", "tm"): ("db", "tm")}, batch_id=1, query_id="plain", max_filter_ratio=1.0)
    assert r["db.tm"]["filtered_rows"] == 1


def test_feed_order_and_exact_numbers(spark, reg):
    spec = ts.TableSpec("db", "num", (ts.ColumnSpec("id", "BIGINT", False), ts.ColumnSpec("x", "DECIMAL(38,18)"), ts.ColumnSpec("n", "LARGEINT")), keys=("id",))
    reg.ensure_tables([spec])
    late, early = ('{"op":"c","after":{"id":1,"x":12345678901234567890.123456789012345678,"n":18446744073709551615},"ts_ms":9,"source":{"schema":"pub","db":"src","table":"num","ts_ms":9}}', '{"op":"c","after":{"id":1,"x":1,"n":1},"ts_ms":3,"source":{"schema":"pub","db":"src","table":"num","ts_ms":3}}')
    ts.sync_batch(text(spark, [late, early]), reg, {("pub", "num"): ("db", "num")})
    r = reg.read("db", "num").first()
    assert (str(r["x"]), r["n"]) == ("12345678901234567890.123456789012345678", "18446744073709551615")


def test_infer_specs_and_table_choice(spark):
    columns = spark.createDataFrame(
        [("src", t, c, p, ty, s, d, n, "note") for t in ("user", "user_bak", "log", "item") for c, p, ty, s, d, n in
         [("name", 2, "VARCHAR", 20, None, 1), ("id", 1, "INT UNSIGNED", 10, None, 0), ("price", 3, "DECIMAL", 12, 2, 1)]],
        "table_schema string, table_name string, column_name string, ordinal_position int, type_name string, column_size int, decimal_digits int, nullable int, remarks string",
    )
    keys = spark.createDataFrame([("src", t, "id", 1) for t in ("user", "user_bak", "item")], "table_schema string, table_name string, column_name string, key_seq int")
    specs = ts.infer_specs(columns, keys, "ods", include="user.*|log", exclude=".*_bak", prefix="p_", suffix="_s")
    assert list(specs) == [("src", "user")]  # log has no key, item does not match, user_bak is excluded
    s = specs[("src", "user")]
    assert (s.database, s.table, s.keys) == ("ods", "p_user_s", ("id",))
    assert [(c.name, c.type, c.nullable, c.comment) for c in s.columns] == [("id", "BIGINT", False, "note"), ("name", "VARCHAR(60)", True, "note"), ("price", "DECIMAL(12,2)", True, "note")]
    with pytest.raises(ValueError):
        ts.infer_specs(columns, keys, "ods", include="use")  # the whole name must match


def stream_id(checkpoint):
    return json.loads((checkpoint / "metadata").read_text())["id"]


def test_sync_database_stream(spark, tmp_path):
    reg = ts.Registry(spark, str(tmp_path / "reg2"))
    src = str(tmp_path / "feed")
    other = ts.TableSpec("db", "ods_b", SPEC.columns, keys=("c0",), buckets=2)
    specs = {("src", "kv"): SPEC, ("src", "b"): other}
    run = lambda: ts.sync_database(spark.readStream.schema("value string").text(src), reg, specs, str(tmp_path / "ck")).awaitTermination(120)
    text(spark, [event("c", None, ROW(1, 1.0, "x"), 1), event("c", None, ROW(1, 5.0, "y"), 1, table="b"), event("c", None, ROW(1, 5.0, "y"), 1, table="other")]).write.mode("append").text(src)
    run()
    text(spark, [event("d", ROW(1, 1.0, "x"), None, 2), event("c", None, ROW(2, 1.0, "z"), 3)]).write.mode("append").text(src)
    run()
    assert read(reg) == [(2, 1.0, "z")]
    assert [tuple(r) for r in reg.read("db", "ods_b").collect()] == [(1, 5.0, "y")]
    assert reg.table("db", "ods_kv").manifest()["ledger"] == {stream_id(tmp_path / "ck"): 1}


@pytest.mark.parametrize("text,want", [
    ("ALTER TABLE t ADD COLUMN a VARCHAR(5) DEFAULT '--', ADD COLUMN b INT", [("add", "a", "varchar(15)"), ("add", "b", "INT")]),
    ("ALTER TABLE t ADD COLUMN a INT COMMENT 'x, add c int'", [("add", "a", "INT")]),
    ("ALTER TABLE t ADD a INT DEFAULT (f(1, (2))), DROP b /* c, d */, ADD `x, y` ENUM('a)', 'b,')", [("add", "a", "INT"), ("drop", "b", None), ("add", "x, y", "ENUM('a)', 'b,')")]),
    ("ALTER TABLE t ADD (a INT COMMENT 'it''s, \\' fine', b DECIMAL(10,2)), DROP c # , DROP d", [("add", "a", "INT"), ("add", "b", "DECIMAL(10,2)"), ("drop", "c", None)]),
    ("ALTER/**/TABLE t ADD \"q\" INT COMMENT \"-- no, add z int\"-- DROP w\n, DROP v", [("add", "q", "INT"), ("drop", "v", None)]),
])
def test_quoted_texts_in_ddl(spark, text, want):
    got = ts.ddl_to_actions(spark.createDataFrame([(text,)], "ddl string")).orderBy("clause_no").collect()
    assert [(r["action"], r["column"], r["type"]) for r in got] == want
