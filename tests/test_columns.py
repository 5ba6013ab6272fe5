"""Specs, types, validation, encoding, decoding, temporals, quality, redaction."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

import tablesync as ts
from tablesync.functions.encode import binary_to_bigint
from tablesync.operators.quality import counts
from tablesync.types import reported_type, source_type, source_type_column


def spec(*cols, keys=(), **kw):
    return ts.TableSpec("d", "t", tuple(ts.ColumnSpec(*c) for c in cols), keys=tuple(keys), model=kw.pop("model", "primary" if keys else "duplicate"), **kw)


# -- types, validation -----------------------------------------------------------------------------------------------

def test_validation(spark):
    schema = T.StructType.fromDDL("K1 tinyint, k2 string, v1 timestamp_ntz, v2 date, v3 decimal(10,2), v4 smallint, v5 string")
    good = spec(("k1", "TINYINT"), ("k2", "VARCHAR(16)"), ("v1", "DATETIME"), ("v2", "DATE"), ("v3", "DECIMAL(10,2)"), ("v4", "SMALLINT"), ("v5", "CHAR(2)"))
    ts.validate(schema, good)
    bad = spec(*[(f.name, "VARCHAR(16)") for f in schema.fields])
    with pytest.raises(ValueError, match="does not fit"):
        ts.validate(schema, bad)
    with pytest.raises(ValueError, match="no column"):
        ts.validate(T.StructType.fromDDL("zz int"), good)
    ts.validate(T.StructType.fromDDL("zz int"), good, mapped=True)
    keyed = spec(("id", "INT", False), ("doc", "JSON"), keys=["id"])
    ts.validate(T.StructType.fromDDL("id int, doc map<string,int>"), keyed, ["ID"])
    for keys in (None, ["doc"], ["id", "doc"]):
        with pytest.raises(ValueError, match="primary keys"):
            ts.validate(T.StructType.fromDDL("id int"), keyed, keys)


def test_alignment_and_column_list(spark):
    dup = spec(("a", "INT"), ("b", "STRING"))
    ordered, swapped = T.StructType.fromDDL("a int, B string"), T.StructType.fromDDL("b string, a int")
    assert ts.is_aligned(ordered, dup) and not ts.is_aligned(swapped, dup)
    assert ts.column_list(ordered, dup) is None
    assert ts.column_list(swapped, dup) == "`b`,`a`"
    keyed = spec(("a", "INT", False), ("b", "STRING"), keys=["a"])
    assert ts.column_list(ordered, keyed) == "`a`,`B`,`__op`"
    assert ts.column_list(ordered, keyed, "json") is None
    assert ts.column_list(ordered, keyed, "json", auto_json=False) == "`a`,`B`,`__op`"


def test_reported_types():
    assert reported_type("tinyint") == T.BooleanType()
    assert reported_type("tinyint", 4) == T.ByteType()
    assert reported_type("largeint") == T.StringType()
    assert reported_type("decimal", 10, 2) == T.DecimalType(10, 2)
    assert reported_type("varchar", 5) == T.VarcharType(5)
    for bad in (("decimal", None, None), ("varchar", None, None), ("bitmap", None, None), ("percentile", None, None)):
        with pytest.raises(ValueError):
            reported_type(*bad)
    assert ts.table_type(T.VarcharType(2000000)) == "VARCHAR(1048576)"


SOURCE = [
    ("bit", 1, None, "BOOLEAN"), ("TINYINT UNSIGNED", 3, None, "SMALLINT"), ("SMALLINT UNSIGNED ZEROFILL", 5, None, "INT"),
    ("MEDIUMINT", 7, None, "INT"), ("INT UNSIGNED", 10, None, "BIGINT"), ("BIGINT UNSIGNED", 20, None, "LARGEINT"),
    ("DECIMAL", 10, 2, "DECIMAL(10,2)"), ("NUMERIC UNSIGNED", 38, None, "DECIMAL(38,0)"), ("DECIMAL", 60, 2, "STRING"),
    ("VARCHAR", 20, None, "VARCHAR(60)"), ("VARCHAR", 30000, None, "STRING"), ("CHAR", 3, None, "CHAR(3)"),
    ("YEAR", None, None, "INT"), ("TIME", None, None, "STRING"), ("JSON", None, None, "JSON"), ("ENUM", 5, None, "STRING"),
    ("DOUBLE PRECISION UNSIGNED", 22, None, "DOUBLE"), ("TIMESTAMP", 19, None, "DATETIME"),
]


def test_source_types(spark):
    for name, size, scale, want in SOURCE:
        assert source_type(name, size, scale) == want
    df = spark.createDataFrame(SOURCE, "n string, s int, d int, want string")
    got = df.select("want", source_type_column(F.col("n"), F.col("s"), F.col("d")).alias("got"))
    assert got.where("want <> got or got is null").count() == 0
    for bad in ("SERIAL", "GEOMETRY", "CHAR"):
        with pytest.raises(ValueError):
            source_type(bad)
        with pytest.raises(Exception):
            spark.createDataFrame([(bad, None, None)], "n string, s int, d int").select(source_type_column(F.col("n"), F.col("s"), F.col("d"))).collect()


# -- mapping, sketches -----------------------------------------------------------------------------------------------

def test_column_mapping(spark, rows):
    df = spark.createDataFrame([(1, "x,y")], "p int, q string")
    out = ts.map_columns(df, "`a`, b, c=concat(b, ',', 'z'), d = a + 1")
    assert out.columns == ["a", "b", "c", "d"] and rows(out) == [(1, "x,y", "x,y,z", 2)]
    with pytest.raises(ValueError):
        ts.map_columns(df, "a")
    assert ts.sketch_columns("page_id,visit_date,visit_user_id,visit_users=to_bitmap(visit_user_id)") == {"visit_users": ("bitmap", "visit_user_id")}


VISITS = [(1, "2020-06-23 01:30:30", 13), (1, "2020-06-23 01:30:30", 23), (1, "2020-06-23 01:30:30", 33), (1, "2020-06-23 02:30:30", 13), (2, "2020-06-23 01:30:30", 23)]


def test_bitmap_and_hll(spark, rows):
    df = spark.createDataFrame(VISITS, "page_id int, visit_date string, visit_user_id int")
    keys = ["page_id", "visit_date"]
    whole = ts.bitmap_rollup(df, keys, "visit_user_id")
    halves = ts.bitmap_merge(ts.bitmap_rollup(df.limit(2), keys, "visit_user_id"), whole, keys)
    for r in (whole, halves):
        assert rows(ts.bitmap_ndv(r, ["page_id"])) == [(1, 3), (2, 1)]
    h = ts.hll_merge(ts.hll_rollup(df, keys, "visit_user_id"), ts.hll_rollup(df, keys, "visit_user_id"), keys)
    assert rows(ts.hll_ndv(h, ["page_id"])) == [(1, 3), (2, 1)]
    with pytest.raises(Exception, match="negative"):
        ts.bitmap_rollup(spark.createDataFrame([(1, -5)], "k int, v int"), ["k"], "v").collect()
    wide = spark.range(100000).selectExpr("id % 2 k", "id * 7 v")
    assert rows(ts.bitmap_ndv(ts.bitmap_rollup(wide, ["k"], "v"), ["k"])) == [(0, 50000), (1, 50000)]


# -- encoding --------------------------------------------------------------------------------------------------------

def test_delimiter():
    assert ts.parse_delimiter(None, "\t") == "\t" and ts.parse_delimiter("", ",") == ","
    assert ts.parse_delimiter("|", ",") == "|"
    assert ts.parse_delimiter("\\x01", ",") == "\x01" and ts.parse_delimiter("\\X0a0D", ",") == "\n\r"
    for bad, why in (("\\x", "empty"), ("\\x1", "odd"), ("\\xzz", "not hex")):
        with pytest.raises(ValueError, match=why):
            ts.parse_delimiter(bad, ",")


def test_encode_rows(spark):
    df = spark.sql("select 1 a, true b, date'2024-01-02' d, timestamp_ntz'2024-01-01 10:00:00' t, 1.10bd x, cast(null as int) z, 'p\"q' s, map(1, date'2024-01-02') m, 1 __op")
    text = ts.encode_json(df, with_op=True).first()[0]
    assert json.loads(text) == {"a": 1, "b": 1, "d": "2024-01-02", "t": "2024-01-01T10:00:00.000000", "x": 1.1, "s": 'p"q', "m": {"1": "2024-01-02"}, "__op": 1}
    assert "__op" not in ts.encode_json(df).first()[0]
    csv = ts.encode_csv(df.drop("__op"), "\\x01").first()[0]
    assert csv.split("\x01") == ["1", "1", "2024-01-02", "2024-01-01T10:00:00.000000", "1.10", "\\N", 'p"q', '{"1":"2024-01-02"}']
    with pytest.raises(Exception, match="separator"):
        ts.encode_csv(spark.createDataFrame([("a\tb",)], "s string"), fail_on_separator=True).collect()


def test_binary(spark):
    data = [(bytearray([1, 0]), 256), (bytearray([255] * 8), -1), (bytearray([]), 0), (bytearray([1] * 9), None), (None, None)]
    df = spark.createDataFrame(data, "b binary, want long")
    assert df.where(~binary_to_bigint(F.col("b")).eqNullSafe(F.col("want"))).count() == 0


def test_json_promotion(spark):
    df = spark.createDataFrame([(1, 1.0, '{"a": 1, "b": true}'), (2, 2.0, '{"a": 2, "b": false}'), (3, 3.0, "")], "c0 int, c1 double, c2 string")
    t = spec(("c0", "INT", False), ("c1", "DOUBLE"), ("c2", "JSON"), keys=["c0"])
    got = [json.loads(r[0]) for r in ts.encode_json(df, t).collect()]
    assert [g["c2"] for g in got] == [{"a": 1, "b": True}, {"a": 2, "b": False}, ""]
    plain = spec(("c0", "INT", False), ("c1", "DOUBLE"), ("c2", "STRING"), keys=["c0"])
    assert [json.loads(r[0])["c2"] for r in ts.encode_json(df, plain).collect()] == ['{"a": 1, "b": true}', '{"a": 2, "b": false}', ""]


def test_nested_to_load(spark):
    df = spark.sql(
        "select named_struct('id', 1, 'd', date'2024-03-27') r, named_struct('id', 1) rs, array(named_struct('p', 1, 'q', date'2024-01-02')) ar, "
        "array(array(date'2024-01-02')) aa, map(date'2024-01-02', array(date'2024-01-03')) m, array(map(1, 2)) am"
    )
    t = spec(("r", "JSON"), ("rs", "STRING"), ("ar", "ARRAY<STRING>"), ("aa", "ARRAY<ARRAY<STRING>>"), ("m", "MAP<STRING,ARRAY<STRING>>"), ("am", "ARRAY<MAP<STRING,INT>>"))
    r = ts.nested_to_load(df, t).first()
    assert r["r"].asDict() == {"id": 1, "d": "2024-03-27"}
    assert r["rs"] == '{"id":1}'
    assert r["ar"] == ['{"p":1,"q":"2024-01-02"}']
    assert r["aa"] == [["2024-01-02"]]
    assert r["m"] == {"2024-01-02": ["2024-01-03"]}
    assert r["am"] == [{"1": 2}]


# -- decoding --------------------------------------------------------------------------------------------------------

SCORES = T.StructType().add("id", "integer").add("name", "string").add("score", "integer")


def test_decode_csv(spark, rows):
    df = spark.createDataFrame([("1\tcsv-one\t100",), ("2\tcsv-two\t\\N",)], "value string")
    assert rows(ts.decode(df, SCORES, "csv")) == [(1, "csv-one", 100), (2, "csv-two", None)]
    pipe = spark.createDataFrame([("1|x",)], "value string")
    out = ts.decode(pipe, T.StructType.fromDDL("a int, b string, c string"), "csv", {"column_separator": "|", "columns": "a,b,c=upper(b)"})
    assert rows(out) == [(1, "x", "X")]
    with pytest.raises(Exception, match="expected 3 fields"):
        ts.decode(pipe, SCORES, "csv", {"column_separator": "|"}).collect()
    assert rows(ts.decode(spark.createDataFrame([("x\ty\tz",)], "value string"), SCORES, "csv", mode="null")) == [(None, "y", None)]


def test_decode_json(spark, rows):
    df = spark.createDataFrame([('[{"id":1,"name":"a","score":100},{"id":2,"name":"b"}]',), ('{"id":3}',)], "value string")
    assert rows(ts.decode(df, SCORES, "json")) == [(1, "a", 100), (2, "b", None), (3, None, None)]
    with pytest.raises(Exception, match="not readable"):
        ts.decode(df, SCORES, "json", {"strip_outer_array": "false"}).collect()
    big = spark.createDataFrame([('{"v": 12345678901234567890.123456789012345678}',)], "value string")
    assert rows(ts.decode(big, T.StructType.fromDDL("v decimal(38,18)"), "json")) == [(Decimal("12345678901234567890.123456789012345678"),)]


def test_round_trip_text_files(spark, rows, tmp_path):
    df = spark.range(100).selectExpr("cast(id as int) id", "concat('n', id) name", "if(id % 2 = 0, cast(id as int), null) score")
    for fmt, encode, sep in (("csv", lambda d: ts.encode_csv(d), "\\x02"), ("json", ts.encode_json, "\n")):
        sep = ts.parse_delimiter(sep, "\n")
        path = str(tmp_path / fmt)
        ts.write_text(encode(df), path, fmt, row_delimiter=sep, compression="lz4")
        back = ts.decode(spark.read.option("lineSep", sep).text(path), SCORES, fmt)
        assert rows(back) == rows(df)
    ts.write_text(ts.encode_json(df), str(tmp_path / "arr"), "json", as_array=True)
    text = spark.read.text(str(tmp_path / "arr"))
    assert text.count() < 100 and rows(ts.decode(text, SCORES, "json")) == rows(df)


def test_chunk_framing(spark):
    df = spark.createDataFrame([(f"r{i:03d}",) for i in range(10)], "value string").coalesce(1)
    csv = ts.frame_chunks(df, "csv", row_delimiter="|", max_bytes=20).collect()
    assert all(r["payload"].endswith("|") and r["n_rows"] <= 4 for r in csv)
    assert "".join(r["payload"] for r in csv) == "".join(f"r{i:03d}|" for i in range(10))
    whole = ts.frame_chunks(spark.createDataFrame([('{"a":1}',), ('{"a":2}',)], "value string").coalesce(1), "json").collect()
    assert [r["payload"] for r in whole] == ['[{"a":1},{"a":2}]']


def test_custom_records(spark, rows):
    def build(batches):
        for b in batches:
            yield b.assign(double=b["id"] * 2)[["id", "double"]]

    assert rows(ts.map_records(spark.range(3), build, "id long, double long")) == [(0, 0), (1, 2), (2, 4)]
    addressed = ts.address_records(spark.range(1), "db", "t", F.to_json(F.struct("id")))
    assert rows(addressed) == [("db", "t", '{"id":0}')]


# -- quality ---------------------------------------------------------------------------------------------------------

def test_not_null(spark, rows):
    t = spec(("c0", "INT"), ("c1", "FLOAT"), ("c2", "STRING", False))
    df = spark.createDataFrame([(1, 10.1, None), (2, 20.2, None), (3, 1.5, "x")], "c0 int, c1 double, c2 string")
    good, bad = ts.split_valid(df, t)
    assert rows(good) == [(3, 1.5, "x")]
    assert {r["_reasons"] for r in bad.collect()} == {"NULL value in non-nullable column 'c2'"}
    r = counts(ts.check_rows(df, t)).first()
    assert tuple(r) == (3, 1, 2)
    with pytest.raises(ts.LoadRejected):
        ts.gate(r["total_rows"], r["filtered_rows"])
    ts.gate(r["total_rows"], r["filtered_rows"], 0.7)
    ts.gate(0, 0)


def test_strict_and_lenient(spark, rows):
    t = spec(("a", "TINYINT"), ("b", "VARCHAR(2)"), ("c", "LARGEINT"))
    big = "170141183460469231731687303715884105727"
    df = spark.createDataFrame([("1", "xx", big), ("300", "xx", "1"), ("2", "xxx", "-" + big)], "a string, b string, c string")
    good, bad = ts.split_valid(df, t)
    assert rows(good) == [(1, "xx", big)] and bad.count() == 2
    good, bad = ts.split_valid(df, t, strict=False)
    assert bad.count() == 0 and rows(good) == sorted([(1, "xx", big), (None, "xx", "1"), (2, None, "-" + big)], key=lambda x: [(y is None, str(y)) for y in x])


def test_load_report(spark):
    t = spec(("a", "TINYINT", False),)
    df = spark.createDataFrame([("1",), ("300",), (None,), ("77",)], "a string")
    r = ts.load_report(df, t, "a is null or a <> '77'").first()
    assert tuple(r) == (4, 1, 2, 1, 1)


def test_conform(spark, rows):
    df = spark.createDataFrame([(1, "2024-09-19 14:03:00.123456789"), (2, "2024-09-19 14:00:00"), (3, None)], "c0 int, c1 string")
    got = ts.conform(df, T.StructType.fromDDL("c0 int, c1 timestamp_ntz"))
    assert rows(got) == [(1, dt.datetime(2024, 9, 19, 14, 3, 0, 123456)), (2, dt.datetime(2024, 9, 19, 14, 0)), (3, None)]
    with pytest.raises(Exception, match="non-nullable"):
        ts.conform(df, T.StructType([T.StructField("c1", T.StringType(), False)])).collect()
    with pytest.raises(Exception, match="cannot take"):
        ts.conform(df, T.StructType.fromDDL("c1 date")).collect()
        ts.conform(spark.createDataFrame([("x",)], "c1 string"), T.StructType.fromDDL("c1 date")).collect()
    with pytest.raises(ValueError, match="declared"):
        ts.conform(df, T.StructType.fromDDL("c0 date"))
    assert rows(ts.conform(spark.createDataFrame([("x",)], "c1 string"), T.StructType.fromDDL("c1 date"), mode="null")) == [(None,)]


def test_temporals(spark):
    df = spark.sql("select 1 d, timestamp_ntz'2024-01-01 10:00:00.5' n, '2024-01-01T00:00:00Z' s, 3723000000L tm, 1704067200000000L u")
    kinds = {"d": "date", "n": "datetime", "s": "timestamp", "tm": "time", "u": "timestamp"}
    want = ("1970-01-02", "2024-01-01 10:00:00", "2024-01-01 08:00:00.000000", "01:02:03", "2024-01-01 08:00:00.000000")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert tuple(ts.format_temporals(df, kinds).first()) == want
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    edge = spark.sql("select timestamp_ntz'2024-03-10 02:30:00' n, 1730611800000000L a, 1730615400000000L b, cast(null as bigint) z")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # clocks change at these times
    try:
        got = ts.format_temporals(edge, {"n": "datetime", "a": "timestamp", "b": "timestamp", "z": "timestamp"}, zone="UTC").first()
        assert tuple(got) == ("2024-03-10 02:30:00", "2024-11-03 05:30:00.000000", "2024-11-03 06:30:00.000000", None)
        assert '"n":"2024-03-10T02:30:00.000000"' in ts.encode_json(edge).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    other = ts.format_temporals(df, kinds, {"date": "dd/MM/yyyy"}, zone="Europe/Paris").first()
    assert (other["d"], other["u"]) == ("02/01/1970", "2024-01-01 01:00:00.000000")


FIXED = "Data validation errors detected. Row data has been redacted for security."


@pytest.mark.parametrize("text,want", [
    ("E: Value '42' is too big. Row: [1, 'secret']\nNext line.", "E: column value is too big. \nNext line."),
    ("A: Value ''x'' bad\r\nB: Value \"y\" bad\rC: Value 'z' bad", "A: column value bad\nB: column value bad\nC: column value bad"),
    ("mid Row: {\"k\":\"v\"} more\n\n\nlast", "mid \nlast"),
    ("Row: [1, 'a']", FIXED), ("Row: {\"p\":\".*[]{}\"}", FIXED),
    ("", ""), ("   ", "   "), (None, None), ("Connection timeout\nOther error", "Connection timeout\nOther error"),
])
def test_redact(spark, text, want):
    assert ts.redact(spark.createDataFrame([(text,)], "m string"), "m").first()[0] == want
