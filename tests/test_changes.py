import random

import pytest
from pyspark.sql import functions as F

import tablesync as ts
from tablesync.plans import shuffles
from .replay import COLS, random_log, replay

SCHEMA = "k int, a int, b string, _kind string, has_a boolean, has_b boolean, _seq int"


def changes_df(spark, log, rng, start=0):
    data = [
        (r["k"], r["a"], r["b"], r["kind"], "a" in r["has"], "b" in r["has"], start + i) for i, r in enumerate(log)
    ]
    rng.shuffle(data)
    return spark.createDataFrame(data, SCHEMA)


def state_of(df):
    return {r["k"]: {c: r[c] for c in COLS} for r in df.collect()}


def table_df(spark, state):
    return spark.createDataFrame([(k, v["a"], v["b"]) for k, v in state.items()], "k int, a int, b string")


MODES = [
    ("full", {}),
    ("full", {"ignore_update_before": False}),
    ("partial", {"columns": ["k", "b"]}),
    ("partial", {"flags": True}),
    ("conditional", {"merge_condition": "a"}),
]


@pytest.mark.parametrize("mode,opts", MODES)
@pytest.mark.parametrize("strategy", ["outer", "split"])
def test_random_logs_equal_replay(spark, mode, opts, strategy):
    for seed in range(3):
        rng = random.Random(seed * 7 + len(mode))
        start = {k: {"a": rng.choice([None, 1, 3]), "b": "t"} for k in range(0, 14, 2)}
        log = random_log(rng)
        columns = ["b"] if "columns" in opts else list(COLS)
        if not opts.get("flags"):
            for r in log:
                r["has"] = set(columns)
        want = replay(
            start, log, mode, columns, opts.get("merge_condition"), opts.get("ignore_update_before", True)
        )
        args = {k: v for k, v in opts.items() if k != "flags"}
        if opts.get("flags"):
            args.update(columns=["a", "b"], present={"a": F.col("has_a"), "b": F.col("has_b")})
        target = table_df(spark, start)
        cuts = [(0, len(log))] if seed else [(0, 23), (23, 24), (24, len(log))]
        for lo, hi in cuts:
            part = changes_df(spark, log[lo:hi], rng, lo)
            target = ts.apply_changes(
                target, part, ["k"], "_seq", mode="full" if mode == "conditional" else mode, strategy=strategy, **args
            )
        assert state_of(target) == want


def test_upsert_and_delete(spark, rows):
    log = [(1, 1.0, "row1", "+I", 1), (2, 2.0, "row2", "+I", 2), (1, 3.0, "row3", "+U", 3), (3, 3.0, "row3", "+U", 4), (2, 2.0, "row2", "-D", 5)]
    df = spark.createDataFrame(log, "c0 int, c1 float, c2 string, _kind string, _seq int")
    out = ts.apply_changes(None, df, ["c0"], "_seq")
    assert out.columns == ["c0", "c1", "c2"]
    assert rows(out) == [(1, 3.0, "row3"), (3, 3.0, "row3")]


def test_partial_update_with_delete(spark, rows):
    target = spark.createDataFrame([(1, 1.0, "1"), (2, 2.0, "2")], "c0 int, c1 float, c2 string")
    log = spark.createDataFrame([("1", 1, "-D", 1), ("22", 2, "+U", 2), ("3", 3, "+I", 3)], "c2 string, c0 int, _kind string, _seq int")
    out = ts.apply_changes(target, log, ["c0"], "_seq", mode="partial", columns=["c0", "c2"])
    assert rows(out) == [(2, 2.0, "22"), (3, None, "3")]


def test_partial_and_conditional_on_scores(spark, rows):
    target = spark.createDataFrame([(1, "one", 100), (2, "two", 100)], "id int, name string, score int")
    names = spark.createDataFrame([(1, "one-new", 1), (2, "two-new", 2)], "id int, name string, _seq int")
    out = ts.apply_changes(target, names, ["id"], "_seq", mode="partial", columns=["id", "name"])
    assert rows(out) == [(1, "one-new", 100), (2, "two-new", 100)]
    scored = spark.createDataFrame([(1, "one-new", 99, 1), (2, "two-new", 101, 2)], "id int, name string, score int, _seq int")
    out = ts.apply_changes(target, scored, ["id"], "_seq", merge_condition="score")
    assert rows(out) == [(1, "one", 100), (2, "two-new", 101)]


def test_full_load_with_missing_column_sets_null(spark, rows):
    target = spark.createDataFrame([(1, 5.0, "x")], "c0 int, c1 float, c2 string")
    df = spark.createDataFrame([("abc", 1, 1), ("def", 2, 2)], "c2 string, c0 int, _seq int")
    assert rows(ts.apply_changes(target, df, ["c0"], "_seq")) == [(1, None, "abc"), (2, None, "def")]


def test_key_change(spark, rows):
    row = "struct<c0: int, c1: float, c2: string>"
    events = spark.createDataFrame(
        [("c", None, (1, 1.0, "row1"), 1), ("u", (1, 1.0, "row1"), (2, 2.0, "row2"), 2)],
        f"op string, before {row}, after {row}, seq int",
    )
    for ignore, want in ((False, [(2, 2.0, "row2")]), (True, [(1, 1.0, "row1"), (2, 2.0, "row2")])):
        load = ts.expand_updates(events, "before", "after", F.col("op"), ignore).select("_row.*", "__op", "seq", "_sub")
        assert rows(ts.apply_changes(None, load, ["c0"], ["seq", "_sub"])) == want


def test_kind_filter_and_op(spark, rows):
    df = spark.createDataFrame([("+I",), ("-U",), ("+U",), ("-D",)], "_kind string")
    kinds = lambda **kw: sorted(r[0] for r in ts.filter_kinds(df, **kw).collect())
    assert kinds(has_pk=True) == ["+I", "+U", "-D"]
    assert kinds(has_pk=True, ignore_update_before=False) == ["+I", "+U", "-D", "-U"]
    assert kinds(has_pk=False, ignore_update_before=False) == ["+I", "+U"]
    assert rows(ts.to_op(df)) == [("+I", 0), ("+U", 0), ("-D", 1), ("-U", 1)]
    with pytest.raises(Exception, match="unknown row kind"):
        ts.to_op(spark.createDataFrame([("?",)], "_kind string")).collect()


def test_unique_model_keeps_rows_on_delete(spark, rows):
    df = spark.createDataFrame([(1, "x", "+I", 1), (1, "y", "+U", 2), (1, "y", "-D", 3)], "k int, v string, _kind string, _seq int")
    assert rows(ts.apply_changes(None, df, ["k"], "_seq", model="unique")) == [(1, "y")]


def test_append_by_name(spark, rows):
    target = spark.createDataFrame([], "c0 int, c1 float, c2 string")
    df = spark.createDataFrame([("abc", 1), ("def", 2)], "C2 string, c0 int")
    assert rows(ts.append(target, df)) == [(1, None, "abc"), (2, None, "def")]
    with pytest.raises(ValueError, match="no column"):
        ts.append(target, spark.createDataFrame([(1,)], "zz int"))


def test_null_key_is_an_error(spark):
    df = spark.createDataFrame([(None, "x", 1)], "k int, v string, _seq int")
    with pytest.raises(Exception, match="primary key"):
        ts.apply_changes(None, df, ["k"], "_seq").collect()


def test_plan_shuffles_changes_once(spark):
    """Full and partial folds: one exchange for the changes (after map-side combine), one for the target."""
    target = spark.range(1000).selectExpr("id k", "id a", "'x' b")
    log = spark.range(1000).selectExpr("id % 7 k", "id a", "'y' b", "id _seq")
    for mode, cols in (("full", None), ("partial", ["k", "b"])):
        df = ts.apply_changes(target, log, ["k"], "_seq", mode=mode, columns=cols)
        assert len(shuffles(df)) <= 2
        assert "partial_max_by" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_key(spark):
    """A third of all rows on one key, every mode."""
    log = spark.range(30000).selectExpr("if(id % 3 = 0, 0, id % 5000) k", "id % 997 a", "cast(id as string) b", "id _seq", "if(id % 11 = 0, '-D', '+U') _kind")
    last = {r["k"]: r for r in log.groupBy("k").agg(F.max("_seq").alias("s")).collect()}
    full = ts.apply_changes(None, log, ["k"], "_seq")
    want = sum(1 for r in last.values() if r["s"] % 11)
    assert full.count() == want
    cond = ts.apply_changes(None, log, ["k"], "_seq", merge_condition="a")
    assert cond.count() == want
    hot = log.where("k = 0").orderBy("_seq").collect()
    best = None
    for r in hot:
        best = None if r["_kind"] == "-D" else (r if best is None or r["a"] >= best["a"] else best)
    got = cond.where("k = 0").collect()
    assert [(r["a"], r["b"]) for r in got] == ([(best["a"], best["b"])] if best else [])
