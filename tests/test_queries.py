"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry_points
from tablesync import queries as library
from .compare import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = library.queries(), library.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, SF, QUERIES[name], SQL.get(name)) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_only_inexact_queries_lack_sql():
    assert set(QUERIES) - set(SQL) == {"hll_uv"}


def test_hll_is_close(spark, con):
    got = {r["event_type"]: r["ndv"] for r in QUERIES["hll_uv"](spark, SF).collect()}
    want = dict(con.execute("SELECT event_type, count(DISTINCT event_id) FROM events GROUP BY event_type").fetchall())
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= max(2, 0.05 * want[k]) for k in want)

