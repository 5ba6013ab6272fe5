"""Every operator query against its SQL on the smallest given tables."""

import os

import pytest

from tablesync.llm.queries import QUERIES

from ..compare import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    fn, sql = QUERIES[name]
    assert difference(spark, con, SF, fn, sql) is None
