"""Every query that SQL can express, against DuckDB on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
