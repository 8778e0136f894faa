"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import connect, difference

import __spark_entry__ as entry
from pagesift.plans.queries import ORACLES, QUERIES

SQL = ORACLES


@pytest.fixture(scope="module")
def tables(testdata):
    return connect(f"{testdata}/sf0.001")


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, testdata, tables, name):
    assert difference(QUERIES[name](spark, f"{testdata}/sf0.001"), tables, SQL[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
