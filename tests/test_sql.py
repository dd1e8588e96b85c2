"""Every query with SQL gives the rows and types that an independent engine gives."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    expected = con.sql(SQL[name]).to_arrow_table()
    actual = QUERIES[name](spark, sf_dir).toArrow()
    assert actual.num_rows > 0
    assert differences(expected, actual) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
