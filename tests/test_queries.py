"""Every registered query runs at the smallest scale; those with SQL must agree with it."""

import pytest
from compare import compare, oracle

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert compare(df, con, SQL[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 1
