"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert differences(df, con, SQL[name]) == []
    else:
        assert df.count() > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
