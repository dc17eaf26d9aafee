"""Every registered query against its SQL on DuckDB, value by value, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from cadenza.queries import load_all
from tools.compare import connect, difference, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"
QUERIES, SQL = load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    got = spark_rows(QUERIES[name](spark, SF))
    if name in SQL:
        assert difference(got, sql_rows(con, SQL[name])) is None
    else:
        assert got[1]


def test_entry(spark):
    assert entry(spark).columns == ["mood_label", "rank", "id", "name", "artists", "primary_genre", "popularity"]
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())
