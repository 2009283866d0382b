"""Every registered query equals its SQL on the driver's tables."""

import pytest

import __spark_entry__ as entry
from marketstream.plans import registry
from oracle_check import connect, spark_rows, sql_rows

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf_dir, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    assert (columns, rows) == sql_rows(db, SQL[name])
    assert rows


def test_entry(spark):
    assert entry.entry(spark).columns == ["window_start", "window_end", "user_id", "product_id", "n", "rank"]
