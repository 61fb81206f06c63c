"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry

from .compare import connect, difference, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    got = spark_rows(entry.queries()[name](spark, FOLDER))
    assert difference(got, sql_rows(con, entry.oracle_sql()[name])) is None


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer_id", "sector", "sector_value", "total_value", "sector_pct"]
    assert not df.isEmpty()
