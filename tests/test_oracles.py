"""Every query with a SQL text gives the same rows as DuckDB does."""

import pytest

import __spark_entry__ as entry
import check

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return check.connect(small)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, small, name):
    assert check.compare(spark, con, small, name) == ""


def test_every_sql_text_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
