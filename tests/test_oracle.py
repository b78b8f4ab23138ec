"""Every registered query against its SQL in DuckDB, all rows."""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import connect, differences

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 25
    assert set(SQL) <= set(QUERIES)
