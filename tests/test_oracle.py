"""Every SQL-checked registered query against its DuckDB twin (sf0.001),
plus the smoke contract of the entry module."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck

import __spark_entry__ as entry_mod

SQL = entry_mod.oracle_sql()
QUERIES = entry_mod.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_sql_key_is_registered():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, name, QUERIES[name], SQL[name], SF_SMALL, con)
    assert ok, msg


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "churn" in df.columns
