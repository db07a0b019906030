"""Every registered query against its SQL on the same Parquet files."""

import pytest

import __spark_entry__ as entry
from tests.check import compare, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.columns and df.count() >= 0


def test_oracle_keys_are_registered():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert sum(r["n"] for r in rows) == max(r["cumulative"] for r in rows)
