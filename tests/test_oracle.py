"""Every registered query against its oracle SQL at sf0.01 (the driver's check)."""

import pytest

import __spark_entry__ as entry_mod
from lakesync import registry
from tests.conftest import SF_CHECK
from tests.oracle import duck, rows_of_spark, rows_of_sql

# The optional training-data queries have their own tests.
QUERIES = registry.QUERIES
SQL = registry.ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got_cols, got = rows_of_spark(QUERIES[name](spark, SF_CHECK))
    want_cols, want = rows_of_sql(con, SQL[name])
    assert got_cols == want_cols
    assert sum(got.values()) == sum(want.values())
    assert got == want


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["lead_id", "tag_id"]
    assert df.count() > 0
