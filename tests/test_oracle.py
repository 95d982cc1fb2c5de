"""Every query with SQL against DuckDB on the smallest tables, and that all others run."""

from __future__ import annotations

import pytest

from chartweave.plans import core_queries, reference_queries
from tests.oracle import differences

QUERIES = core_queries.QUERIES | reference_queries.QUERIES
SQL = core_queries.SQL | reference_queries.SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, small, name):
    assert differences(spark, QUERIES[name], SQL[name], small) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)
