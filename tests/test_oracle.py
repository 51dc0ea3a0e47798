"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle_compare import differences, duck

import __spark_entry__ as entry

QUERIES, SQL = entry.QUERIES, entry.SQL


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_sql_names_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


# Plans without rows in Python, cartesian products or nested loops.
FORBIDDEN = (
    "Python", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin",
)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in FORBIDDEN if operator in plan]
    if name in SQL:
        assert differences(df, con, SQL[name]) == []
    else:
        assert df.count() > 0
