"""Every checked query agrees with its SQL, and no plan holds an operator that cannot scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from forgemeter.plans.registry import QUERIES, SQL
from compare import connect, difference, spark_rows, sql_rows

NAMES = sorted(QUERIES)  # the optional queries have tests of their own


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, sf_dir, connection, name):
    df = entry.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan
    assert difference(spark_rows(df), sql_rows(connection, entry.oracle_sql()[name])) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
