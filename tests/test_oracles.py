"""Every registered query against its SQL counterpart, and against plan rules."""

from __future__ import annotations

import os

import compare
import pytest
from conftest import plan_of

from __spark_entry__ import entry, oracle_sql, queries

ROOT = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(ROOT)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, con, name):
    result = QUERIES[name](spark, ROOT)
    plan = plan_of(result)
    # Rows of two tables are never paired without an equality between them.
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # No row-at-a-time Python.
    assert "BatchEvalPython" not in plan
    differences = compare.differences(result.toArrow(), compare.oracle_table(con, ORACLES[name]))
    assert not differences, differences


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship_runs(spark):
    table = entry(spark)
    assert table.count() == 135 and len(table.columns) == 21
