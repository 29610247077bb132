"""Every registered query against its SQL, and what its plan must not hold."""

from __future__ import annotations

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from tidemark.suite import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in plan
    assert compare(df, duck, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["dq_unique"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_linenumber)]" in plan
