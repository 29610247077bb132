from __future__ import annotations

from dataclasses import replace

import pytest

from tidemark.operators.cdc import CdcSpec, current_state
from tidemark.operators.drift import snapshot_diff

SPEC = CdcSpec(("k",), "v", "deleted", ("tie",))
SCHEMA = "k int, v int, deleted boolean, tie string"


def state(spark, rows, spec=SPEC):
    df = spark.createDataFrame([(1, *r) for r in rows], SCHEMA)
    return [(r.v, r.tie) for r in current_state(df, spec).collect()]


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([(1, False, "a"), (2, False, "a")], [(2, "a")]),
        ([(1, False, "a"), (2, None, "a")], [(2, "a")]),
        ([(1, False, "a"), (2, True, "a")], [(1, "a")]),
        ([(1, True, "a")], []),
        ([(2, False, "a"), (1, False, "a")], [(2, "a")]),
        ([(None, False, "a"), (5, False, "a")], [(None, "a")]),
        ([(1, False, "a"), (1, False, "b")], [(1, "b")]),
    ],
)
def test_cases(spark, rows, expected):
    assert state(spark, rows) == expected


def test_variants(spark):
    rows = [(1, False, "a"), (2, True, "a")]
    assert state(spark, rows, replace(SPEC, tombstone_wins=True)) == []
    assert state(spark, [(None, False, "a"), (5, False, "a")], replace(SPEC, nulls_first=False)) == [(5, "a")]


def test_one_row_per_key_and_idempotent(spark):
    rows = [(k % 7, v, v % 3 == 0, str(k)) for k, v in enumerate([3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5, 8, 9, 7, 9] * 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    once = current_state(df, SPEC)
    assert once.count() == once.select("k").distinct().count()
    assert sorted(current_state(once, SPEC).collect()) == sorted(once.collect())


def test_null_key_is_a_key(spark):
    df = spark.createDataFrame([(None, 1, False, "a"), (None, 2, False, "a"), (1, 1, False, "a")], SCHEMA)
    assert {(r.k, r.v) for r in current_state(df, SPEC).collect()} == {(None, 2), (1, 1)}


def test_rank_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v", "false AS deleted", "'a' AS tie")
    plan = current_state(df, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange") == 1


def test_diff(spark):
    old = spark.createDataFrame([(1, 10, "x"), (2, 20, None), (3, None, "z")], "k int, a int, b string")
    new = spark.createDataFrame([(2, 20, None), (3, 30, "z"), (4, 40, "w")], "k int, a int, b string")
    rows = {(r.k, r.change, r.old_a, r.new_a) for r in snapshot_diff(old, new, ["k"], ["a", "b"]).collect()}
    assert rows == {(1, "REMOVED", 10, None), (3, "CHANGED", None, 30), (4, "ADDED", None, 40)}
    assert snapshot_diff(old, old, ["k"], ["a", "b"]).count() == 0
