"""Whitening against exact integers and a plain covariance."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<double>"


def usable(rows):
    return [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]


def exact(rows):
    """For the vectors of one length: ids, exact deviations, covariance from exact integers."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows], object)
    n = len(x)
    z = n * x - x.sum(0)
    v = np.array([[int((z[:, i] * z[:, j]).sum()) / n**3 for j in range(x.shape[1])] for i in range(x.shape[1])])
    return [i for i, _ in rows], (z * z).sum(1).tolist(), v, z


def check(rows, got):
    """`got` has all rows of one length."""
    ids, deviation, v, z = exact(rows)
    n, most = len(rows), min(whitening.COMPONENTS, v.shape[0])
    assert sorted(str(r["vec_id"]) for r in got) == sorted(str(i) for i in ids for _ in range(most))
    assert sorted({(str(r["vec_id"]), int(r["deviation"])) for r in got}) == sorted(set(zip(map(str, ids), deviation)))
    values = np.linalg.eigvalsh(v)[::-1][:most]
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1
    share = {r["component"]: r["explained"] for r in got}
    for k, value in enumerate(values):
        if value > 1e-9 * values[0]:
            assert share[k + 1] == pytest.approx(value / np.trace(v), rel=1e-9)
    return values, z.astype(float) / n


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


def random_rows(n, d, seed=0, scale=1.0):
    mix = np.random.default_rng(seed).normal(size=(d, d))
    return [(i, (scale * (np.random.default_rng((seed, i)).normal(size=d) @ mix)).tolist()) for i in range(n)]


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_equals_plain_covariance(spark, d):
    rows = random_rows(200, d, d)
    got = whitening.whitening(table(spark, rows)).collect()
    values, centred = check(rows, got)
    most = min(d, whitening.COMPONENTS)
    at = {i: k for k, (i, _) in enumerate(rows)}
    white = np.zeros((len(rows), most))
    for r in got:
        white[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    assert np.abs(white.T @ white / len(rows) - np.eye(most)).max() < 1e-9
    assert got[0]["identity_error"] < 1e-9
    # Each column is a projection on a unit eigenvector: V u = e u with u found again from the whitened values.
    for k in range(most):
        u = centred.T @ white[:, k] / len(rows) / np.sqrt(values[k])
        assert np.linalg.norm(u) == pytest.approx(1, rel=1e-9)


def test_null_and_non_finite_vectors_take_no_part(spark):
    good = random_rows(30, 3)
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 0.0]), (103, [float("inf"), 0.0, 0.0]), (104, [])]
    got = whitening.whitening(table(spark, good + bad)).collect()
    check(good, got)


def test_each_length_is_fitted_by_itself_and_null_ids_and_repeats_are_rows(spark):
    three = random_rows(25, 3) + [(5, random_rows(25, 3)[5][1]), (None, [0.1, 0.2, 0.3])]
    five = [(1000 + i, v) for i, v in random_rows(31, 5, 4)]
    df = table(spark, three + five).withColumn("size", F.lit("own")).withColumn("component", F.lit(7))
    got = whitening.whitening(df).collect()
    assert len(got) == 27 * 3 + 31 * 5
    check(three, [r for r in got if r["size"] == 3])
    check(five, [r for r in got if r["size"] == 5])


def test_large_entries_stay_exact(spark):
    rows = [(i, [c * 1e6, c * 3.0e7 - i, float(i % 3)]) for i, (_, (c,)) in enumerate(random_rows(60, 1, 9))]
    check(rows, whitening.whitening(table(spark, rows)).collect())
    huge = [(i, [1e300 if i == 0 else 0.5, float(i)]) for i in range(5)]
    got = whitening.whitening(table(spark, huge)).collect()
    assert len(got) == 10 and all(r["deviation"] is not None for r in got)


def test_components_without_spread_are_null(spark):
    rows = [(i, [float(i), 2.0 * i, 1.0]) for i in range(20)]
    got = whitening.whitening(table(spark, rows)).collect()
    check(rows, got)
    assert {r["component"] for r in got if r["whitened"] is None} == {2, 3}
    assert got[0]["identity_error"] < 1e-9
    same = whitening.whitening(table(spark, [(i, [1.0, 2.0]) for i in range(4)])).collect()
    assert len(same) == 8 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in same)


def test_squares_are_exact_beyond_64_bits():
    y = np.array([[1 << 40, -(1 << 41)], [3, 5]], np.int64)
    assert whitening.squares(y, 0).tolist() == [(1 << 80) + 9, ((1 << 40) - (1 << 41)) ** 2 + 64]


def test_empty_table(spark):
    for rows in ([], [(1, None)]):
        got = whitening.whitening(spark.createDataFrame(rows, SCHEMA))
        assert got.count() == 0 and "identity_error" in got.columns


def test_query_on_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = QUERIES["op13_embedding_whitening"](spark, sf_dir).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(usable(rows), [{**r.asDict(), "size": 64} for r in got])
    assert got[0]["identity_error"] < 1e-4
