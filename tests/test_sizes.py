"""What has to stay small when the tables grow: tasks of a stream's batch, memory of state stores, repeated reads."""

from __future__ import annotations

from pathlib import Path

import pytest

from tidemark.operators import registry
from tidemark.session import cut, release
from tidemark.streaming import log as logs
from tidemark.suite import QUERIES, drift, lineage, roles, stream  # noqa: F401
from tidemark.suite.stream import BATCHES, follow

SF = "/root/testdata/sf0.001"


def test_a_batch_of_a_followed_table_has_several_files(spark):
    """And all rows of a key lie in one file, so in one batch."""
    sizes, seen = [], []

    def on_batch(batch, number):
        sizes.append(len({r[0] for r in batch.selectExpr("_metadata.file_path").distinct().collect()}))
        seen.append({tuple(r) for r in batch.select(*roles.LINE_KEYS).collect()})

    from tidemark.session import scratch_dir

    rows = follow(spark, SF, "lineitem", *roles.LINE_KEYS)
    rows.select("*", "_metadata").writeStream.foreachBatch(on_batch).option("checkpointLocation", scratch_dir(spark, "cp")).trigger(availableNow=True).start().awaitTermination()
    assert len(sizes) == BATCHES and min(sizes) > 1
    assert sum(map(len, seen)) == len(set.union(*seen))
    release(spark)


def test_reviews_wait_in_files_and_not_in_state_stores(spark, tmp_path, monkeypatch):
    places = []
    monkeypatch.setattr(stream, "scratch_dir", lambda s, label="work": places.append(str(tmp_path / f"{label}-{len(places)}")) or places[-1])
    QUERIES["stream_reviews"](spark, SF)
    work = Path(next(p for p in places if "stream-reviews" in p))
    assert not (work / "checkpoint" / "state").exists() and list((work / "checkpoint" / "held").glob("events/run=*"))


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        rows = spark.range(0, 200_000, 1, 8).selectExpr("id", "uuid() AS text")
        held = logs.BucketLog(str(tmp_path / "log"), rows.schema, ("id",), lambda df: df, 1)
        held.write(rows, 0)
        files = list((tmp_path / "log" / "run=1").glob("bucket=0/*.parquet"))
        assert len(files) > 1 and held.read(spark).count() == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


@pytest.mark.parametrize("name, most", [("impact_json", 1)])
def test_newest_lines_are_found_once(spark, monkeypatch, name, most):
    calls, newest = [], roles.newest_lines
    monkeypatch.setattr(roles, "newest_lines", lambda *a: calls.append(a) or newest(*a))
    QUERIES[name](spark, SF)
    assert len(calls) == most
    release(spark)


def test_drift_finds_the_baseline_once(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(stream, "cut", lambda df, label="cut": stored.append(label) or cut(df, label))
    QUERIES["stream_drift"](spark, SF)
    assert {"registry", "earlier-events"} <= set(stored)
    release(spark)


def test_baseline_sorts_only_what_was_shuffled(spark, monkeypatch):
    """A sort that reads a file holds as much as a split of it; one behind a shuffle holds a partition."""
    inputs = [cut(f(spark, SF)) for f in (roles.registry, roles.catalog_events, roles.catalog)]
    plans = []
    monkeypatch.setattr(registry, "cut", lambda df, label="cut": plans.append(df) or cut(df, label))
    plans.append(registry.advance_registry(*inputs))
    for df in plans:
        lines = [(len(x) - len(x.lstrip(" +-:")), x.lstrip(" +-:")) for x in df._jdf.queryExecution().executedPlan().toString().splitlines()]
        for at, (depth, line) in enumerate(lines):
            if line.startswith("Sort "):
                below = next((i for i in range(at + 1, len(lines)) if lines[i][0] <= depth), len(lines))
                assert any("Exchange" in x for _, x in lines[at + 1:below]), f"sorted before a shuffle: {line}"
    release(spark)
