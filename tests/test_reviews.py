from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.events import reconcile_reviews
from tidemark.session import local_rows
from tidemark.streaming.reviews import review_log, reviewed, stream_reviews

EVENT = "event_id string, detected_at timestamp_ntz, status string, pipeline_status string, branch_name string, mr_url string, resolved_at timestamp_ntz"
REVIEW = "branch_name string, position int, merged_at timestamp_ntz, state string, seen_at timestamp_ntz"
START = datetime(2024, 1, 1)
NOW = datetime(2024, 6, 1)


def day(n):
    return START + timedelta(days=n)


def event(name, at, state="PR_OPEN", branch=""):
    branch = f"b-{name}" if branch == "" else branch
    return (name, at if at is None else day(at), "PENDING", state, branch, f"url {name}", None)


def review(branch, position, verdict, at):
    seen = at if at is None else day(at)
    return (branch, position, day(0) if verdict == "merged" else None, "open" if verdict == "open" else "closed", seen)


class Streams:
    """Files that arrive one by one for both streams."""

    def __init__(self, spark, path, **limits):
        self.spark, self.path, self.limits = spark, path, limits
        for name, schema in (("events", EVENT), ("reviews", REVIEW)):
            (path / name).mkdir()
        self.log = review_log(str(path / "log"), self.read("reviews", REVIEW), 2)

    def read(self, name, schema):
        return self.spark.readStream.schema(schema).parquet(str(self.path / name))

    def arrive(self, events=(), reviews=()):
        for name, rows, schema in (("events", events, EVENT), ("reviews", reviews, REVIEW)):
            if rows:
                local_rows(self.spark, list(rows), schema).coalesce(1).write.mode("append").parquet(str(self.path / name))
        stream_reviews(
            self.read("events", EVENT), self.read("reviews", REVIEW), self.log, str(self.path / "checkpoint"), **self.limits
        ).awaitTermination()

    def now(self, events):
        return sorted(map(str, reviewed(self.spark, local_rows(self.spark, list(events), EVENT), self.log, F.lit(NOW)).collect()))


EVENTS = [
    event("merged", 1), event("closed", 2), event("open", 3), event("none", 4), event("both", 5), event("both2", 5, "CI_FAILED", "b-both"),
    event("queued", 6, "GENERATING"), event("done", 7, "RESOLVED"), event("no branch", 8, "PENDING", None), event("no state", 9, None),
]
REVIEWS = [
    review("b-merged", 1, "merged", 9), review("b-merged", 1, "merged", 10), review("b-closed", 1, "open", 4), review("b-closed", 2, "closed", 5),
    review("b-open", 1, "open", 6), review("b-both", 2, "closed", 6), review("b-both", 1, "merged", 20), review("b-queued", 1, "closed", 7),
    review("b-done", 1, "closed", 8), review(None, 1, "merged", 8), review("b-unknown", 1, "merged", 8), review("b-no state", None, "merged", 9),
]


@pytest.mark.parametrize("seed, spread", [(1, 1), (2, 3)])
def test_any_order_equals_the_batch_form(spark, tmp_path, seed, spread):
    rng = random.Random(seed)
    events, reviews = rng.sample(EVENTS, len(EVENTS)), rng.sample(REVIEWS, len(REVIEWS))
    streams = Streams(spark, tmp_path, within="60 days", late="60 days", spread=spread)
    for part in range(3):
        streams.arrive(events[part::3], reviews[part::3] if part < 2 else [])
    streams.arrive([], reviews[2::3])
    want = reconcile_reviews(local_rows(spark, EVENTS, EVENT), local_rows(spark, REVIEWS, REVIEW).drop("seen_at"), F.lit(NOW))
    assert streams.now(EVENTS) == sorted(map(str, want.collect()))


def test_what_is_held_is_bounded_by_time(spark, tmp_path):
    """An event whose time has passed is stored without a verdict, and a review that comes after that moves nothing."""
    events = [event("early", 0), event("no time", None)]
    streams = Streams(spark, tmp_path, within="5 days", late="1 day")
    streams.arrive(events, [review("b-no time", 1, "merged", 0), review("b-x", 1, "merged", None)])
    assert streams.log.read(spark).count() == 0, "the event may still meet a review"
    streams.arrive([event("later", 40)], [review("b-y", 1, "merged", 40)])
    assert [tuple(r) for r in streams.log.read(spark).collect()] == [("early", None, None)]
    streams.arrive([], [review("b-early", 1, "merged", 2), review("b-later", 1, "closed", 41)])
    before = {e[0]: e for e in events}
    got = reviewed(spark, local_rows(spark, [*events, event("later", 40)], EVENT), streams.log, F.lit(NOW)).collect()
    assert {r.event_id: (r.pipeline_status, r.branch_name) for r in got} == {
        **{n: (e[3], e[4]) for n, e in before.items()}, "later": ("PENDING", None)
    }
