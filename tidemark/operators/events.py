"""Change events: creation, queue, states, review and run outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CI_FAILED,
    CI_PASSED,
    GENERATED,
    GENERATING,
    IN_REVIEW_STATES,
    PENDING,
    PR_OPEN,
    RESOLVED,
)
from ..functions.columns import is_true, minutes_before, priority, priority_rank, row_id
from ..session import cut
from .mutate import update_where

EVENT_SCHEMA = (
    "event_id string, detected_at timestamp_ntz, table_schema string, table_name string, column_name string, "
    "change_type string, old_data_type string, new_data_type string, status string, pipeline_status string, "
    "branch_name string, mr_url string, "
    "generated_changes array<struct<artifact_name: string, file_path: string, action: string>>, "
    "test_output string, resolved_at timestamp_ntz"
)
EVENT_COLUMNS = [
    "event_id", "detected_at", "table_schema", "table_name", "column_name", "change_type", "old_data_type",
    "new_data_type", "status", "pipeline_status", "branch_name", "mr_url", "generated_changes", "test_output",
    "resolved_at",
]

# Outcome of a pipeline step -> pipeline state. A failed test keeps the event open.
OUTCOMES = {
    "started": GENERATING,
    "generated": GENERATED,
    "review_opened": PR_OPEN,
    "passed": CI_PASSED,
    "failed": CI_FAILED,
    "stuck": PENDING,
}


def new_events(changes: DataFrame, now: Column, id_from: list[str]) -> DataFrame:
    """Changes as full event rows, PENDING on both life cycles."""
    nothing = F.lit(None)
    return changes.select(
        row_id(*id_from, now).alias("event_id"),
        now.cast("timestamp_ntz").alias("detected_at"),
        "table_schema", "table_name", "column_name", "change_type", "old_data_type", "new_data_type",
        F.lit(PENDING).alias("status"),
        F.lit(PENDING).alias("pipeline_status"),
        nothing.cast("string").alias("branch_name"),
        nothing.cast("string").alias("mr_url"),
        nothing.cast("array<struct<artifact_name: string, file_path: string, action: string>>").alias(
            "generated_changes"
        ),
        nothing.cast("string").alias("test_output"),
        nothing.cast("timestamp_ntz").alias("resolved_at"),
    )


def event_by_id(events: DataFrame, event_id: object, column: str = "event_id") -> DataFrame:
    return events.filter(F.col(column) == F.lit(event_id))


def pending_changes(events: DataFrame) -> DataFrame:
    """Open events, most urgent kind first, then oldest first."""
    kind = F.col("change_type")
    return (
        events.filter(F.col("status") == PENDING)
        .select(
            "event_id", "detected_at", "table_schema", "table_name", "column_name", "change_type", "old_data_type",
            "new_data_type", priority(kind).alias("priority"), priority_rank(kind).alias("priority_rank"),
        )
        .orderBy("priority_rank", "detected_at", "event_id")
    )


def next_pending(events: DataFrame, states: tuple[str, ...] = ("pipeline_status", "status"),
                 wanted: str = PENDING) -> DataFrame:
    """Head of the queue: the oldest event with every given state column at `wanted`."""
    for state in states:
        events = events.filter(F.col(state) == wanted)
    return events.orderBy("detected_at", "event_id").limit(1)


def apply_outcomes(events: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Move each event by its outcome (event_id, outcome; one row per event). A `stuck` outcome only
    re-queues an event that is still generating, and a failed test sets the event PENDING."""
    to_state = F.create_map(*[F.lit(x) for pair in OUTCOMES.items() for x in pair])[F.col("outcome")]
    skip = (F.col("outcome") == "stuck") & (F.col("pipeline_status") != GENERATING)
    moved = F.when(is_true(skip), F.col("pipeline_status")).otherwise(
        F.coalesce(to_state, F.col("pipeline_status"))
    )
    columns = events.columns
    joined = events.join(outcomes.select("event_id", "outcome"), "event_id", "left")
    return joined.withColumns(
        {
            "pipeline_status": moved,
            "status": F.when(F.col("outcome") == "failed", PENDING).otherwise(F.col("status")),
        }
    ).select(*columns)


def requeue_stuck(events: DataFrame) -> DataFrame:
    return update_where(events, F.col("pipeline_status") == GENERATING, {"pipeline_status": F.lit(PENDING)})


def count_by_state(events: DataFrame, state: str = "pipeline_status") -> DataFrame:
    return events.groupBy(state).agg(F.count(F.lit(1)).alias("events"))


def has_state(events: DataFrame, wanted: str = PR_OPEN) -> DataFrame:
    """One row: is there an event in that state, so that a test run is due?"""
    return events.agg(
        F.count_if(F.col("pipeline_status") == wanted).alias("events"),
        (F.count_if(F.col("pipeline_status") == wanted) > 0).alias("due"),
    )


def resolved(events: DataFrame, where: Column, now: Column) -> DataFrame:
    """Close the events the test selects."""
    return update_where(
        events,
        where,
        {"status": F.lit(RESOLVED), "pipeline_status": F.lit(RESOLVED), "resolved_at": now.cast("timestamp_ntz")},
    )


def unresolved_of_branch(branch: str) -> Column:
    return (F.col("branch_name") == branch) & (F.col("pipeline_status") != RESOLVED)


def review_verdict() -> Column:
    """What a review (`merged_at`, `state`) says of its branch: merged, closed, or NULL while it is open."""
    return F.when(F.col("merged_at").isNotNull(), "merged").when(F.col("state") == "closed", "closed")


def first_verdict(verdict: Column) -> Column:
    """The first verdict by `position` of a group, as a struct of both; NULL if all are NULL."""
    return F.min(F.when(verdict.isNotNull(), F.struct(F.col("position"), verdict.alias("verdict"))))


def review_states(reviews: DataFrame) -> DataFrame:
    """One state per branch: the first of merged or closed in list order, else open.

    `reviews` has (branch_name, position, merged_at, state).
    """
    first = first_verdict(review_verdict())
    return reviews.groupBy("branch_name").agg(F.coalesce(first["verdict"], F.lit("open")).alias("review_state"))


def awaiting_review() -> Column:
    """Whether a review can still move an event."""
    return is_true((F.col("pipeline_status") != RESOLVED) & F.col("branch_name").isNotNull())


def reconcile_reviews(events: DataFrame, reviews: DataFrame, now: Column) -> DataFrame:
    """Merged: every unresolved event of the branch is resolved. Closed: events in review go back to the queue without
    branch and address."""
    return by_review_state(events, review_states(reviews), "branch_name", now)


def by_review_state(events: DataFrame, states: DataFrame, key: str, now: Column) -> DataFrame:
    """Move events by a `review_state` for each `key`, a column that both have."""
    unresolved = awaiting_review()
    merged = F.col("review_state") == "merged"
    closed = (F.col("review_state") == "closed") & F.col("pipeline_status").isin(*IN_REVIEW_STATES)
    text = F.lit(None).cast("string")
    moved = {
        "status": F.when(merged, RESOLVED).otherwise(F.col("status")),
        "pipeline_status": F.when(merged, RESOLVED).when(closed, PENDING).otherwise(F.col("pipeline_status")),
        "resolved_at": F.when(merged, now.cast("timestamp_ntz")).otherwise(F.col("resolved_at")),
        "branch_name": F.when(closed, text).otherwise(F.col("branch_name")),
        "mr_url": F.when(closed, text).otherwise(F.col("mr_url")),
    }
    # Only unresolved events with a branch travel to the join. The states are stored, so that the join does not share
    # its shuffle with their grouping and a branch with many events can be split.
    states = cut(states.filter("review_state <> 'open'"), "reviews")
    joined = events.filter(unresolved).join(states, key, "left")
    checked = joined.select(*[moved.get(c, F.col(c)).alias(c) for c in events.columns])
    return events.filter(~unresolved).unionByName(checked)


def settle_passed_run(events: DataFrame) -> DataFrame:
    """The oldest event in review passed its run."""
    head = next_pending(events, ("pipeline_status",), PR_OPEN).select("event_id").scalar()
    return update_where(events, F.col("event_id") == head, {"pipeline_status": F.lit(CI_PASSED)})


def settle_failed_run(events: DataFrame, runs: DataFrame, now: Column, **names: str) -> DataFrame:
    """Stuck events go back to the queue; if the newest recent run failed, the oldest event in review failed
    with it, and stays open. `runs` holds the runs of one task."""
    requeued = requeue_stuck(events)
    failed = latest_run_state(runs, now, **names).filter("failed").limit(1).exists()
    head = next_pending(requeued, ("pipeline_status",), PR_OPEN).select("event_id").scalar()
    hit = (F.col("event_id") == head) & failed
    return update_where(requeued, hit, {"pipeline_status": F.lit(CI_FAILED), "status": F.lit(PENDING)})


def run_decisions(events: DataFrame, runs: DataFrame, now: Column, task: str = "task_name", at: str = "scheduled_time",
                  state: str = "state") -> DataFrame:
    """One row per task: its newest run, whether that is recent and failed, and the event that then fails with it, the
    oldest one in review (`event_id`, NULL if nothing is to be done)."""
    newest = runs.groupBy(task).agg(F.max_by(state, at).alias(state), F.max(at).alias(at))
    head = next_pending(requeue_stuck(events), ("pipeline_status",), PR_OPEN).select("event_id").scalar()
    failed = is_true((F.col(at) >= minutes_before(now)) & (F.col(state) == "FAILED"))
    return newest.withColumn("failed", failed).withColumn("event_id", F.when(F.col("failed"), head))


def latest_run_state(runs: DataFrame, now: Column, task: str = "task_name", at: str = "scheduled_time",
                     state: str = "state") -> DataFrame:
    """Newest state per task within the look-back window, and whether it failed."""
    recent = runs.filter(F.col(at) >= minutes_before(now))
    latest = recent.groupBy(task).agg(F.max_by(state, at).alias(state), F.max(at).alias(at))
    return latest.withColumn("failed", F.col(state) == "FAILED")
