"""The queue of change events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import events
from ..operators.cdc import CdcSpec, newest
from . import roles
from .base import query, table
from .roles import NOW, QUEUE

# States, priorities and formats in the SQL below are fixed values.
_EVENT = "event_id, detected_at, table_name, column_name, change_type, status, pipeline_status, branch_name, mr_url"
_EVENT_LIST = _EVENT.split(", ")


@query("event_lookup", f"SELECT {_EVENT} FROM {QUEUE} WHERE event_id = 'E500'")
def event_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The id is made from the order's key, so the key is what reaches the scan."""
    return events.event_by_id(roles.queue(spark, sf, F.col("o_orderkey") == 500), "E500").select(*_EVENT_LIST)


@query(
    "pending_changes",
    f"""
    SELECT event_id, detected_at, table_schema, table_name, column_name, change_type, old_data_type, new_data_type,
        CASE change_type WHEN 'COLUMN_DROP' THEN 'HIGH' WHEN 'TYPE_CHANGE' THEN 'HIGH' WHEN 'NEW_COLUMN' THEN 'MEDIUM'
            WHEN 'NEW_TABLE' THEN 'LOW' END AS priority,
        CASE change_type WHEN 'COLUMN_DROP' THEN 1 WHEN 'TYPE_CHANGE' THEN 2 WHEN 'NEW_COLUMN' THEN 3
            WHEN 'NEW_TABLE' THEN 4 END AS priority_rank
    FROM {QUEUE} WHERE status = 'PENDING' ORDER BY priority_rank, detected_at, event_id
    """,
)
def pending_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The named view over the queue."""
    events.pending_changes(roles.queue(spark, sf)).createOrReplaceTempView("pending_schema_changes")
    return spark.table("pending_schema_changes")


@query(
    "next_pending",
    f"""
    SELECT {_EVENT} FROM {QUEUE} WHERE pipeline_status = 'PENDING' AND status = 'PENDING'
    ORDER BY detected_at, event_id LIMIT 1
    """,
)
def next_pending(spark: SparkSession, sf: str) -> DataFrame:
    return events.next_pending(roles.queue(spark, sf)).select(*_EVENT_LIST)


_OUTCOME = f"""(SELECT 'E' || l_orderkey AS event_id, CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'passed'
    WHEN l_returnflag = 'A' THEN 'failed' WHEN l_returnflag = 'N' THEN 'stuck' WHEN l_linestatus = 'F' THEN 'started'
    ELSE 'review_opened' END AS outcome FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_shipdate DESC NULLS FIRST, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
        l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1)"""


@query(
    "event_transitions",
    f"""
    SELECT q.event_id, CASE WHEN o.outcome = 'failed' THEN 'PENDING' ELSE q.status END AS status,
        CASE o.outcome WHEN 'passed' THEN 'CI_PASSED' WHEN 'failed' THEN 'CI_FAILED' WHEN 'started' THEN 'GENERATING'
            WHEN 'review_opened' THEN 'PR_OPEN'
            WHEN 'stuck' THEN CASE q.pipeline_status WHEN 'GENERATING' THEN 'PENDING' ELSE q.pipeline_status END
            ELSE q.pipeline_status END AS pipeline_status
    FROM {QUEUE} q LEFT JOIN {_OUTCOME} o ON q.event_id = o.event_id
    """,
)
def event_transitions(spark: SparkSession, sf: str) -> DataFrame:
    """Every event meets the outcome that its order's newest line stands for."""
    last = CdcSpec(("l_orderkey",), "l_shipdate", None, ("l_linenumber", *roles.LINE_TIES))
    flag, closed = F.col("l_returnflag"), F.col("l_linestatus") == "F"
    outcome = (
        F.when((flag == "A") & closed, "passed")
        .when(flag == "A", "failed")
        .when(flag == "N", "stuck")
        .when(closed, "started")
        .otherwise("review_opened")
    )
    outcomes = newest(table(spark, sf, "lineitem"), last).select(
        F.concat(F.lit("E"), F.col("l_orderkey").cast("string")).alias("event_id"), outcome.alias("outcome")
    )
    return events.apply_outcomes(roles.queue(spark, sf), outcomes).select("event_id", "status", "pipeline_status")


@query(
    "requeue_stuck",
    f"""
    SELECT event_id, CASE pipeline_status WHEN 'GENERATING' THEN 'PENDING' ELSE pipeline_status END AS pipeline_status
    FROM {QUEUE}
    """,
)
def requeue_stuck(spark: SparkSession, sf: str) -> DataFrame:
    return events.requeue_stuck(roles.queue(spark, sf)).select("event_id", "pipeline_status")


@query("events_by_state", f"SELECT pipeline_status, count(*) AS events FROM {QUEUE} GROUP BY pipeline_status")
def events_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return events.count_by_state(roles.queue(spark, sf))


@query(
    "run_due",
    f"""
    SELECT count(*) FILTER (pipeline_status = 'PR_OPEN') AS events, count(*) FILTER (pipeline_status = 'PR_OPEN') > 0 AS due
    FROM {QUEUE}
    """,
)
def run_due(spark: SparkSession, sf: str) -> DataFrame:
    return events.has_state(roles.queue(spark, sf))


_LIFE = "event_id, status, pipeline_status, branch_name, mr_url, resolved_at"
_REVIEWS = """(SELECT 'schema-change/' || l_orderkey AS branch_name, l_linenumber AS position,
    CASE WHEN l_returnflag = 'A' THEN l_shipdate END AS merged_at,
    CASE WHEN l_returnflag = 'N' THEN 'open' ELSE 'closed' END AS state FROM lineitem)"""


@query(
    "review_reconcile",
    f"""
    WITH verdicts AS (SELECT branch_name, position, CASE WHEN merged_at IS NOT NULL THEN 'merged' ELSE 'closed' END AS verdict
        FROM {_REVIEWS} WHERE merged_at IS NOT NULL OR state = 'closed'),
    first AS (SELECT branch_name, verdict FROM (SELECT *, row_number() OVER (PARTITION BY branch_name
        ORDER BY position, verdict) AS rn FROM verdicts) WHERE rn = 1),
    seen AS (SELECT q.*, CASE WHEN q.pipeline_status <> 'RESOLVED' AND (f.verdict = 'merged'
            OR q.pipeline_status IN ('PR_OPEN', 'CI_PASSED', 'CI_FAILED')) THEN f.verdict END AS verdict
        FROM {QUEUE} q LEFT JOIN first f ON q.branch_name = f.branch_name)
    SELECT event_id, CASE WHEN verdict = 'merged' THEN 'RESOLVED' ELSE status END AS status,
        CASE verdict WHEN 'merged' THEN 'RESOLVED' WHEN 'closed' THEN 'PENDING' ELSE pipeline_status END AS pipeline_status,
        CASE WHEN verdict = 'closed' THEN NULL ELSE branch_name END AS branch_name,
        CASE WHEN verdict = 'closed' THEN NULL ELSE mr_url END AS mr_url,
        CASE WHEN verdict = 'merged' THEN TIMESTAMP '{NOW}' ELSE resolved_at END AS resolved_at
    FROM seen
    """,
)
def review_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as reviews of the event of their order."""
    reviews = roles.as_reviews(table(spark, sf, "lineitem"))
    return events.reconcile_reviews(roles.queue(spark, sf), reviews, roles.now()).select(*_LIFE.split(", "))


@query(
    "resolve_branch",
    f"""
    SELECT event_id, CASE WHEN hit THEN 'RESOLVED' ELSE status END AS status,
        CASE WHEN hit THEN 'RESOLVED' ELSE pipeline_status END AS pipeline_status, branch_name, mr_url,
        CASE WHEN hit THEN TIMESTAMP '{NOW}' ELSE resolved_at END AS resolved_at
    FROM (SELECT *, COALESCE(branch_name = 'schema-change/2' AND pipeline_status <> 'RESOLVED', FALSE) AS hit FROM {QUEUE})
    """,
)
def resolve_branch(spark: SparkSession, sf: str) -> DataFrame:
    """All open events of one merged branch are resolved."""
    merged = events.unresolved_of_branch("schema-change/2")
    return events.resolved(roles.queue(spark, sf), merged, roles.now()).select(*_LIFE.split(", "))


_RUNS = """(SELECT user_id, ts, CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state FROM events)"""


@query(
    "settle_failed_run",
    f"""
    WITH head AS (SELECT event_id FROM {QUEUE} WHERE pipeline_status = 'PR_OPEN' ORDER BY detected_at, event_id LIMIT 1),
    newest AS (SELECT user_id, arg_max(state, ts) AS state, max(ts) AS ts FROM {_RUNS} GROUP BY user_id),
    seen AS (SELECT *, state = 'FAILED' AND ts >= (SELECT max(ts) FROM events) - INTERVAL 15 MINUTES AS failed FROM newest)
    SELECT *, CASE WHEN failed THEN (SELECT event_id FROM head) END AS event_id FROM seen
    """,
)
def settle_failed_run(spark: SparkSession, sf: str) -> DataFrame:
    """Every user as a task, seen from the newest run of all: which task's run fails the oldest event in review."""
    runs = table(spark, sf, "events").select(
        "user_id", "ts", F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("state")
    )
    newest_run = runs.agg(F.max("ts")).scalar()
    return events.run_decisions(roles.queue(spark, sf), runs, newest_run, "user_id", "ts", "state")


@query(
    "settled_queue",
    f"""
    WITH requeued AS (SELECT event_id, detected_at, status,
            CASE pipeline_status WHEN 'GENERATING' THEN 'PENDING' ELSE pipeline_status END AS pipeline_status FROM {QUEUE}),
    head AS (SELECT event_id FROM requeued WHERE pipeline_status = 'PR_OPEN' ORDER BY detected_at, event_id LIMIT 1),
    failed AS (SELECT arg_max(event_type, ts) = 'error' AS failed FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 15 MINUTES),
    hit AS (SELECT event_id FROM head, failed WHERE failed)
    SELECT event_id, CASE WHEN event_id IN (SELECT event_id FROM hit) THEN 'PENDING' ELSE status END AS status,
        CASE WHEN event_id IN (SELECT event_id FROM hit) THEN 'CI_FAILED' ELSE pipeline_status END AS pipeline_status
    FROM requeued
    """,
)
def settled_queue(spark: SparkSession, sf: str) -> DataFrame:
    """The whole queue after the handler of failed runs; every event of the driver is a run of the one task, seen from the newest."""
    runs = table(spark, sf, "events").select(
        F.lit("run").alias("task_name"), F.col("ts").alias("scheduled_time"), F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("state")
    )
    newest_run = runs.agg(F.max("scheduled_time")).scalar()
    return events.settle_failed_run(roles.queue(spark, sf), runs, newest_run).select("event_id", "status", "pipeline_status")


@query(
    "settle_passed_run",
    f"""
    SELECT event_id, CASE WHEN event_id = (SELECT event_id FROM {QUEUE} WHERE pipeline_status = 'PR_OPEN'
        ORDER BY detected_at, event_id LIMIT 1) THEN 'CI_PASSED' ELSE pipeline_status END AS pipeline_status FROM {QUEUE}
    """,
)
def settle_passed_run(spark: SparkSession, sf: str) -> DataFrame:
    return events.settle_passed_run(roles.queue(spark, sf)).select("event_id", "pipeline_status")


@query(
    "review_number",
    f"SELECT event_id, CAST(NULLIF(regexp_extract(mr_url, '/pull/(\\d+)', 1), '') AS BIGINT) AS review_number FROM {QUEUE}",
)
def review_number(spark: SparkSession, sf: str) -> DataFrame:
    return roles.queue(spark, sf).select("event_id", C.review_number(F.col("mr_url")).alias("review_number"))


@query(
    "latest_run_state",
    """
    SELECT user_id, arg_max(CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END, ts) AS state, max(ts) AS ts,
        arg_max(event_type = 'error', ts) AS failed
    FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 15 MINUTES GROUP BY user_id
    """,
)
def latest_run_state(spark: SparkSession, sf: str) -> DataFrame:
    """Events as task runs, seen from the newest one."""
    runs = table(spark, sf, "events").select(
        "user_id", "ts", F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("state")
    )
    newest_run = runs.agg(F.max("ts")).scalar()
    return events.latest_run_state(runs, newest_run, "user_id", "ts", "state")


@query(
    "change_labels",
    f"""
    SELECT event_id, 'schema-change/' || lower(change_type) || '-' || lower(table_name) || '-' ||
            COALESCE(column_name, 'newtable') AS branch_label,
        'schema-change/' || substr(event_id, 1, 8) AS short_label,
        '[schema-change] ' || change_type || ' on ' || table_name
            || CASE WHEN column_name IS NULL THEN '' ELSE '.' || column_name END AS title
    FROM {QUEUE}
    """,
)
def change_labels(spark: SparkSession, sf: str) -> DataFrame:
    kind, name, column = F.col("change_type"), F.col("table_name"), F.col("column_name")
    return roles.queue(spark, sf).select(
        "event_id",
        C.branch_label(kind, name, column).alias("branch_label"),
        C.short_branch_label(F.col("event_id")).alias("short_label"),
        C.review_title(kind, name, column).alias("title"),
    )
