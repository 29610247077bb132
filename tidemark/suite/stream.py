"""Streaming runs over whole tables, drained and read back."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import CdcSpec, newest
from ..operators.events import EVENT_SCHEMA
from ..session import cut, scratch_dir
from ..sources.tables import KeyedLog, Warehouse
from ..streaming.jobs import GroupLog, bucket_log, state_log, stored_state, stream_current_state, stream_drift
from ..streaming.reviews import review_log, reviewed, stream_reviews
from . import roles
from .base import ORACLES, query, table
from .drift import DETECT_SQL


#: Micro-batches in which a table is followed.
BATCHES = 3


def follow(spark: SparkSession, sf: str, name: str, *keys: str) -> DataFrame:
    """One table as a stream of several micro-batches: its rows are first dealt into files of their own, by `keys` if
    all rows of a key belong into one batch. A batch has a file for every core, so that no task has a whole batch."""
    rows = table(spark, sf, name)
    path = scratch_dir(spark, f"stream-{name}")
    rows.repartition(BATCHES * spark.sparkContext.defaultParallelism, F.xxhash64(*(keys or rows.columns))).write.parquet(path)
    written = len(spark.read.schema(rows.schema).parquet(path).inputFiles())
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(1, ceil(written / BATCHES))).parquet(path)


def follow_stored(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The files of a stored table as a stream, whether it is one file or a folder of part files."""
    reader = spark.readStream.schema(table(spark, sf, name).schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(f"{sf}/{name}.parque[t]")


@query("stream_current_state", ORACLES["cdc_current_state"])
def stream_users(spark: SparkSession, sf: str) -> DataFrame:
    work = scratch_dir(spark, "stream-state")
    changes = roles.with_event_flag(follow(spark, sf, "events"))
    log = state_log(changes, f"{work}/log")
    stream_current_state(changes, roles.USER_SPEC, log, f"{work}/checkpoint").awaitTermination()
    return stored_state(spark, log, roles.USER_SPEC).select("user_id", "event_id", "ts", "event_type", "value")


@query("stream_bucketed_state", ORACLES["cdc_current_state"])
def stream_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The same in a log of key buckets, folded as it grows."""
    work = scratch_dir(spark, "stream-buckets")
    changes = roles.with_event_flag(follow(spark, sf, "events"))
    log = bucket_log(changes, f"{work}/log", roles.USER_SPEC, 8)
    stream_current_state(changes, roles.USER_SPEC, log, f"{work}/checkpoint").awaitTermination()
    return stored_state(spark, log, roles.USER_SPEC).select("user_id", "event_id", "ts", "event_type", "value")


@query("stream_gold", ORACLES["orders_daily"])
def stream_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Orders arrive as a stream; each batch takes off and adds the rows of its orders, and finishes the groups they touch."""
    work = scratch_dir(spark, "stream-gold")
    changes = roles.as_bronze_orders(follow(spark, sf, "orders"))
    spec = CdcSpec(("order_id",))
    log = bucket_log(changes, f"{work}/log", spec, 8)
    customers = roles.DRIVER_MODELS["silver.customers"].build({"bronze.customers": roles.bronze_customers(spark, sf)})
    daily = GroupLog(f"{work}/daily", roles.DRIVER_MODELS["gold.orders_daily"], 8)
    refresh = daily.refresh(roles.DRIVER_MODELS["silver.orders"], log, cut(customers, "customers"))
    stream_current_state(changes, spec, log, f"{work}/checkpoint", refresh).awaitTermination()
    return daily.read(spark).withColumn("total_revenue", F.col("total_revenue").cast("double"))


@query("stream_drift", DETECT_SQL)
def stream_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Sightings of columns arrive as a stream and are checked against the registry."""
    work = scratch_dir(spark, "stream-drift")
    seen = follow(spark, sf, "lineitem", *roles.LINE_KEYS).withColumn("deleted", F.col("l_returnflag") == "R")
    log = KeyedLog(Warehouse(work), "config.schema_change_events", T.StructType.fromDDL(EVENT_SCHEMA), "event_id")
    earlier = roles.catalog_events(spark, sf).withColumn("old_data_type", F.lit(None).cast("string"))
    stream_drift(
        seen,
        cut(roles.registry(spark, sf), "registry"),
        cut(earlier, "earlier-events"),
        log,
        f"{work}/checkpoint",
        latest=lambda batch: roles.as_catalog(newest(batch, roles.CATALOG_SPEC)),
        seen_at="l_shipdate",
    ).awaitTermination()
    return log.newest(spark).select(
        "table_schema", "table_name", "column_name", "change_type", "old_data_type", "new_data_type"
    )


@query("stream_reviews", ORACLES["review_reconcile"])
def stream_review_states(spark: SparkSession, sf: str) -> DataFrame:
    """Events and reviews arrive as two streams in any order; no row may be late here, so all that the tables span is waited for."""
    work = scratch_dir(spark, "stream-reviews")
    reviews = roles.as_reviews(follow(spark, sf, "lineitem"))
    log = review_log(f"{work}/log", reviews, 8)
    dates = table(spark, sf, "orders").select(F.col("o_orderdate").alias("at")).union(table(spark, sf, "lineitem").select("l_shipdate"))
    span = f"{(dates.agg(F.date_diff(F.max('at'), F.min('at'))).first()[0] or 0) + 1} days"
    stream_reviews(roles.as_queue(follow(spark, sf, "orders")), reviews, log, f"{work}/checkpoint", span, span).awaitTermination()
    return reviewed(spark, roles.queue(spark, sf), log, roles.now()).select(
        "event_id", "status", "pipeline_status", "branch_name", "mr_url", "resolved_at"
    )
