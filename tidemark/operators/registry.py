"""The registered baseline: seeding it and moving it forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import COLUMN_DROP, NEW_COLUMN, NEW_TABLE, TYPE_CHANGE
from ..functions.columns import is_business_column
from ..session import cut
from .drift import BY_COLUMN, BY_TABLE, COLUMN, TABLE, in_schema
from .mutate import insert_if_absent

# Tables with fewer events are never thought hot; names of tables are counted by this many buckets.
HOT_EVENTS = 100_000
NAME_BUCKETS = 1 << 16


def business_columns(columns: DataFrame, schema: str = "BRONZE") -> DataFrame:
    """What the baseline holds: all but the connector's columns; journal tables and markers stay."""
    return in_schema(columns, schema).filter(is_business_column(F.col("column_name"))).select(*COLUMN, "data_type")


def seed_registry(registry: DataFrame, columns: DataFrame, schema: str = "BRONZE") -> DataFrame:
    return insert_if_absent(registry.select(*COLUMN, "data_type"), business_columns(columns, schema), BY_COLUMN)


def column_counts(registry: DataFrame) -> DataFrame:
    return registry.groupBy("table_name").agg(F.count(F.lit(1)).alias("col_count"))


def advance_registry(registry: DataFrame, events: DataFrame, columns: DataFrame) -> DataFrame:
    """The baseline after applying `events` in order of (detected_at, event_id), in one set-based pass.

    For each column only what follows its last drop counts: the first addition is inserted unless the
    column is still there, and the last type change after that sets the type. A new table adds all of
    its current columns. The steps are shuffled by column before anything is sorted or grouped, so that no task holds
    more than a shuffle partition, however much of a file it reads; only the steps of hot tables are thinned before.
    """
    position = F.struct(F.col("detected_at"), F.col("event_id"))
    kind = F.col("change_type")
    placed = events.select(*COLUMN, "change_type", F.col("new_data_type").alias("data_type"), position.alias("pos"))
    table_events = placed.filter(kind == NEW_TABLE).select(*TABLE, "pos")
    current = columns.filter(is_business_column(F.col("column_name"), listed=False)).select(*COLUMN, "data_type")
    from_tables = current.join(table_events, BY_TABLE).withColumn("change_type", F.lit(NEW_COLUMN))
    steps = placed.filter(kind.isin(NEW_COLUMN, COLUMN_DROP, TYPE_CHANGE)).unionByName(from_tables)
    effects = _since_last_drop(_thinned(steps, _hot_tables(events)), BY_COLUMN)

    held = registry.select(*COLUMN, F.col("data_type").alias("held_type"), F.lit(True).alias("_registered"))
    both = held.join(effects, BY_COLUMN, "full")
    is_held = F.col("_registered").isNotNull() & F.col("dropped").isNull()
    retype = F.col("retyped").isNotNull() & (is_held | (F.col("retyped.pos") > F.col("added.pos")))
    start = F.when(is_held, F.col("held_type")).otherwise(F.col("added.data_type"))
    return both.filter(is_held | F.col("added").isNotNull()).select(
        *COLUMN, F.when(retype, F.col("retyped.data_type")).otherwise(start).alias("data_type")
    )


def _since_last_drop(steps: DataFrame, by: list[str]) -> DataFrame:
    """Per group its last drop, and the first addition and the last change of type after it."""
    kind, step = F.col("change_type"), F.struct("pos", "data_type")
    drop = F.when(kind == COLUMN_DROP, F.col("pos"))
    last = F.max(drop).over(Window.partitionBy(*by))
    counts = drop.isNotNull() | F.col("_last").isNull() | (F.col("pos") > F.col("_last"))
    return steps.withColumn("_last", last).filter(counts).groupBy(*by).agg(
        F.max(drop).alias("dropped"),
        F.min(F.when(kind == NEW_COLUMN, step)).alias("added"),
        F.max(F.when(kind == TYPE_CHANGE, step)).alias("retyped"),
    )


def _hot_tables(events: DataFrame) -> DataFrame:
    """Buckets of table names with more than HOT_EVENTS events and more than a shuffle partition's share of them.

    No column has more steps than its table has events. Names are counted by bucket, as a count of each would hold
    nearly all rows of a task.
    """
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = cut(events.groupBy(_bucket().alias("_bucket")).agg(F.count(F.lit(1)).alias("_n")), "table-buckets")
    share = counted.agg(F.sum("_n")).scalar() / F.lit(parts)
    return counted.filter((F.col("_n") > HOT_EVENTS) & (F.col("_n") > share)).select("_bucket")


def _bucket() -> Column:
    return F.pmod(F.xxhash64(*BY_TABLE), F.lit(NAME_BUCKETS))


def _thinned(steps: DataFrame, hot: DataFrame) -> DataFrame:
    """The steps, of which those of hot tables are left out that others of the same column and hour make void.

    Hours follow one another as the steps do, so what precedes the last drop of its hour precedes the last of all, and
    an hour after that has no drop: the first addition and last change of type of the hours are those of all.
    """
    if hot.isEmpty():
        return steps
    marked = cut(
        steps.withColumn("_bucket", _bucket()).join(F.broadcast(hot.withColumn("_hot", F.lit(True))), "_bucket", "left")
        .withColumn("_hour", F.struct(F.to_date("pos.detected_at"), F.hour("pos.detected_at"))).drop("_bucket"),
        "steps",
    )
    kept = F.array(
        F.struct(F.lit(COLUMN_DROP).alias("change_type"), F.lit(None).cast("string").alias("data_type"), F.col("dropped").alias("pos")),
        F.struct(F.lit(NEW_COLUMN).alias("change_type"), F.col("added.data_type"), F.col("added.pos")),
        F.struct(F.lit(TYPE_CHANGE).alias("change_type"), F.col("retyped.data_type"), F.col("retyped.pos")),
    )
    hourly = _since_last_drop(marked.filter("_hot"), [*BY_COLUMN, "_hour"])
    thin = hourly.select(*COLUMN, F.inline(kept)).filter(F.col("pos").isNotNull())
    return marked.filter(F.col("_hot").isNull()).select(*steps.columns).unionByName(thin)
