"""One key with a third of the rows: results stay whole and the hot key does not stay in one task."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift, lineage, mutate, quality
from tidemark.operators.cdc import CdcSpec, current_state
from tidemark.operators.events import reconcile_reviews
from tidemark.operators.joins import spread_join
from tidemark.session import cut

ROWS = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    """Small thresholds, so that small data shows what large data would."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, key="k"):
    return spark.range(0, ROWS, 1, 8).withColumn(key, F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000))


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def spread(df, chosen):
    """No task holds most of the chosen rows."""
    shares = [r["count"] for r in df.filter(chosen).groupBy(F.spark_partition_id()).count().collect()]
    return len(shares) > 2 and max(shares) < 0.6 * sum(shares)


def test_model_lookup_is_split(skewed):
    spark = skewed
    models = hot(spark).select(
        F.concat(F.lit("model.p.m"), "id").alias("unique_id"), F.concat(F.lit("m"), "id").alias("name"),
        F.lit("SILVER").alias("schema"), F.lit("f").alias("file_path"),
        F.array(F.concat(F.lit("model.p.m"), "k")).alias("depends_on"),
    )
    rows, plan = final_plan(lineage.edges_from_models(models, "DB"))
    assert len(rows) == ROWS and "skew=true" in plan
    assert Counter(r.source_table for r in rows)["SILVER.M7"] == ROWS // 3 + ROWS * 2 // 3 // 5000


def test_known_tables_are_split(skewed):
    spark = skewed
    columns = hot(spark).select(
        F.lit("BRONZE").alias("table_schema"), F.concat(F.lit("T"), "k").alias("table_name"),
        F.concat(F.lit("C"), "id").alias("column_name"), F.lit("int").alias("data_type"),
        F.lit(1).alias("ordinal_position"),
    )
    registry = spark.range(0, 5000, 1, 4).select(
        F.lit("BRONZE").alias("table_schema"), F.concat(F.lit("T"), "id").alias("table_name"),
        F.lit("OLD").alias("column_name"), F.lit("int").alias("data_type"),
    )
    events = registry.limit(0).select(*drift.COLUMN, F.lit("x").alias("change_type"), F.lit("x").alias("status"))
    # Stored, so that the planner does not fold the constants into the join keys.
    found = drift.column_changes(cut(columns), cut(registry), cut(events))
    rows = found.collect()
    assert len(rows) == ROWS and {r.change_type for r in rows} == {"NEW_COLUMN"}
    assert spread(found, "table_name = 'T7'")


def test_reviews_of_one_branch_are_spread(skewed):
    queue = hot(skewed).select(
        F.col("id").cast("string").alias("event_id"), F.lit("PENDING").alias("status"),
        F.lit("PR_OPEN").alias("pipeline_status"), F.concat(F.lit("b"), "k").alias("branch_name"),
        F.lit("u").alias("mr_url"), F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
    )
    moment = F.lit("2024-01-01").cast("timestamp_ntz")
    reviews = skewed.range(5000).select(
        F.concat(F.lit("b"), "id").alias("branch_name"), F.lit(1).alias("position"), moment.alias("merged_at"),
        F.lit("closed").alias("state"),
    )
    done = reconcile_reviews(cut(queue), cut(reviews), moment)
    assert done.filter("status = 'RESOLVED'").count() == ROWS
    assert spread(done, "branch_name = 'b7'")


def test_delete_by_key_is_split(skewed):
    gone = skewed.range(100, 200).withColumnRenamed("id", "k")
    rows, plan = final_plan(mutate.delete_keys(hot(skewed), gone, ["k"]))
    assert len(rows) == hot(skewed).filter("k < 100 OR k >= 200").count() and "skew=true" in plan


def test_salted_join_spreads_the_key(skewed):
    right = skewed.range(5000).withColumnRenamed("id", "k")
    joined = spread_join(hot(skewed), right, ["k"], "inner", ["id"])
    assert joined.filter("k = 7").count() == hot(skewed).filter("k = 7").count()
    assert spread(joined, "k = 7")


def test_hot_key_is_reduced_before_the_shuffle(skewed):
    log = hot(skewed).select("k", F.col("id").alias("v"), F.lit(False).alias("deleted"))
    state = current_state(log, CdcSpec(("k",), "v", "deleted"))
    rows, _ = final_plan(state)
    assert {r.k: r.v for r in rows}[7] == max(r.id for r in hot(skewed).filter("k = 7").collect())
    orphans = quality.orphan_counts(hot(skewed), "k", skewed.range(10, 5000), "id")
    rows, _ = final_plan(orphans)
    assert {r.value: r.child_rows for r in rows}[7] == hot(skewed).filter("k = 7").count()
