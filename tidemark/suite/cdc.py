"""Current state, gold aggregates, snapshot diff."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cdc import current_state
from ..operators.drift import snapshot_diff
from ..plans.models import Change, evolve
from ..plans.run import build_all
from ..session import scratch_dir
from ..sources.keyed import Snapshots
from ..sources.tables import Warehouse
from . import roles
from .base import ORACLES, query
from .roles import BASELINE_DAY, LINE_ORDER, SILVER_CUSTOMERS, SILVER_ORDER_ITEMS, SILVER_ORDERS, USER_LOG


@query(
    "cdc_current_state",
    f"""
    SELECT user_id, event_id, ts, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST) AS rn
        FROM {USER_LOG} WHERE deleted IS NULL OR NOT deleted)
    WHERE rn = 1
    """,
)
def cdc_current_state(spark: SparkSession, sf: str) -> DataFrame:
    return roles.user_state(spark, sf).select("user_id", "event_id", "ts", "event_type", "value")


@query(
    "cdc_tombstone_wins",
    f"""
    SELECT user_id, event_id, ts, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST) AS rn FROM {USER_LOG})
    WHERE rn = 1 AND (deleted IS NULL OR NOT deleted)
    """,
)
def cdc_tombstone_wins(spark: SparkSession, sf: str) -> DataFrame:
    spec = replace(roles.USER_SPEC, tombstone_wins=True)
    return current_state(roles.user_log(spark, sf), spec).select("user_id", "event_id", "ts", "event_type", "value")


_LINE_COLUMNS = "l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query(
    "cdc_current_state_composite",
    f"""
    SELECT {_LINE_COLUMNS} FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS rn
        FROM lineitem WHERE l_returnflag <> 'R')
    WHERE rn = 1
    """,
)
def cdc_current_state_composite(spark: SparkSession, sf: str) -> DataFrame:
    return current_state(roles.line_log(spark, sf), roles.LINE_SPEC).select(*_LINE_COLUMNS.split(", "))


def _money_as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("total_revenue", F.col("total_revenue").cast("double"))


DAILY_KEYS = "order_date, country, segment, channel, status, loyalty_tier, preferred_contact, preferred_language"


def _daily_sql(keys: str) -> str:
    return f"""
    SELECT {keys}, count(DISTINCT order_id) AS order_count, count(DISTINCT customer_id) AS customer_count,
        CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
        CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_value
    FROM (SELECT o.* EXCLUDE (order_date), date_trunc('day', order_date)::TIMESTAMP AS order_date,
              c.* EXCLUDE (customer_id, deleted)
          FROM {SILVER_ORDERS} o JOIN {SILVER_CUSTOMERS} c ON o.customer_id = c.customer_id)
    GROUP BY {keys}
    """


@query("orders_daily", _daily_sql(DAILY_KEYS))
def orders_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _money_as_double(build_all(roles.DRIVER_MODELS, roles.bronze(spark, sf))["gold.orders_daily"])


@query(
    "category_summary",
    f"""
    SELECT product_name, count(DISTINCT item_id) AS items_sold, CAST(sum(quantity) AS BIGINT) AS total_units,
        CAST(sum(quantity * unit_price) AS DOUBLE) AS total_revenue,
        CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS avg_unit_price,
        count(DISTINCT order_id) AS order_count
    FROM {SILVER_ORDER_ITEMS} GROUP BY product_name
    """,
)
def category_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _money_as_double(build_all(roles.DRIVER_MODELS, roles.bronze(spark, sf))["gold.category_summary"])


@query("evolve_drop", _daily_sql(DAILY_KEYS.replace("channel, ", "")))
def evolve_drop(spark: SparkSession, sf: str) -> DataFrame:
    """The daily table after the orders lost their channel: one grouping column less."""
    bronze = roles.bronze(spark, sf)
    bronze["bronze.orders"] = bronze["bronze.orders"].withColumnRenamed("channel", "channel__SNOWFLAKE_DELETED")
    models = evolve(roles.DRIVER_MODELS, [Change("COLUMN_DROP", "ORDERS", "CHANNEL")])
    return _money_as_double(build_all(models, bronze)["gold.orders_daily"])


@query(
    "evolve_add",
    f"""
    SELECT item_id, order_id, product_id, product_name, quantity, CAST(unit_price AS DOUBLE) AS unit_price, created_at,
        CAST(l_tax AS DOUBLE) AS tax
    FROM (SELECT l_orderkey * 10 + l_linenumber AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
              p_name AS product_name, CAST(l_quantity AS INTEGER) AS quantity,
              CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price, l_shipdate AS created_at, l_tax,
              row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}, l_tax DESC) AS rn
          FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R')
    WHERE rn = 1
    """,
)
def evolve_add(spark: SparkSession, sf: str) -> DataFrame:
    """The items table after the source gained a tax column."""
    part = roles.table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), "p_name")
    lines = roles.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("_snowflake_inserted_at"),
        F.col("l_shipdate").alias("_snowflake_updated_at"),
        (F.col("l_returnflag") == "R").alias("_snowflake_deleted"),
        F.col("l_tax").alias("tax"),
    )
    items = lines.join(part, "product_id").withColumnRenamed("p_name", "product_name")
    models = evolve(roles.DRIVER_MODELS, [Change("NEW_COLUMN", "ORDER_ITEMS", "TAX", "double")])
    model = models["silver.order_items"]
    model = replace(model, spec=replace(model.spec, tie_breakers=(*model.spec.tie_breakers, "tax")))
    state = model.build({"bronze.order_items": items})
    return state.drop("_snowflake_inserted_at", "_snowflake_updated_at").withColumn(
        "unit_price", F.col("unit_price").cast("double")
    )


@query(
    "evolve_cast",
    f"""
    SELECT item_id, order_id, product_id, product_name, CAST(quantity AS VARCHAR) AS quantity,
        CAST(unit_price AS DOUBLE) AS unit_price, created_at
    FROM {SILVER_ORDER_ITEMS}
    """,
)
def evolve_cast(spark: SparkSession, sf: str) -> DataFrame:
    """The items table after quantity became text and the price a double."""
    changes = [
        Change("TYPE_CHANGE", "ORDER_ITEMS", "QUANTITY", "string"),
        Change("TYPE_CHANGE", "ORDER_ITEMS", "UNIT_PRICE", "double"),
    ]
    models = evolve(roles.DRIVER_MODELS, changes)
    state = models["silver.order_items"].build(roles.bronze(spark, sf))
    return state.drop("_snowflake_inserted_at", "_snowflake_updated_at")


def _state_sql(where: str) -> str:
    return f"(SELECT * FROM {roles.newest_lines_sql(where)} WHERE l_returnflag <> 'R')"


@query(
    "snapshot_diff",
    f"""
    SELECT COALESCE(b.l_orderkey, c.l_orderkey) AS l_orderkey, COALESCE(b.l_linenumber, c.l_linenumber) AS l_linenumber,
        CASE WHEN b.l_orderkey IS NULL THEN 'ADDED' WHEN c.l_orderkey IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change,
        b.l_quantity AS old_l_quantity, c.l_quantity AS new_l_quantity,
        b.l_extendedprice AS old_l_extendedprice, c.l_extendedprice AS new_l_extendedprice
    FROM {_state_sql(f"l_shipdate < TIMESTAMP '{BASELINE_DAY}'")} b FULL JOIN {_state_sql("TRUE")} c
        ON b.l_orderkey = c.l_orderkey AND b.l_linenumber = c.l_linenumber
    WHERE b.l_orderkey IS NULL OR c.l_orderkey IS NULL OR b.l_quantity IS DISTINCT FROM c.l_quantity
        OR b.l_extendedprice IS DISTINCT FROM c.l_extendedprice
    """,
)
def snapshot_diff_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The lines as they stood on BASELINE_DAY against the lines now."""
    log = roles.line_log(spark, sf)
    early = log.filter(F.col("l_shipdate") < F.lit(BASELINE_DAY).cast("timestamp_ntz"))
    return snapshot_diff(
        current_state(early, roles.CATALOG_SPEC),
        current_state(log, roles.CATALOG_SPEC),
        list(roles.LINE_KEYS),
        ["l_quantity", "l_extendedprice"],
    )


@query("snapshot_versions", ORACLES["snapshot_diff"])
def snapshot_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The same from two stored versions, of which only buckets with different hashes are read."""
    log = roles.line_log(spark, sf)
    early = log.filter(F.col("l_shipdate") < F.lit(BASELINE_DAY).cast("timestamp_ntz"))
    kept = [*roles.LINE_KEYS, "l_quantity", "l_extendedprice"]
    store = Snapshots(Warehouse(scratch_dir(spark, "snapshots")), "silver.lines", roles.LINE_KEYS, buckets=256)
    old, new = (store.write(spark, current_state(rows, roles.CATALOG_SPEC).select(*kept)) for rows in (early, log))
    return store.diff(spark, old, new, kept[2:])
