"""The driver's tables in the parts the operators work on, each as DataFrame and as SQL.

- `events` and `lineitem` are change logs (one key column, two key columns);
- `customer`, `orders`, `lineitem` with `nation` and `part` are the retail bronze tables;
- `lineitem` is also a catalogue of columns over time: an order is a table, a line number a column, a row
  a sighting of that column; the sightings before BASELINE_DAY give the registered baseline;
- `orders` is the queue of change events.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DROP_SUFFIX
from ..functions.columns import is_drop_marker
from ..operators.cdc import CdcSpec, current_state, newest
from ..operators.registry import business_columns
from ..plans.models import Model
from ..plans.retail import MODELS, ORDER_ITEMS
from .base import table

# Names, states and types below, in Python and in SQL, are fixed values.
BASELINE_DAY = "1998-06-01"
NOW = "2024-06-01 00:00:00"
LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_TIES = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")

USER_SPEC = CdcSpec(("user_id",), "ts", "deleted")
LINE_SPEC = CdcSpec(LINE_KEYS, "l_shipdate", "deleted", LINE_TIES)
CATALOG_SPEC = replace(LINE_SPEC, tombstone_wins=True)


def now():
    return F.lit(NOW).cast("timestamp_ntz")


# --- change logs ----------------------------------------------------------------------------------

USER_LOG = """(SELECT event_id, user_id, ts, event_type, value,
    CASE event_type WHEN 'error' THEN TRUE WHEN 'signup' THEN NULL ELSE FALSE END AS deleted FROM events)"""


def with_event_flag(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    flag = F.when(kind == "error", True).when(kind == "signup", F.lit(None)).otherwise(False)
    return events.select("event_id", "user_id", "ts", "event_type", "value", flag.alias("deleted"))


def user_log(spark: SparkSession, sf: str) -> DataFrame:
    return with_event_flag(table(spark, sf, "events"))


LINE_ORDER = """l_shipdate DESC NULLS FIRST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
    l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST"""


def newest_lines_sql(where: str) -> str:
    """Newest lineitem row per order and line number among those that pass a test."""
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY {LINE_ORDER}) AS rn FROM lineitem WHERE {where}) WHERE rn = 1)"""


def line_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").withColumn("deleted", F.col("l_returnflag") == "R")


def newest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Newest row per order and line number, deleted or not."""
    return newest(line_log(spark, sf), CATALOG_SPEC)


# --- retail ---------------------------------------------------------------------------------------

BRONZE_CUSTOMERS = """(SELECT c_custkey AS customer_id, n_name AS country, c_mktsegment AS segment,
    CASE WHEN c_acctbal >= 7000 THEN 'Gold' WHEN c_acctbal >= 3000 THEN 'Silver' ELSE 'Bronze' END AS loyalty_tier,
    CASE c_custkey % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'phone' ELSE 'sms' END AS preferred_contact,
    CASE c_custkey % 2 WHEN 0 THEN 'en' ELSE 'fr' END AS preferred_language,
    c_acctbal < 0 AS deleted FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def bronze_customers(spark: SparkSession, sf: str) -> DataFrame:
    key, balance, moment = F.col("c_custkey"), F.col("c_acctbal"), F.lit("2024-01-01").cast("timestamp_ntz")
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, sf, "customer").join(nation, "c_nationkey").select(
        key.alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("segment"),
        moment.alias("created_at"),
        moment.alias("updated_at"),
        F.when(balance >= 7000, "Gold").when(balance >= 3000, "Silver").otherwise("Bronze").alias("loyalty_tier"),
        F.element_at(F.array(F.lit("email"), F.lit("phone"), F.lit("sms")), (key % 3 + 1).cast("int")).alias(
            "preferred_contact"
        ),
        F.when(key % 2 == 0, "en").otherwise("fr").alias("preferred_language"),
        moment.alias("_snowflake_inserted_at"),
        moment.alias("_snowflake_updated_at"),
        (balance < 0).alias("_snowflake_deleted"),
    )


BRONZE_ORDERS = """(SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
    o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, o_orderpriority AS channel,
    CASE o_orderstatus WHEN 'P' THEN NULL ELSE FALSE END AS deleted FROM orders)"""


def as_bronze_orders(orders: DataFrame) -> DataFrame:
    moment = F.col("o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        moment.alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        F.lit("AUD").alias("currency"),
        F.col("o_orderpriority").alias("channel"),
        moment.alias("created_at"),
        moment.alias("updated_at"),
        moment.alias("_snowflake_inserted_at"),
        moment.alias("_snowflake_updated_at"),
        F.when(F.col("o_orderstatus") != "P", False).alias("_snowflake_deleted"),
    )


def bronze_orders(spark: SparkSession, sf: str) -> DataFrame:
    return as_bronze_orders(table(spark, sf, "orders"))


def bronze_order_items(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    moment = F.col("l_shipdate")
    return table(spark, sf, "lineitem").join(part, "l_partkey").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("l_suppkey").alias("supplier_id"),
        moment.alias("created_at"),
        moment.alias("_snowflake_inserted_at"),
        moment.alias("_snowflake_updated_at"),
        (F.col("l_returnflag") == "R").alias("_snowflake_deleted"),
    )


# The driver's lines have equal versions, so the model gets tie-breakers here.
_TIES = ("product_id", "supplier_id", "quantity", "unit_price")
DRIVER_MODELS: dict[str, Model] = {
    **MODELS,
    ORDER_ITEMS.name: replace(ORDER_ITEMS, spec=replace(ORDER_ITEMS.spec, tie_breakers=_TIES)),
}


def bronze(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "bronze.customers": bronze_customers(spark, sf),
        "bronze.orders": bronze_orders(spark, sf),
        "bronze.order_items": bronze_order_items(spark, sf),
    }


SILVER_CUSTOMERS = f"(SELECT * FROM {BRONZE_CUSTOMERS} WHERE deleted IS NULL OR NOT deleted)"
SILVER_ORDERS = f"(SELECT * FROM {BRONZE_ORDERS} WHERE deleted IS NULL OR NOT deleted)"
SILVER_ORDER_ITEMS = f"""(SELECT l_orderkey * 10 + l_linenumber AS item_id, l_orderkey AS order_id,
    l_partkey AS product_id, p_name AS product_name, CAST(l_quantity AS INTEGER) AS quantity,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price, l_shipdate AS created_at
    FROM {newest_lines_sql("l_returnflag <> 'R'")} JOIN part ON l_partkey = p_partkey)"""

# --- catalogue of columns -------------------------------------------------------------------------

_SCHEMA_SQL = "CASE WHEN l_orderkey % 97 = 0 THEN 'STAGING' ELSE 'BRONZE' END"
_TABLE_SQL = "CASE WHEN l_orderkey % 50 = 1 THEN 'T' || l_orderkey || '_JOURNAL_1' ELSE 'T' || l_orderkey END"
_NAME_SQL = """CASE l_linenumber WHEN 1 THEN 'AMOUNT' WHEN 2 THEN 'Key_Id' WHEN 3 THEN 'CHANNEL' WHEN 4 THEN 'STATUS'
    WHEN 5 THEN 'PARTNER_ID' WHEN 6 THEN 'SEEN_AT' ELSE '_SNOWFLAKE_ID' END"""
_TYPE_SQL = "CASE WHEN l_linestatus = 'F' THEN 'double' WHEN l_quantity < 25 THEN 'int' ELSE 'string' END"
_CATALOG_SELECT = f"""{_SCHEMA_SQL} AS table_schema, {_TABLE_SQL} AS table_name,
    CASE WHEN l_returnflag = 'R' THEN ({_NAME_SQL}) || '{DROP_SUFFIX}' ELSE ({_NAME_SQL}) END AS column_name,
    {_TYPE_SQL} AS data_type, l_linenumber AS ordinal_position"""
CATALOG = f"(SELECT {_CATALOG_SELECT} FROM {newest_lines_sql('TRUE')})"
BUSINESS_SQL = """NOT (starts_with(column_name, '_SNOWFLAKE_') OR starts_with(column_name, 'PAYLOAD__')
    OR starts_with(column_name, 'PRIMARY_KEY__')) AND column_name NOT IN ('LEAST_SIGNIFICANT_POSITION',
    'MOST_SIGNIFICANT_POSITION', 'EVENT_TYPE', 'SEEN_AT', 'SF_METADATA')"""
EARLY_CATALOG = f"""(SELECT {_CATALOG_SELECT}
    FROM {newest_lines_sql(f"l_shipdate < TIMESTAMP '{BASELINE_DAY}'")})"""
REGISTRY = f"""(SELECT table_schema, table_name, column_name, data_type FROM {EARLY_CATALOG}
    WHERE table_schema = 'BRONZE' AND {BUSINESS_SQL} AND NOT ends_with(column_name, '{DROP_SUFFIX}'))"""
_EVENT_ID_SQL = """l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
    || CAST(l_quantity AS INTEGER) || '-' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)"""
COLUMN_EVENTS = f"""(SELECT {_EVENT_ID_SQL} AS event_id, l_shipdate AS detected_at, {_SCHEMA_SQL} AS table_schema,
    {_TABLE_SQL} AS table_name, {_NAME_SQL} AS column_name,
    CASE l_returnflag WHEN 'A' THEN 'NEW_COLUMN' WHEN 'N' THEN 'TYPE_CHANGE' ELSE 'COLUMN_DROP' END AS change_type,
    {_TYPE_SQL} AS new_data_type,
    CASE WHEN l_tax < 0.03 THEN 'PENDING' WHEN l_tax < 0.05 THEN 'IN_PROGRESS' ELSE 'RESOLVED' END AS status
    FROM lineitem)"""
_ORDER_SCHEMA_SQL = _SCHEMA_SQL.replace("l_orderkey", "o_orderkey")
_ORDER_TABLE_SQL = _TABLE_SQL.replace("l_orderkey", "o_orderkey")
TABLE_EVENTS = f"""(SELECT 'T' || o_orderkey AS event_id, o_orderdate AS detected_at,
    {_ORDER_SCHEMA_SQL} AS table_schema, {_ORDER_TABLE_SQL} AS table_name, CAST(NULL AS VARCHAR) AS column_name,
    'NEW_TABLE' AS change_type, CAST(NULL AS VARCHAR) AS new_data_type,
    CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'IN_PROGRESS' ELSE 'RESOLVED' END AS status FROM orders)"""
CATALOG_EVENTS = f"(SELECT * FROM {COLUMN_EVENTS} UNION ALL SELECT * FROM {TABLE_EVENTS})"


def _catalog_names(key: str) -> dict[str, Column]:
    order = F.col(key)
    name = F.concat(F.lit("T"), order.cast("string"))
    return {
        "table_schema": F.when(order % 97 == 0, "STAGING").otherwise("BRONZE"),
        "table_name": F.when(order % 50 == 1, F.concat(name, F.lit("_JOURNAL_1"))).otherwise(name),
    }


_COLUMN_NAMES = ("AMOUNT", "Key_Id", "CHANNEL", "STATUS", "PARTNER_ID", "SEEN_AT", "_SNOWFLAKE_ID")


def _base_name():
    return F.element_at(F.array(*[F.lit(n) for n in _COLUMN_NAMES]), F.col("l_linenumber"))


def _type_text():
    return F.when(F.col("l_linestatus") == "F", "double").when(F.col("l_quantity") < 25, "int").otherwise("string")


def as_catalog(lines: DataFrame) -> DataFrame:
    """Lines as columns of tables; a returned line is a dropped column, under its marker name."""
    marked = F.concat(_base_name(), F.lit(DROP_SUFFIX))
    return lines.select(
        *[c.alias(n) for n, c in _catalog_names("l_orderkey").items()],
        F.when(F.col("l_returnflag") == "R", marked).otherwise(_base_name()).alias("column_name"),
        _type_text().alias("data_type"),
        F.col("l_linenumber").alias("ordinal_position"),
    )


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    return as_catalog(newest_lines(spark, sf))


def early_catalog(spark: SparkSession, sf: str) -> DataFrame:
    early = line_log(spark, sf).filter(F.col("l_shipdate") < F.lit(BASELINE_DAY).cast("timestamp_ntz"))
    return as_catalog(newest(early, CATALOG_SPEC))


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """Columns known on BASELINE_DAY."""
    return business_columns(early_catalog(spark, sf)).filter(~is_drop_marker(F.col("column_name")))


def column_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every sighting as a past change event."""
    flag, tax = F.col("l_returnflag"), F.col("l_tax")
    return table(spark, sf, "lineitem").select(
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int"),
            F.col("l_extendedprice").cast("decimal(12,2)"),
        ).alias("event_id"),
        F.col("l_shipdate").alias("detected_at"),
        *[c.alias(n) for n, c in _catalog_names("l_orderkey").items()],
        _base_name().alias("column_name"),
        F.when(flag == "A", "NEW_COLUMN").when(flag == "N", "TYPE_CHANGE").otherwise("COLUMN_DROP").alias("change_type"),
        _type_text().alias("new_data_type"),
        F.when(tax < 0.03, "PENDING").when(tax < 0.05, "IN_PROGRESS").otherwise("RESOLVED").alias("status"),
    )


def table_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a new-table event."""
    state = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("event_id"),
        F.col("o_orderdate").alias("detected_at"),
        *[c.alias(n) for n, c in _catalog_names("o_orderkey").items()],
        F.lit(None).cast("string").alias("column_name"),
        F.lit("NEW_TABLE").alias("change_type"),
        F.lit(None).cast("string").alias("new_data_type"),
        F.when(state == "O", "PENDING").when(state == "P", "IN_PROGRESS").otherwise("RESOLVED").alias("status"),
    )


def catalog_events(spark: SparkSession, sf: str) -> DataFrame:
    return column_events(spark, sf).unionByName(table_events(spark, sf))


# --- queue of change events -----------------------------------------------------------------------

QUEUE = """(SELECT 'E' || o_orderkey AS event_id, o_orderdate AS detected_at, 'BRONZE' AS table_schema,
    'T' || o_orderkey AS table_name,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'AMOUNT' END AS column_name,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'COLUMN_DROP' WHEN '2-HIGH' THEN 'TYPE_CHANGE'
        WHEN '3-MEDIUM' THEN 'NEW_COLUMN' WHEN '4-NOT SPECIFIED' THEN 'NEW_TABLE' ELSE 'RENAME' END AS change_type,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'int' END AS old_data_type,
    CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'string' END AS new_data_type,
    CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'IN_PROGRESS' ELSE 'RESOLVED' END AS status,
    CASE WHEN o_orderstatus = 'F' THEN 'RESOLVED' WHEN o_totalprice < 100000 THEN 'PENDING'
        WHEN o_totalprice < 200000 THEN 'GENERATING' WHEN o_totalprice < 300000 THEN 'PR_OPEN'
        WHEN o_totalprice < 400000 THEN 'CI_PASSED' ELSE 'CI_FAILED' END AS pipeline_status,
    CASE WHEN o_totalprice >= 200000 THEN 'schema-change/' || o_orderkey END AS branch_name,
    CASE WHEN o_totalprice >= 200000 THEN 'https://code.example.org/shop/pull/' || o_orderkey END AS mr_url,
    CAST(NULL AS TIMESTAMP) AS resolved_at FROM orders)"""


def queue(spark: SparkSession, sf: str, where: Column | None = None) -> DataFrame:
    """Every order (or those a test on the orders selects) as a change event somewhere in its life cycle."""
    orders = table(spark, sf, "orders")
    return as_queue(orders if where is None else orders.filter(where))


def as_queue(orders: DataFrame) -> DataFrame:
    kind, state, price = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice")
    number = F.col("o_orderkey").cast("string")

    def prefixed(text: str):
        return F.concat(F.lit(text), number)

    return orders.select(
        prefixed("E").alias("event_id"),
        F.col("o_orderdate").alias("detected_at"),
        F.lit("BRONZE").alias("table_schema"),
        prefixed("T").alias("table_name"),
        F.when(kind != "4-NOT SPECIFIED", "AMOUNT").alias("column_name"),
        F.when(kind == "1-URGENT", "COLUMN_DROP")
        .when(kind == "2-HIGH", "TYPE_CHANGE")
        .when(kind == "3-MEDIUM", "NEW_COLUMN")
        .when(kind == "4-NOT SPECIFIED", "NEW_TABLE")
        .otherwise("RENAME")
        .alias("change_type"),
        F.when(kind.isin("1-URGENT", "2-HIGH"), "int").alias("old_data_type"),
        F.when(kind.isin("2-HIGH", "3-MEDIUM"), "string").alias("new_data_type"),
        F.when(state == "O", "PENDING").when(state == "P", "IN_PROGRESS").otherwise("RESOLVED").alias("status"),
        F.when(state == "F", "RESOLVED")
        .when(price < 100000, "PENDING")
        .when(price < 200000, "GENERATING")
        .when(price < 300000, "PR_OPEN")
        .when(price < 400000, "CI_PASSED")
        .otherwise("CI_FAILED")
        .alias("pipeline_status"),
        F.when(price >= 200000, prefixed("schema-change/")).alias("branch_name"),
        F.when(price >= 200000, prefixed("https://code.example.org/shop/pull/")).alias("mr_url"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
    )


def as_reviews(lines: DataFrame) -> DataFrame:
    """Order lines as reviews of the event of their order, seen when they were shipped."""
    flag = F.col("l_returnflag")
    return lines.select(
        F.concat(F.lit("schema-change/"), F.col("l_orderkey").cast("string")).alias("branch_name"),
        F.col("l_linenumber").alias("position"),
        F.when(flag == "A", F.col("l_shipdate")).alias("merged_at"),
        F.when(flag == "N", "open").otherwise("closed").alias("state"),
        F.col("l_shipdate").alias("seen_at"),
    )


# --- lineage --------------------------------------------------------------------------------------

DATABASE = "SHOP"
EDGE_COLUMNS = ["artifact_name", "artifact_type", "source_table", "artifact_sql", "file_path", "output_fqn"]
_EDGE_SQL = """SELECT '{layer}.{item}_' || {id} AS artifact_name, 'dbt_model' AS artifact_type,
    {source} AS source_table, 'SELECT * FROM ' || {source} AS artifact_sql,
    'models/{layer}/{item}_' || {id} || '.sql' AS file_path,
    'SHOP.' || upper('{layer}.{item}_' || {id}) AS output_fqn FROM {table}"""


def _edge_sql(layer: str, item: str, key: str, source: str, from_table: str) -> str:
    return _EDGE_SQL.format(layer=layer, item=item, id=key, source=source, table=from_table)


EDGES = "(" + " UNION ALL ".join(
    [
        _edge_sql("silver", "nation", "n_nationkey", "'BRONZE.REGION_' || n_regionkey", "nation"),
        _edge_sql("gold", "customer", "c_custkey", "'SILVER.NATION_' || c_nationkey", "customer"),
        _edge_sql("gold", "supplier", "s_suppkey", "'SILVER.NATION_' || s_nationkey", "supplier"),
        _edge_sql("mart", "order", "o_orderkey", "'GOLD.CUSTOMER_' || o_custkey", "orders"),
        _edge_sql("mart", "order", "o_orderkey", "'SILVER.NATION_' || (o_orderkey % 25)",
                  "orders WHERE o_orderpriority = '1-URGENT'"),
    ]
) + ")"


def _edges(df: DataFrame, layer: str, item: str, key: str, source) -> DataFrame:
    name = F.concat(F.lit(f"{layer}.{item}_"), F.col(key).cast("string"))
    return df.select(
        name.alias("artifact_name"),
        F.lit("dbt_model").alias("artifact_type"),
        source.alias("source_table"),
        F.concat(F.lit("SELECT * FROM "), source).alias("artifact_sql"),
        F.concat(F.lit("models/"), F.replace(name, F.lit("."), F.lit("/")), F.lit(".sql")).alias("file_path"),
        F.concat(F.lit(DATABASE + "."), F.upper(name)).alias("output_fqn"),
    )


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """Regions, nations, customers and orders as tables fed by one another; urgent orders also read a nation
    directly, which makes diamonds."""

    def numbered(text: str, number):
        return F.concat(F.lit(text), number.cast("string"))

    orders = table(spark, sf, "orders")
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT")
    parts = [
        _edges(table(spark, sf, "nation"), "silver", "nation", "n_nationkey",
               numbered("BRONZE.REGION_", F.col("n_regionkey"))),
        _edges(table(spark, sf, "customer"), "gold", "customer", "c_custkey",
               numbered("SILVER.NATION_", F.col("c_nationkey"))),
        _edges(table(spark, sf, "supplier"), "gold", "supplier", "s_suppkey",
               numbered("SILVER.NATION_", F.col("s_nationkey"))),
        _edges(orders, "mart", "order", "o_orderkey", numbered("GOLD.CUSTOMER_", F.col("o_custkey"))),
        _edges(urgent, "mart", "order", "o_orderkey", numbered("SILVER.NATION_", F.col("o_orderkey") % 25)),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


REGION_EVENTS = """(SELECT 'R' || r_regionkey AS event_id, 'REGION_' || r_regionkey AS table_name,
    r_name AS column_name, CASE r_regionkey % 3 WHEN 0 THEN 'COLUMN_DROP' WHEN 1 THEN 'TYPE_CHANGE'
    ELSE 'NEW_COLUMN' END AS change_type FROM region)"""


def region_events(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("r_regionkey")
    return table(spark, sf, "region").select(
        F.concat(F.lit("R"), key.cast("string")).alias("event_id"),
        F.concat(F.lit("REGION_"), key.cast("string")).alias("table_name"),
        F.col("r_name").alias("column_name"),
        F.when(key % 3 == 0, "COLUMN_DROP").when(key % 3 == 1, "TYPE_CHANGE").otherwise("NEW_COLUMN").alias("change_type"),
    )


LINE_EDGES = f"""(SELECT 'silver.t' || l_orderkey || '_' || l_linenumber AS artifact_name,
    'dbt_model' AS artifact_type, 'BRONZE.T' || l_orderkey AS source_table,
    CASE WHEN l_linestatus = 'F' THEN NULL ELSE [{_NAME_SQL}] END AS source_columns,
    'models/silver/t' || l_orderkey || '_' || l_linenumber || '.sql' AS file_path,
    'SHOP.SILVER.T' || l_orderkey || '_' || l_linenumber AS output_fqn FROM {newest_lines_sql('TRUE')})"""


def line_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Every order line as a model that reads its order's table, whole or one column of it."""
    return as_line_edges(newest_lines(spark, sf))


def as_line_edges(lines: DataFrame) -> DataFrame:
    name = F.concat(F.lit("t"), F.concat_ws("_", "l_orderkey", "l_linenumber"))
    return lines.select(
        F.concat(F.lit("silver."), name).alias("artifact_name"),
        F.lit("dbt_model").alias("artifact_type"),
        F.concat(F.lit("BRONZE.T"), F.col("l_orderkey").cast("string")).alias("source_table"),
        F.when(F.col("l_linestatus") != "F", F.array(_base_name())).alias("source_columns"),
        F.concat(F.lit("models/silver/"), name, F.lit(".sql")).alias("file_path"),
        F.concat(F.lit(DATABASE + ".SILVER."), F.upper(name)).alias("output_fqn"),
    )


def user_state(spark: SparkSession, sf: str) -> DataFrame:
    return current_state(user_log(spark, sf), USER_SPEC)
