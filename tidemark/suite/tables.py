"""Inserts, updates, deletes, slices and settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mutate
from ..operators.cdc import newest
from ..session import scratch_dir
from ..sources.keyed import KeyedTable
from ..sources.tables import Warehouse
from . import roles
from .base import ORACLES, query, table
from .roles import BASELINE_DAY, LINE_KEYS, NOW, newest_lines_sql

_DAY_SQL = f"TIMESTAMP '{BASELINE_DAY}'"
_COLUMNS = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity", "l_extendedprice"]
_LIST = ", ".join(_COLUMNS)
_TARGET = f"(SELECT {_LIST} FROM {newest_lines_sql(f'l_shipdate < {_DAY_SQL}')})"
_BATCH = f"(SELECT {_LIST} FROM {newest_lines_sql(f'l_shipdate >= {_DAY_SQL}')})"
_ON = "t.l_orderkey = b.l_orderkey AND t.l_linenumber = b.l_linenumber"


def _day():
    return F.lit(BASELINE_DAY).cast("timestamp_ntz")


def _target_and_batch(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The lines as stored on BASELINE_DAY, and everything that arrived from then on (newest per key)."""
    lines = roles.line_log(spark, sf)
    old = newest(lines.filter(F.col("l_shipdate") < _day()), roles.CATALOG_SPEC)
    new = newest(lines.filter(F.col("l_shipdate") >= _day()), roles.CATALOG_SPEC)
    return old.select(*_COLUMNS), new.select(*_COLUMNS)


@query(
    "insert_if_absent",
    f"""
    SELECT {_LIST} FROM {_TARGET}
    UNION ALL SELECT {_LIST} FROM {_BATCH} b WHERE NOT EXISTS (SELECT 1 FROM {_TARGET} t WHERE {_ON})
    """,
)
def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    return mutate.insert_if_absent(*_target_and_batch(spark, sf), list(LINE_KEYS))


@query(
    "insert_ignore",
    f"""
    SELECT {_LIST} FROM {_TARGET}
    UNION ALL
    SELECT {_LIST} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_quantity, l_extendedprice) AS rn FROM lineitem WHERE l_shipdate >= {_DAY_SQL}) b
    WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM {_TARGET} t WHERE {_ON})
    """,
)
def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    """The later rows with their repeated keys; the first of each key is kept."""
    target, _ = _target_and_batch(spark, sf)
    batch = table(spark, sf, "lineitem").filter(F.col("l_shipdate") >= _day()).select(*_COLUMNS)
    order = [F.col(c) for c in ("l_shipdate", "l_partkey", "l_quantity", "l_extendedprice")]
    return mutate.insert_ignore(target, batch, list(LINE_KEYS), order)


@query("keyed_insert", ORACLES["insert_if_absent"])
def keyed_insert(spark: SparkSession, sf: str) -> DataFrame:
    """The same into a table that keeps a Bloom filter of its keys."""
    target, batch = _target_and_batch(spark, sf)
    held = KeyedTable(Warehouse(scratch_dir(spark, "keyed")), "silver.lines", LINE_KEYS)
    held.insert_if_absent(spark, target)
    held.insert_if_absent(spark, batch)
    return held.read(spark)


@query(
    "upsert",
    f"""
    SELECT {_LIST} FROM {_BATCH}
    UNION ALL SELECT {_LIST} FROM {_TARGET} t WHERE NOT EXISTS (SELECT 1 FROM {_BATCH} b WHERE {_ON})
    """,
)
def upsert(spark: SparkSession, sf: str) -> DataFrame:
    return mutate.upsert(*_target_and_batch(spark, sf), list(LINE_KEYS))


@query(
    "upsert_columns",
    f"""
    SELECT t.l_orderkey, t.l_linenumber, t.l_shipdate, t.l_partkey,
        CASE WHEN b.l_orderkey IS NULL THEN t.l_quantity ELSE b.l_quantity END AS l_quantity, t.l_extendedprice
    FROM {_TARGET} t LEFT JOIN {_BATCH} b ON {_ON}
    UNION ALL SELECT {_LIST} FROM {_BATCH} b WHERE NOT EXISTS (SELECT 1 FROM {_TARGET} t WHERE {_ON})
    """,
)
def upsert_columns(spark: SparkSession, sf: str) -> DataFrame:
    """A matched line takes the new quantity only."""
    return mutate.upsert(*_target_and_batch(spark, sf), list(LINE_KEYS), update=["l_quantity"])


@query(
    "keyed_update",
    """
    SELECT o_orderkey, o_custkey, o_orderdate,
        CASE WHEN o_orderstatus = 'P' AND o_totalprice > 250000 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderstatus = 'P' AND o_totalprice > 250000 THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM orders
    """,
)
def keyed_update(spark: SparkSession, sf: str) -> DataFrame:
    test = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 250000)
    values = {"o_orderstatus": F.lit("F"), "o_orderpriority": F.lit(None).cast("string")}
    changed = mutate.update_where(table(spark, sf, "orders"), test, values)
    return changed.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")


@query(
    "keyed_delete",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_quantity FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND NOT l_quantity > 45
    """,
)
def keyed_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of closed orders go by key, large lines by a test."""
    closed = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    kept = mutate.delete_keys(
        table(spark, sf, "lineitem"), closed.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"]
    )
    left = mutate.delete_where(kept, F.col("l_quantity") > 45)
    return left.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity")


@query(
    "replace_slice",
    """
    SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'purchase'
    UNION ALL SELECT l_orderkey * 10 + l_linenumber, l_suppkey, 'purchase', l_extendedprice FROM lineitem
    """,
)
def replace_slice(spark: SparkSession, sf: str) -> DataFrame:
    """The purchases are replaced by the order lines; then an empty set and a run outside production
    change nothing."""
    columns = ["event_id", "user_id", "event_type", "value"]
    events = table(spark, sf, "events").select(*columns)
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_id"),
        F.col("l_suppkey").alias("user_id"),
        F.lit("purchase").alias("event_type"),
        F.col("l_extendedprice").alias("value"),
    )
    replaced = mutate.replace_slice(events, rows, F.col("event_type") == "purchase")
    unchanged = mutate.replace_slice(replaced, rows.filter(F.col("value") < 0), F.col("event_type") == "view")
    return mutate.replace_slice(unchanged, rows, F.col("event_type") == "click", active=False)


@query(
    "seed_if_empty",
    """
    SELECT event_id, user_id, event_type FROM events
    UNION ALL SELECT c_custkey, c_custkey, 'customer' FROM customer
    """,
)
def seed_if_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Customers are a block the events lack, so they are added; suppliers offered as `view` rows are not."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("event_id"), F.col("c_custkey").alias("user_id"), F.lit("customer").alias("event_type")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("event_id"), F.col("s_suppkey").alias("user_id"), F.lit("view").alias("event_type")
    )
    seeded = mutate.seed_if_empty(events, customers, F.col("event_type") == "customer")
    return mutate.seed_if_empty(seeded, suppliers, F.col("event_type") == "view")


@query(
    "append_events",
    f"""
    SELECT event_id::VARCHAR AS event_id, user_id, event_type, ts AS detected_at, 'PENDING' AS status FROM events
    UNION ALL
    SELECT sha256('["T' || o_orderkey || '","' || o_orderstatus || '"]'), o_custkey, o_orderstatus, TIMESTAMP '{NOW}', 'PENDING'
    FROM orders
    """,
)
def append_events(spark: SparkSession, sf: str) -> DataFrame:
    """Orders appended to the events, with a stable id, the given time and the opening state."""
    events = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"), "user_id", "event_type", F.col("ts").alias("detected_at")
    )
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("table_name"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("event_type"),
    )
    defaults = {"status": F.lit("PENDING"), "detected_at": roles.now()}
    rows = mutate.with_defaults(orders, defaults, "event_id", ["table_name", "event_type"]).drop("table_name")
    return mutate.append(mutate.with_defaults(events, defaults), rows)


@query(
    "settings_lookup",
    """
    SELECT 'cust_' || o_custkey AS key, COALESCE(max(c_name), 'unknown') AS value
    FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0)
        ON c_custkey = o_custkey GROUP BY o_custkey
    """,
)
def settings_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in credit as settings; orders ask for them, with a default."""
    settings = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0).select(
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("key"), F.col("c_name").alias("value")
    )
    wanted = table(spark, sf, "orders").select(F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("key"))
    return mutate.lookup_settings(settings, wanted, "unknown")
