"""A small retail fixture in two type variants, made by rule: 10 customers, 15 orders on days of their own, 20 items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COUNTRIES, SEGMENTS, TIERS = ("Norland", "Westmark", "Osthem"), ("Trade", "Private"), ("High", "Mid", "Low", "None")
CUSTOMERS = [
    (i, f"Given{i}", f"Family{i}", COUNTRIES[i % 3], SEGMENTS[i % 2], TIERS[i % 4], ("email", "phone")[i // 2 % 2])
    for i in range(1, 11)
]
#: Order i belongs to customer 3 i mod 10 + 1 and was made on day i + 1 of the month.
ORDERS = [
    (i, 3 * i % 10 + 1, f"2024-03-{i + 1:02d}", ("open", "sent", "done")[i % 3], 16.5 * i + 0.25, ("AAA", "BBB")[i % 2], ("web", "shop")[i // 3 % 2])
    for i in range(1, 16)
]
#: Item i belongs to order (i - 1) mod 15 + 1; the last two items repeat the first two of 18 products.
ITEMS = [(i, (i - 1) % 15 + 1, 500 + (i - 1) % 18, f"Product {(i - 1) % 18 + 1}", i % 4 + 1, 2.125 * i) for i in range(1, 21)]


def _table(spark: SparkSession, rows: list[tuple], columns: list[str], types: dict[str, str]) -> DataFrame:
    df = spark.createDataFrame([tuple(map(str, r)) for r in rows], columns)
    df = df.select(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in columns])
    moment = F.lit("2024-04-01").cast("timestamp_ntz")
    return df.withColumns({"_snowflake_inserted_at": moment, "_snowflake_updated_at": moment,
                           "_snowflake_deleted": F.lit(False)})


def bronze(spark: SparkSession, full: bool = False) -> dict[str, DataFrame]:
    """`full` has text ids, timestamps and decimals; the default has ints, dates and doubles."""
    number, when, money = ("string", "timestamp", "decimal(12,3)") if full else ("int", "date", "double")
    day = F.lit("2024-01-01").cast("timestamp_ntz")
    customers = _table(
        spark, CUSTOMERS,
        ["customer_id", "first_name", "last_name", "country", "segment", "loyalty_tier", "preferred_contact"],
        {"customer_id": number},
    ).withColumns({
        "email": F.concat(F.lower("first_name"), F.lit("@example.com")), "phone": F.lit(None).cast("string"),
        "preferred_language": F.lit("en"), "created_at": day, "updated_at": day,
    })
    orders = _table(
        spark, ORDERS, ["order_id", "customer_id", "order_date", "status", "total_amount", "currency", "channel"],
        {"order_id": number, "customer_id": number, "order_date": when, "total_amount": money},
    ).withColumns({"created_at": day, "updated_at": day})
    items = _table(
        spark, ITEMS, ["item_id", "order_id", "product_id", "product_name", "quantity", "unit_price"],
        {"item_id": number, "order_id": number, "product_id": number, "quantity": "int", "unit_price": money},
    ).withColumns({"created_at": day})
    return {"bronze.customers": customers, "bronze.orders": orders, "bronze.order_items": items}
