from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from retail import CUSTOMERS, ITEMS, ORDERS, bronze

from tidemark.operators.newtable import undocumented, with_comments
from tidemark.plans.models import BreakingChange, Change, evolve
from tidemark.plans.retail import COLUMN_DOCS, MODELS, TESTS
from tidemark.plans.run import build_all, column_docs, downstream_of, materialize, run_order, sandbox_run
from tidemark.operators.quality import test_report as report_of
from tidemark.sources.tables import Warehouse, layer_name, schema_columns

def brute_daily(customers=None, orders=ORDERS):
    """The daily table from the fixture's rows, in plain Python."""
    people = {c[0]: c for c in (CUSTOMERS if customers is None else customers)}
    groups = {}
    for number, customer, day, status, amount, _, channel in orders:
        if customer in people:
            _, _, _, country, segment, tier, contact = people[customer]
            key = (day, country, segment, channel, status, tier, contact, "en")
            groups.setdefault(key, []).append((number, customer, amount))
    return {
        k: (len({n for n, _, _ in v}), len({c for _, c, _ in v}), sum(a for *_, a in v), sum(a for *_, a in v) / len(v))
        for k, v in groups.items()
    }


def brute_summary():
    groups = {}
    for item, order, _, name, quantity, price in ITEMS:
        groups.setdefault(name, []).append((item, order, quantity, price))
    return {
        n: (len(v), sum(q for _, _, q, _ in v), sum(q * p for _, _, q, p in v), sum(p for *_, p in v) / len(v), len({o for _, o, _, _ in v}))
        for n, v in groups.items()
    }


@pytest.mark.parametrize("full", [False, True])
def test_daily(spark, full):
    rows = build_all(MODELS, bronze(spark, full))["gold.orders_daily"].collect()
    got = {(str(r[0])[:10], *tuple(r)[1:8]): tuple(map(float, tuple(r)[8:])) for r in rows}
    want = brute_daily()
    assert len(rows) == len(want) == 15 and got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values)
    assert {type(r.order_date) for r in rows} == {datetime if full else date}


@pytest.mark.parametrize("full", [False, True])
def test_summary(spark, full):
    rows = build_all(MODELS, bronze(spark, full))["gold.category_summary"].collect()
    got = {r.product_name: (r.items_sold, r.total_units, float(r.total_revenue), r.avg_unit_price, r.order_count) for r in rows}
    want = brute_summary()
    assert got.keys() == want.keys() and len(want) == 18
    for name, values in want.items():
        assert got[name] == pytest.approx(values)


def test_groups_share_customers_and_orders(spark):
    """Several orders of one customer on one day, one order with many items, a deleted and a missing customer."""
    tables = bronze(spark)
    orders = tables["bronze.orders"].withColumn("order_date", F.lit("2024-03-05").cast("date")).withColumns(
        {"status": F.lit("done"), "channel": F.lit("web")}
    )
    tables["bronze.orders"] = orders.withColumn(
        "customer_id", F.when(F.col("order_id") == 15, 99).otherwise(F.col("customer_id"))
    )
    tables["bronze.customers"] = tables["bronze.customers"].withColumn("_snowflake_deleted", F.col("customer_id") == 6)
    built = build_all(MODELS, tables)
    for name, df in tables.items():
        df.createOrReplaceTempView(name.replace(".", "_"))
    for name in ("silver.customers", "silver.orders", "silver.order_items"):
        built[name].createOrReplaceTempView(name.replace(".", "_"))
    for name in ("gold.orders_daily", "gold.category_summary"):
        text = MODELS[name].sql().replace("silver.", "silver_")
        want = spark.sql(text)
        if "order_date" in want.columns:
            want = want.withColumn("order_date", F.col("order_date").cast("date"))
        want = sorted(map(str, want.collect()))
        assert sorted(map(str, built[name].collect())) == want
    moved = [(n, 99 if n == 15 else c, "2024-03-05", "done", a, x, "web") for n, c, _, _, a, x, _ in ORDERS]
    want = brute_daily([c for c in CUSTOMERS if c[0] != 6], moved)
    got = {(str(r[0])[:10], *tuple(r)[1:8]): (r.order_count, r.customer_count) for r in built["gold.orders_daily"].collect()}
    assert got == {k: v[:2] for k, v in want.items()} and max(v[0] for v in want.values()) > 1


def test_row_model_text_gives_the_same_rows(spark):
    tables = bronze(spark)
    for name, df in tables.items():
        df.createOrReplaceTempView(name.replace(".", "_"))
    models = evolve(MODELS, [Change("TYPE_CHANGE", "ORDERS", "TOTAL_AMOUNT", "decimal(12,2)")])
    for name in ("silver.customers", "silver.orders"):
        text = models[name].sql().replace("bronze.", "bronze_")
        assert sorted(map(str, spark.sql(text).collect())) == sorted(map(str, models[name].build(tables).collect()))


def test_declared_tests(spark):
    tables = bronze(spark)
    built = build_all(MODELS, tables)
    assert {r.failures for r in report_of(built, TESTS).collect()} == {0}
    broken = dict(built)
    broken["silver.customers"] = built["silver.customers"].filter("customer_id <> 1")
    broken["silver.orders"] = built["silver.orders"].unionByName(built["silver.orders"].filter("order_id < 3"))
    broken["silver.order_items"] = built["silver.order_items"].withColumn(
        "order_id", F.when(F.col("item_id") > 1, F.col("order_id"))
    )
    failures = {(r.model, r.column_name, r.test): r.failures for r in report_of(broken, TESTS).collect() if r.failures}
    assert failures == {
        ("silver.orders", "order_id", "unique"): 2,
        ("silver.orders", "customer_id", "relationships"): sum((c == 1) * (1 + (n < 3)) for n, c, *_ in ORDERS),
        ("silver.order_items", "order_id", "not_null"): 1,
    }


def test_evolve_add_passes_through_silver_only(spark):
    models = evolve(MODELS, [Change("NEW_COLUMN", "ORDERS", "DISCOUNT_CODE", "string")])
    tables = bronze(spark)
    tables["bronze.orders"] = tables["bronze.orders"].withColumn("discount_code", F.lit("X"))
    built = build_all(models, tables)
    columns = built["silver.orders"].columns
    assert columns[columns.index("updated_at") + 1] == "discount_code"
    assert built["gold.orders_daily"].columns == build_all(MODELS, bronze(spark))["gold.orders_daily"].columns
    assert models["silver.customers"] is MODELS["silver.customers"]
    again = evolve(models, [Change("NEW_COLUMN", "ORDERS", "DISCOUNT_CODE", "string")])
    assert again["silver.orders"] == models["silver.orders"]


def test_evolve_drop(spark):
    models = evolve(MODELS, [Change("COLUMN_DROP", "ORDERS", "CHANNEL"), Change("COLUMN_DROP", "ORDERS", "TOTAL_AMOUNT")])
    tables = bronze(spark)
    tables["bronze.orders"] = tables["bronze.orders"].drop("channel", "total_amount")
    daily = build_all(models, tables)["gold.orders_daily"]
    assert "channel" not in daily.columns and "total_revenue" not in daily.columns
    assert daily.count() == 15
    dimension = evolve(MODELS, [Change("COLUMN_DROP", "CUSTOMERS", "LOYALTY_TIER")])
    assert "loyalty_tier" not in build_all(dimension, bronze(spark))["gold.orders_daily"].columns
    for column in ("ORDER_ID", "CUSTOMER_ID"):
        with pytest.raises(BreakingChange):
            evolve(MODELS, [Change("COLUMN_DROP", "ORDERS", column)])


def test_evolve_cast(spark):
    models = evolve(MODELS, [Change("TYPE_CHANGE", "ORDERS", "TOTAL_AMOUNT", "decimal(12,2)")])
    tables = bronze(spark)
    tables["bronze.orders"] = tables["bronze.orders"].withColumn("total_amount", F.col("total_amount").cast("string"))
    built = build_all(models, tables)
    assert dict(built["silver.orders"].dtypes)["total_amount"] == "decimal(12,2)"
    total = built["gold.orders_daily"].agg(F.sum("total_revenue")).first()[0]
    assert float(total) == pytest.approx(sum(o[4] for o in ORDERS))


def test_cast_of_the_key_keeps_counts_distinct(spark):
    """Two text keys that become one number are one order."""
    tables = bronze(spark, full=True)
    first = tables["bronze.orders"].filter("order_id = '1'")
    tables["bronze.orders"] = tables["bronze.orders"].unionByName(first.withColumn("order_id", F.lit("01")))
    models = evolve(MODELS, [Change("TYPE_CHANGE", "ORDERS", "ORDER_ID", "int")])
    rows = build_all(models, tables)["gold.orders_daily"].orderBy("order_date").collect()
    assert (rows[0].order_count, rows[0].customer_count, float(rows[0].total_revenue)) == (1, 1, 2 * ORDERS[0][4])
    assert {r.order_count for r in rows} == {1} and len(rows) == 15


def test_lenient_cast(spark):
    tables = bronze(spark)
    model = evolve(MODELS, [Change("TYPE_CHANGE", "ORDERS", "STATUS", "int")])["silver.orders"]
    assert replace(model, lenient=True).build(tables).filter("status IS NULL").count() == 15
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        model.build(tables).collect()


def test_documentation(spark):
    docs = column_docs(spark, COLUMN_DOCS)
    built = build_all(MODELS, bronze(spark))
    columns = schema_columns(spark, {n.split(".")[1]: built[n] for n in MODELS})
    missing = {(r.model, r.column_name) for r in undocumented(columns, docs).collect()}
    audit = {(m, c) for m in ("customers", "orders", "order_items") for c in ("_SNOWFLAKE_INSERTED_AT", "_SNOWFLAKE_UPDATED_AT")}
    assert missing == audit
    noted = with_comments(built["silver.orders"], COLUMN_DOCS["silver.orders"])
    assert noted.schema["channel"].metadata == {"comment": "Channel."}
    assert noted.columns == built["silver.orders"].columns


def test_order_and_selection():
    order = run_order(MODELS)
    assert order.index("silver.orders") < order.index("gold.orders_daily")
    assert downstream_of(MODELS, ["bronze.orders"]) == ["silver.orders", "gold.orders_daily"]
    assert downstream_of(MODELS, ["bronze.order_items"]) == ["silver.order_items", "gold.category_summary"]


def test_materialize_keeps_versions_and_sandbox_leaves_production(spark, tmp_path):
    out = Warehouse(str(tmp_path), env="prod")
    tables = bronze(spark)
    counts = {r.model: r.row_count for r in materialize(spark, MODELS, tables, out).collect()}
    assert counts == {"silver.customers": 10, "silver.orders": 15, "silver.order_items": 20, "gold.orders_daily": 15,
                      "gold.category_summary": 18}
    tables["bronze.orders"] = tables["bronze.orders"].filter("order_id > 5")
    sandbox = Warehouse(str(tmp_path), env="dev")
    verdicts = sandbox_run(spark, MODELS, tables, sandbox, changed=["bronze.orders"], production=out)
    assert {r.model: (r.test_status, r.row_count) for r in verdicts.collect()} == {
        "silver.orders": ("PASS", 10), "gold.orders_daily": ("PASS", 10),
    }
    assert out.read(spark, "silver.orders").count() == 15
    materialize(spark, MODELS, tables, out, only=downstream_of(MODELS, ["bronze.orders"]))
    assert out.read(spark, "silver.orders").count() == 10
    assert out.read(spark, "gold.orders_daily").count() == 10


def test_sandbox_failure_does_not_stop_the_others(spark, tmp_path):
    tables = bronze(spark)
    tables["bronze.orders"] = tables["bronze.orders"].drop("channel")
    verdicts = {
        r.model: (r.test_status, r.test_error)
        for r in sandbox_run(spark, MODELS, tables, Warehouse(str(tmp_path), env="dev")).collect()
    }
    assert verdicts["silver.orders"][0] == verdicts["gold.orders_daily"][0] == "FAIL"
    assert verdicts["silver.customers"][0] == verdicts["gold.category_summary"][0] == "PASS"
    assert "channel" in verdicts["silver.orders"][1]


def test_places():
    assert layer_name(" gold ", "PUBLIC") == "GOLD"
    assert layer_name(None, "PUBLIC") == "PUBLIC"
    assert Warehouse("/r", "dev").path("silver.Orders") == "/r/DEV/SILVER/orders"
    assert Warehouse("/r").path("orders") == "/r/PROD/PUBLIC/orders"
