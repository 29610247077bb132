"""Columns that models read and reach, and checks of many candidates."""

from __future__ import annotations

from pyspark.sql import functions as F
from retail import bronze

from tidemark.operators import lineage, quality
from tidemark.plans.columns import attributes, column_edges, column_impact, source_columns
from tidemark.plans.models import Change, evolve
from tidemark.plans.retail import MODELS
from tidemark.plans.run import model_edges
from tidemark.session import local_rows

EVENTS = "event_id string, table_name string, column_name string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_edges_of_the_retail_models_carry_their_columns(spark):
    held = {(r.artifact_name, r.source_table): r.source_columns for r in model_edges(spark, MODELS, "SHOP").collect()}
    assert len(held) == 6
    assert held["gold.orders_daily", "SILVER.CUSTOMERS"] == ["COUNTRY", "CUSTOMER_ID", "LOYALTY_TIER", "PREFERRED_CONTACT", "PREFERRED_LANGUAGE", "SEGMENT"]
    assert held["gold.orders_daily", "SILVER.ORDERS"] == ["CHANNEL", "CUSTOMER_ID", "ORDER_DATE", "ORDER_ID", "STATUS", "TOTAL_AMOUNT"]
    assert held["gold.category_summary", "SILVER.ORDER_ITEMS"] == ["ITEM_ID", "ORDER_ID", "PRODUCT_NAME", "QUANTITY", "UNIT_PRICE"]
    assert {"_SNOWFLAKE_DELETED", "ORDER_ID", "CURRENCY"} <= set(held["silver.orders", "BRONZE.ORDERS"])
    # What is listed is enough to build the models, and nothing of it can be left out.
    tables = bronze(spark)
    for model in (MODELS["silver.orders"], MODELS["silver.order_items"]):
        read = [c for c in tables[model.source].columns if c.upper() in source_columns(model, model.source)]
        assert rows(model.build({model.source: tables[model.source].select(*read)})) == rows(model.build(tables))
        assert len(read) == len(source_columns(model, model.source))


def test_a_changed_column_reaches_the_columns_that_use_it(spark):
    events = local_rows(spark, [("1", "ORDERS", "TOTAL_AMOUNT"), ("2", "ORDERS", "CURRENCY"), ("3", "customers", "segment"), ("4", "ORDERS", "GONE"), ("5", "ORDERS", None)], EVENTS)
    got = rows(column_impact(events, column_edges(spark, MODELS)))
    assert got == sorted([
        ("1", "silver.orders", "TOTAL_AMOUNT", 1), ("1", "gold.orders_daily", "TOTAL_REVENUE", 2), ("1", "gold.orders_daily", "AVG_ORDER_VALUE", 2),
        ("2", "silver.orders", "CURRENCY", 1), ("3", "silver.customers", "SEGMENT", 1), ("3", "gold.orders_daily", "SEGMENT", 2),
    ], key=str)
    key = column_impact(local_rows(spark, [("k", "ORDERS", "ORDER_ID")], EVENTS), column_edges(spark, MODELS))
    reached = {(a, c) for _, a, c, _ in rows(key)}
    assert {c for a, c in reached if a == "silver.orders"} == {c.upper() for c in MODELS["silver.orders"].columns}
    assert ("gold.orders_daily", "COUNTRY") in reached and not any(a == "gold.category_summary" for a, _ in reached)


def test_direct_readers_by_column_follow_the_models(spark):
    edges = model_edges(spark, evolve(MODELS, [Change("NEW_COLUMN", "ORDERS", "GIFT")]), "SHOP")
    events = local_rows(spark, [("1", "ORDERS", "GIFT"), ("2", "ORDERS", "UNREAD"), ("3", "ORDER_ITEMS", "QUANTITY")], EVENTS)
    assert rows(lineage.impact_by_column(events, edges)) == [("1", "GIFT", "silver.orders"), ("3", "QUANTITY", "silver.order_items")]
    unknown = edges.withColumn("source_columns", F.lit(None).cast("array<string>"))
    assert len(rows(lineage.impact_by_column(events, unknown))) == 3, "without a list the whole table is read"


def test_cycles_end(spark):
    edges = local_rows(spark, [("a", "X", "B", "X", "projection"), ("b", "X", "A", "X", "projection"), ("a", None, "BRONZE.T", "K", "key")],
                       "artifact_name string, output_column string, source_table string, source_column string, role string")
    got = rows(column_impact(local_rows(spark, [("1", "T", "K")], EVENTS), edges))
    assert got == [("1", "a", "X", 1), ("1", "b", "X", 2)]


def test_roles_cover_every_way_a_model_reads():
    roles = {role for model in MODELS.values() for *_, role in attributes(model)}
    assert roles == {"projection", "key", "order", "filter", "group", "measure", "join"}


def test_candidates_in_pages(spark, monkeypatch):
    """Pages smaller than the queue, repeated texts, an empty text, one that fails, rows that have a verdict."""
    source = local_rows(spark, [(i,) for i in range(7)], "k int")
    text = "SELECT k FROM {{ source('bronze', 't') }} WHERE k > "
    code = [(f"e{i}", f"a{i}", f"{text}{i % 9}", "PENDING", None) for i in range(30)]
    code += [("x", "bad", "SELECT nothing FROM {{ source('bronze', 't') }}", "PENDING", None), ("y", "none", None, "PENDING", None), ("z", "done", "SELECT", "PASS", "kept"), ("w", "open", "SELECT", None, None)]
    code.append(code[0])
    df = local_rows(spark, code, "event_id string, artifact_name string, generated_sql string, test_status string, test_error string")
    seen = []
    real = quality.verdict
    monkeypatch.setattr(quality, "verdict", lambda name, build: seen.append(name) or real(name, build))
    got = quality.check_candidates(spark, df, {"bronze.t": source}, "SHOP", page=3).collect()
    assert len(seen) == 11 and len(got) == len(code)
    held = {r.event_id: (r.test_status, r.test_error) for r in got}
    assert all(held[f"e{i}"] == ("PASS", None) for i in range(30))
    assert held["z"] == ("PASS", "kept") and held["w"] == (None, None)
    assert held["x"][0] == held["y"][0] == "FAIL" and "nothing" in held["x"][1]
    none = df.filter("test_status = 'PASS'")
    assert rows(quality.check_candidates(spark, none, {"bronze.t": source}, "SHOP")) == rows(none)
