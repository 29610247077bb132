from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from retail import bronze

from tidemark.operators import drift
from tidemark.operators import registry as registry_module
from tidemark.operators.events import EVENT_COLUMNS, EVENT_SCHEMA, new_events, resolved
from tidemark.operators.newtable import declare_sources, infer_primary_key, new_table_spec, sync_docs
from tidemark.operators.registry import advance_registry, seed_registry
from tidemark.session import local_rows
from tidemark.sources.tables import schema_columns

REGISTRY = "table_schema string, table_name string, column_name string, data_type string"
EVENTS = "table_schema string, table_name string, column_name string, change_type string, status string"
EVENT_LIST = [c for c in EVENT_COLUMNS if c != "generated_changes"]
COLUMNS = REGISTRY + ", ordinal_position int"


def now():
    return F.lit("2024-06-01").cast("timestamp_ntz")


def columns_of(spark, tables):
    return schema_columns(spark, {n.split(".")[1]: df for n, df in tables.items()})


_baseline = []


def baseline(spark):
    if not _baseline:
        seeded = seed_registry(local_rows(spark, [], REGISTRY), columns_of(spark, bronze(spark)))
        _baseline.append(stored(seeded))
    return _baseline[0]


def stored(df):
    return local_rows(df.sparkSession, [tuple(r) for r in df.collect()], df.schema.simpleString()[7:-1])


def found(spark, tables, registry=None, events=None):
    events = local_rows(spark, [], EVENTS) if events is None else events
    changes = drift.detect(columns_of(spark, tables), registry or baseline(spark), events)
    return {tuple(r)[1:] for r in changes.collect()}


def with_orders(spark, change):
    tables = bronze(spark)
    tables["bronze.orders"] = change(tables["bronze.orders"])
    return tables


SCENARIOS = {
    "add": (lambda o: o.withColumn("discount_code", F.lit("x")),
            {("ORDERS", "DISCOUNT_CODE", "NEW_COLUMN", None, "string")}),
    "drop": (lambda o: o.withColumnRenamed("channel", "CHANNEL__SNOWFLAKE_DELETED"),
             {("ORDERS", "CHANNEL", "COLUMN_DROP", "string", None)}),
    "drop of an unknown column": (lambda o: o.withColumn("X__SNOWFLAKE_DELETED", F.lit(1)), set()),
    "gone without marker": (lambda o: o.drop("channel"), set()),
    "type": (lambda o: o.withColumn("total_amount", F.col("total_amount").cast("string")),
             {("ORDERS", "TOTAL_AMOUNT", "TYPE_CHANGE", "double", "string")}),
    "connector": (lambda o: o.withColumns({c: F.lit(1) for c in ("_snowflake_x", "payload__x", "primary_key__x", "seen_at")}),
                  set()),
    "literal prefix": (lambda o: o.withColumn("payload_id", F.lit(1)),
                       {("ORDERS", "PAYLOAD_ID", "NEW_COLUMN", None, "int")}),
    "rename": (lambda o: o.withColumn("sales_channel", F.col("channel")).withColumnRenamed("channel", "CHANNEL__SNOWFLAKE_DELETED"),
               {("ORDERS", "CHANNEL", "COLUMN_DROP", "string", None), ("ORDERS", "SALES_CHANNEL", "NEW_COLUMN", None, "string")}),
}


@pytest.mark.parametrize("name", SCENARIOS)
def test_scenarios(spark, name):
    change, expected = SCENARIOS[name]
    tables = with_orders(spark, change)
    assert found(spark, tables) == expected
    columns, registry = columns_of(spark, tables), baseline(spark)
    changes = drift.detect(columns, registry, local_rows(spark, [], EVENTS))
    events = stored(new_events(changes, now(), drift.CHANGE).select(*EVENT_LIST))
    assert found(spark, tables, events=events) == set(), "open events are not reported again"
    failed = events.withColumn("pipeline_status", F.lit("CI_FAILED"))
    assert found(spark, tables, events=failed) == set(), "a failed test leaves the event open"
    advanced = stored(advance_registry(registry, events, columns))
    closed = resolved(events, F.lit(True), now())
    assert found(spark, tables, advanced, closed) == set(), "nothing is left after the baseline moved"


def test_new_table(spark):
    tables = bronze(spark)
    shipments = spark.createDataFrame([], "shipment_id long, order_id long, carrier string, _snowflake_deleted boolean")
    tables["bronze.shipments"] = shipments
    tables["bronze.orders_journal_1"] = shipments
    assert found(spark, tables) == {("SHIPMENTS", None, "NEW_TABLE", None, None)}
    changes = drift.detect(columns_of(spark, tables), baseline(spark), local_rows(spark, [], EVENTS))
    events = stored(new_events(changes, now(), drift.CHANGE).select(*EVENT_LIST))
    assert found(spark, tables, events=events) == set()
    advanced = stored(advance_registry(baseline(spark), events, columns_of(spark, tables)))
    assert found(spark, tables, advanced, resolved(events, F.lit(True), now())) == set()
    own = {r.column_name for r in advanced.filter("table_name = 'SHIPMENTS'").collect()}
    assert own == {"SHIPMENT_ID", "ORDER_ID", "CARRIER"}


def test_views_are_no_new_tables(spark):
    tables = spark.createDataFrame(
        [("BRONZE", "A", "BASE TABLE"), ("BRONZE", "B", "VIEW"), ("OTHER", "C", "BASE TABLE")],
        "table_schema string, table_name string, table_type string",
    )
    none = local_rows(spark, [], REGISTRY)
    got = drift.new_tables(tables, none, local_rows(spark, [], EVENTS)).collect()
    assert [r.table_name for r in got] == ["A"]


def random_catalog(rng):
    names = ["A", "B_ID", "A__SNOWFLAKE_DELETED", "B_ID__SNOWFLAKE_DELETED", "_SNOWFLAKE_X", "SEEN_AT", "PAYLOAD__Q"]
    tables = ["T1", "T2", "T3", "T4_JOURNAL_1"]
    return [
        (schema, t, c, rng.choice(["int", "string"]))
        for schema in ("BRONZE", "OTHER") for t in tables for c in names if rng.random() < 0.5
    ]


def reference_detect(columns, registry, events):
    """The four branches, row by row."""
    known = {r[:3]: r[3] for r in registry}
    tables = {r[:2] for r in registry}
    live = {(e[0], e[1], e[2], e[3]) for e in events if e[4] in ("PENDING", "IN_PROGRESS")}
    live_tables = {(e[0], e[1]) for e in events if e[4] in ("PENDING", "IN_PROGRESS") and e[3] == "NEW_TABLE"}
    out = []
    for s, t, c, kind in columns:
        if s != "BRONZE":
            continue
        marker = c.endswith("__SNOWFLAKE_DELETED")
        connector = c.startswith(("_SNOWFLAKE_", "PAYLOAD__", "PRIMARY_KEY__")) or c == "SEEN_AT"
        if ("_JOURNAL_" not in t and not connector and not marker and (s, t, c) not in known and (s, t) in tables
                and (s, t, c, "NEW_COLUMN") not in live):
            out.append((s, t, c, "NEW_COLUMN", None, kind))
        bare = c.replace("__SNOWFLAKE_DELETED", "")
        if marker and (s, t, bare) in known and (s, t, bare, "COLUMN_DROP") not in live:
            out.append((s, t, bare, "COLUMN_DROP", known[s, t, bare], None))
        if (s, t, c) in known and known[s, t, c] != kind and (s, t, c, "TYPE_CHANGE") not in live:
            out.append((s, t, c, "TYPE_CHANGE", known[s, t, c], kind))
    for s, t in {r[:2] for r in columns}:
        if s == "BRONZE" and "_JOURNAL_" not in t and (s, t) not in tables and (s, t) not in live_tables:
            out.append((s, t, None, "NEW_TABLE", None, None))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(6))
def test_one_pass_and_branches_agree_with_brute_force(spark, seed):
    rng = random.Random(seed)
    columns, registry = random_catalog(rng), random_catalog(rng)
    registry = [r for r in registry if r[1] != "T3"]
    kinds = ["NEW_COLUMN", "COLUMN_DROP", "TYPE_CHANGE"]
    events = [(*r[:3], rng.choice(kinds), rng.choice(["PENDING", "IN_PROGRESS", "RESOLVED"])) for r in random_catalog(rng)]
    events.append(("BRONZE", rng.choice(["T1", "T3"]), None, "NEW_TABLE", rng.choice(["PENDING", "RESOLVED"])))
    c = local_rows(spark, [(*r, 1) for r in columns], COLUMNS)
    r = local_rows(spark, registry, REGISTRY)
    e = local_rows(spark, events, EVENTS)
    want = reference_detect(columns, registry, events)
    assert sorted(map(tuple, drift.detect(c, r, e).collect()), key=str) == want
    branches = (
        drift.new_columns(c, r, e).unionByName(drift.dropped_columns(c, r, e))
        .unionByName(drift.changed_types(c, r, e)).unionByName(drift.new_tables(c, r, e))
    )
    assert sorted(map(tuple, branches.collect()), key=str) == want


def apply_one_by_one(registry, events, columns):
    held = {r[:3]: r[3] for r in registry}
    for e in sorted(events, key=lambda e: (e["detected_at"], e["event_id"])):
        key = (e["table_schema"], e["table_name"], e["column_name"])
        if e["change_type"] == "NEW_COLUMN":
            held.setdefault(key, e["new_data_type"])
        elif e["change_type"] == "COLUMN_DROP":
            held.pop(key, None)
        elif e["change_type"] == "TYPE_CHANGE":
            if key in held:
                held[key] = e["new_data_type"]
        else:
            for s, t, c, kind in columns:
                if (s, t) == key[:2] and not c.startswith(("_SNOWFLAKE_", "PAYLOAD__", "PRIMARY_KEY__")):
                    held.setdefault((s, t, c), kind)
    return held


@pytest.mark.parametrize("seed", range(6))
def test_advance_equals_one_event_at_a_time(spark, seed):
    rng = random.Random(100 + seed)
    registry, columns = random_catalog(rng), random_catalog(rng)
    events = []
    for i in range(120):
        schema, table, column, kind = rng.choice(columns + registry)
        change = rng.choice(["NEW_COLUMN", "NEW_COLUMN", "COLUMN_DROP", "TYPE_CHANGE", "TYPE_CHANGE", "NEW_TABLE"])
        if change == "NEW_TABLE" and rng.random() < 0.8:
            continue
        events.append({
            "event_id": f"e{i:03d}", "detected_at": datetime(2024, 1, 1 + rng.randrange(20)), "table_schema": schema,
            "table_name": table, "column_name": None if change == "NEW_TABLE" else column, "change_type": change,
            "new_data_type": rng.choice(["int", "string", "double"]),
        })
    e = spark.createDataFrame(
        events, "event_id string, detected_at timestamp_ntz, table_schema string, table_name string, "
        "column_name string, change_type string, new_data_type string",
    )
    got = advance_registry(
        local_rows(spark, registry, REGISTRY), e, local_rows(spark, [(*r, 1) for r in columns], COLUMNS)
    ).collect()
    assert len(got) == len({tuple(r)[:3] for r in got})
    assert {tuple(r)[:3]: r.data_type for r in got} == apply_one_by_one(registry, events, columns)


@pytest.mark.parametrize("seed", range(4))
def test_advance_with_a_hot_table(spark, monkeypatch, seed):
    """Most events are of one table: its steps are thinned by the hour, with the same result."""
    rng = random.Random(200 + seed)
    registry, columns = random_catalog(rng), random_catalog(rng)
    events = []
    for i in range(200):
        hot = rng.random() < 0.8
        schema, table, column, _ = ("BRONZE", "T1", rng.choice(["A", "B_ID"]), None) if hot else rng.choice(columns + registry)
        change = rng.choice(["NEW_COLUMN", "NEW_COLUMN", "COLUMN_DROP", "TYPE_CHANGE", "TYPE_CHANGE", "NEW_TABLE"])
        moment = datetime(2024, 1, 1 + rng.randrange(3), rng.randrange(2), rng.randrange(3))
        events.append({
            "event_id": f"e{i:03d}", "detected_at": moment, "table_schema": schema, "table_name": table,
            "column_name": None if change == "NEW_TABLE" else column, "change_type": change,
            "new_data_type": rng.choice(["int", "string", "double"]),
        })
    e = spark.createDataFrame(
        events, "event_id string, detected_at timestamp_ntz, table_schema string, table_name string, "
        "column_name string, change_type string, new_data_type string",
    )
    stored_steps, cut = [], registry_module.cut
    monkeypatch.setattr(registry_module, "HOT_EVENTS", 100)
    monkeypatch.setattr(registry_module, "cut", lambda df, label="cut": stored_steps.append(label) or cut(df, label))
    got = advance_registry(
        local_rows(spark, registry, REGISTRY), e, local_rows(spark, [(*r, 1) for r in columns], COLUMNS)
    ).collect()
    assert "steps" in stored_steps
    assert len(got) == len({tuple(r)[:3] for r in got})
    assert {tuple(r)[:3]: r.data_type for r in got} == apply_one_by_one(registry, events, columns)


def test_steps_of_a_hot_column_are_thinned(spark, monkeypatch):
    monkeypatch.setattr(registry_module, "HOT_EVENTS", 1000)
    n = F.col("id")
    kinds = F.array(F.lit("NEW_COLUMN"), F.lit("TYPE_CHANGE"), F.lit("COLUMN_DROP"))
    events = spark.range(20_000).select(
        F.lit("BRONZE").alias("table_schema"), F.when(n % 4 > 0, "HOT").otherwise(F.concat(F.lit("T"), n)).alias("table_name"),
        F.lit("A").alias("column_name"), F.element_at(kinds, (n % 3 + 1).cast("int")).alias("change_type"),
        F.lit("int").alias("data_type"),
        F.struct(
            F.timestamp_seconds(n * 10).cast("timestamp_ntz").alias("detected_at"), n.cast("string").alias("event_id")
        ).alias("pos"),
    )
    hot = registry_module._hot_tables(events)
    rows = registry_module._thinned(events, hot).groupBy("table_name").count().collect()
    counts = {r.table_name: r["count"] for r in rows}
    assert hot.count() == 1 and counts.pop("HOT") <= 3 * 56 and sum(counts.values()) == 5000


def test_unknown_event_changes_nothing(spark):
    none = spark.createDataFrame([], EVENT_SCHEMA)
    registry = baseline(spark)
    assert sorted(advance_registry(registry, none, columns_of(spark, bronze(spark))).collect()) == sorted(registry.collect())


def test_key_and_spec(spark):
    rows = [
        ("BRONZE", "SHIPMENTS", c, "string", i)
        for i, c in enumerate(["_SNOWFLAKE_ID", "CARRIER", "Shipment_Id", "ORDER_ID", "PAYLOAD__ID"], start=1)
    ] + [("BRONZE", "PLAIN", "CODE", "int", 1), ("BRONZE", "PLAIN", "NAME", "string", 2)]
    columns = spark.createDataFrame(rows, COLUMNS)
    assert {r.table_name: r.primary_key for r in infer_primary_key(columns).collect()} == {
        "SHIPMENTS": "Shipment_Id", "PLAIN": "CODE",
    }
    spec = new_table_spec(columns).filter("table_name = 'SHIPMENTS'").orderBy("ordinal_position").collect()
    assert [r.column_name for r in spec] == ["CARRIER", "Shipment_Id", "ORDER_ID"]
    assert {(r.silver_model_path, r.primary_key) for r in spec} == {("models/silver/shipments.sql", "Shipment_Id")}
    wide = spark.createDataFrame([("BRONZE", "W", f"C{i}", "int", i) for i in range(1, 2501)], COLUMNS)
    assert [r.column_name for r in new_table_spec(wide).orderBy("ordinal_position").collect()] == [f"C{i}" for i in range(1, 2501)]


def test_docs_and_sources(spark):
    docs = spark.createDataFrame(
        [("orders", "ORDER_ID", "id", ["unique"]), ("orders", "CHANNEL", "c", ["not_null"]), ("orders", "Back", "b", ["unique"]), ("items", "Qty", "q", [])],
        "model string, column_name string, description string, tests array<string>",
    )
    schema = "event_id string, detected_at timestamp_ntz, table_name string, column_name string, change_type string"
    day = datetime(2024, 1, 1)
    events = spark.createDataFrame(
        [
            ("1", day, "ORDERS", "channel", "COLUMN_DROP"),
            ("2", day, "ORDERS", "DISCOUNT", "NEW_COLUMN"),
            ("3", day, "ITEMS", "QTY", "NEW_COLUMN"),
            ("4", day, "UNKnow()N", "X", "NEW_COLUMN"),
            ("5", day, "ORDERS", "ORDER_ID", "TYPE_CHANGE"),
            ("6", day, "SHIPMENTS", None, "NEW_TABLE"),
            ("7", day, "Orders", None, "NEW_TABLE"),
            ("8", day, "ORDERS", "BACK", "COLUMN_DROP"),
            ("9", day, "ORDERS", "back", "NEW_COLUMN"),
            ("91", day, "ITEMS", "Gone", "NEW_COLUMN"),
            ("92", day, "ITEMS", "gone", "COLUMN_DROP"),
        ],
        schema,
    )
    got = {(r.model, r.column_name): (r.description, r.tests) for r in sync_docs(docs, events).collect()}
    assert got == {
        ("orders", "ORDER_ID"): ("id", ["unique"]),
        ("orders", "DISCOUNT"): ("Column added to ORDERS by schema drift; review/extend tests as needed.", []),
        ("orders", "BACK"): ("Column added to ORDERS by schema drift; review/extend tests as needed.", []),
        ("items", "Qty"): ("q", []),
    }
    sources = spark.createDataFrame([("bronze", "orders"), ("other", "shipments")], "source string, table_name string")
    declared = {tuple(r) for r in declare_sources(sources, events).collect()}
    assert declared == {("bronze", "orders"), ("other", "shipments"), ("bronze", "shipments")}
