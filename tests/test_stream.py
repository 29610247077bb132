from __future__ import annotations

import math
import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from retail import bronze

from tidemark.operators.cdc import CdcSpec, current_state, newest
from tidemark.operators.events import EVENT_SCHEMA, resolved
from tidemark.plans.retail import MODELS
from tidemark.plans.run import build_all
from tidemark.session import local_rows
from tidemark.sources.tables import Warehouse
from tidemark.sources.tables import KeyedLog
from tidemark.streaming import log as logs
from tidemark.streaming.jobs import GroupLog, bucket_log, compact_state, refresh_downstream, state_log, stored_state, stream_current_state, stream_drift
from tidemark.streaming.log import BatchLog

SPEC = CdcSpec(("k",), "v", "deleted", ("tie",))
SCHEMA = "k int, v int, deleted boolean, tie int"


def changes(seed, n):
    rng = random.Random(seed)
    return [(rng.randrange(8), rng.choice([None, *range(30)]), rng.choice([True, False, None]), i) for i in range(n)]


def drop_files(spark, rows, schema, path, parts):
    size = -(-len(rows) // parts)
    for i in range(parts):
        local_rows(spark, rows[i * size:(i + 1) * size], schema).coalesce(1).write.mode("append").parquet(str(path))


def follow(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


@pytest.mark.parametrize("tombstone_wins", [False, True])
def test_stream_equals_batch(spark, tmp_path, tombstone_wins):
    spec = CdcSpec(("k",), "v", "deleted", ("tie",), tombstone_wins=tombstone_wins)
    rows = changes(1, 40)
    drop_files(spark, rows[:30], SCHEMA, tmp_path / "in", 3)
    stream = follow(spark, SCHEMA, tmp_path / "in")
    log = state_log(stream, str(tmp_path / "log"))

    def run():
        stream_current_state(stream, spec, log, str(tmp_path / "cp")).awaitTermination()

    run()
    want = sorted(current_state(local_rows(spark, rows[:30], SCHEMA), spec).collect())
    assert sorted(stored_state(spark, log, spec).collect()) == want
    # A batch that runs again overwrites its own folder.
    log.write(newest(log.read(spark).filter("v < 3").union(log.read(spark)).distinct(), spec), 1)
    assert sorted(stored_state(spark, log, spec).collect()) == want
    (tmp_path / "log" / "base=2").mkdir()  # a compaction that was broken off
    for _ in range(2):
        compact_state(spark, log, spec)
        assert sorted(stored_state(spark, log, spec).collect()) == want
    assert [p.name for p in (tmp_path / "log").iterdir()] == ["base=2"]
    drop_files(spark, rows[30:], SCHEMA, tmp_path / "in", 1)
    run()
    whole = sorted(current_state(local_rows(spark, rows, SCHEMA), spec).collect())
    assert sorted(stored_state(spark, log, spec).collect()) == whole


def test_unfinished_batches_are_not_read(spark, tmp_path):
    log = BatchLog(str(tmp_path), T.StructType.fromDDL("k int"))
    log.write(local_rows(spark, [(1,)], "k int"), 0)
    (tmp_path / "batch=1").mkdir()
    assert [r.k for r in log.read(spark).collect()] == [1]
    assert log.read(spark, before=0).collect() == []


def test_drift_reports_a_change_once(spark, tmp_path):
    registry = local_rows(spark, [("BRONZE", "T", "A", "int")],
                          "table_schema string, table_name string, column_name string, data_type string")
    schema = "table_schema string, table_name string, column_name string, data_type string, ordinal_position int, seen_at timestamp_ntz"
    day = datetime(2024, 1, 1)
    sightings = [
        ("BRONZE", "T", "A", "int", 1, day), ("BRONZE", "T", "B", "int", 2, day),
        ("BRONZE", "T", "B", "int", 2, day + timedelta(1)), ("BRONZE", "U", "X", "int", 1, day + timedelta(1)),
        ("BRONZE", "T", "A", "string", 1, day + timedelta(2)), ("BRONZE", "U", "X", "int", 1, day + timedelta(2)),
    ]
    drop_files(spark, sightings, schema, tmp_path / "in", 3)
    log = KeyedLog(Warehouse(str(tmp_path / "wh")), "config.events", T.StructType.fromDDL(EVENT_SCHEMA), "event_id")
    spec = CdcSpec(("table_schema", "table_name", "column_name"), "seen_at", None)
    earlier = local_rows(spark, [], "table_schema string, table_name string, column_name string, change_type string, "
                                    "old_data_type string, new_data_type string, status string")
    stream_drift(follow(spark, schema, tmp_path / "in"), registry, earlier, log, str(tmp_path / "cp"),
                 latest=lambda b: newest(b, spec)).awaitTermination()
    got = [(r.table_name, r.column_name, r.change_type, r.status) for r in log.newest(spark).collect()]
    assert sorted(got, key=str) == [
        ("T", "A", "TYPE_CHANGE", "PENDING"), ("T", "B", "NEW_COLUMN", "PENDING"), ("U", None, "NEW_TABLE", "PENDING"),
    ]
    assert len({r.event_id for r in log.newest(spark).collect()}) == 3


def test_gold_follows_each_batch(spark, tmp_path):
    tables = bronze(spark)
    orders = tables["bronze.orders"]
    for part in ("order_id <= 8", "order_id > 8"):
        orders.filter(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = follow(spark, orders.schema, tmp_path / "in")
    log = state_log(stream, str(tmp_path / "log"))
    out = Warehouse(str(tmp_path / "wh"))
    others = {"bronze.customers": tables["bronze.customers"],
              "silver.customers": MODELS["silver.customers"].build(tables)}
    refresh = refresh_downstream(MODELS, "bronze.orders", log, others, out)
    stream_current_state(stream, CdcSpec(("order_id",)), log, str(tmp_path / "cp"), refresh).awaitTermination()
    daily = out.read(spark, "gold.orders_daily").orderBy("order_date").collect()
    assert daily == build_all(MODELS, tables)["gold.orders_daily"].orderBy("order_date").collect()
    versions = [p.name for p in (tmp_path / "wh" / "PROD" / "GOLD" / "orders_daily").iterdir()]
    assert sorted(versions) == ["v=00000001", "v=00000002"]
    assert not (tmp_path / "wh" / "PROD" / "GOLD" / "category_summary").exists()


def test_groups_touched_by_a_batch_are_computed_again(spark, tmp_path):
    """Orders change their day, vanish and arrive late; the aggregate equals one over everything, batch by batch."""
    tables = bronze(spark)
    orders = tables["bronze.orders"]
    later = F.lit("2024-05-01").cast("timestamp_ntz")
    moved = orders.filter("order_id IN (2, 5, 14)").withColumns({"order_date": F.lit("2024-03-10").cast("date"), "_snowflake_updated_at": later})
    gone = orders.filter("order_id = 7").withColumn("_snowflake_deleted", F.lit(True))
    parts = [orders.filter("order_id <= 8"), moved.union(gone), orders.filter("order_id > 8")]
    model = MODELS["gold.orders_daily"]
    customers = MODELS["silver.customers"].build(tables)
    (tmp_path / "in").mkdir()
    stream = follow(spark, orders.schema, tmp_path / "in")
    spec = CdcSpec(("order_id",), tombstone_wins=True)
    log = bucket_log(stream, str(tmp_path / "log"), spec, 4)
    daily = GroupLog(str(tmp_path / "daily"), model, 4)
    row = replace(MODELS["silver.orders"], spec=spec)
    seen = None
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream_current_state(stream, spec, log, str(tmp_path / "cp"), daily.refresh(row, log, customers)).awaitTermination()
        seen = part if seen is None else seen.unionByName(part)
        want = model.build({"silver.orders": row.build({"bronze.orders": seen}), "silver.customers": customers})
        assert sorted(map(str, daily.read(spark).collect())) == sorted(map(str, want.collect()))
    small = spark.read.parquet(str(tmp_path / "daily" / "rows" / "batch=1")).count()
    assert 0 < small < 8


def test_a_folder_of_part_files_is_followed(spark, tmp_path):
    from tidemark.suite.stream import follow_stored

    spark.range(100).repartition(3).write.parquet(str(tmp_path / "folder.parquet"))
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "one"))
    next((tmp_path / "one").glob("*.parquet")).rename(tmp_path / "single.parquet")
    for name, n in (("folder", 100), ("single", 7)):
        log = BatchLog(str(tmp_path / f"log-{name}"), T.StructType.fromDDL("id bigint"))
        query = follow_stored(spark, str(tmp_path), name).writeStream.foreachBatch(lambda df, i, log=log: log.write(df, i))
        query.option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start().awaitTermination()
        assert log.read(spark).count() == n


def test_drift_meets_the_baseline_and_the_events_of_the_moment(spark, tmp_path):
    """Found; resolved with the baseline moved; the column goes elsewhere and comes back: found again."""
    schema = "table_schema string, table_name string, column_name string, data_type string, ordinal_position int, seen_at timestamp_ntz"
    registry_schema = "table_schema string, table_name string, column_name string, data_type string"
    wh = Warehouse(str(tmp_path / "wh"))
    log = KeyedLog(wh, "config.events", T.StructType.fromDDL(EVENT_SCHEMA), "event_id")
    base, with_b = [("BRONZE", "T", "A", "int")], ("BRONZE", "T", "B", "int")
    wh.write(spark, "config.registry", local_rows(spark, base, registry_schema))
    day = datetime(2024, 1, 1)

    def batch(number):
        rows = [("BRONZE", "T", "A", "int", 1, day + timedelta(number)), (*with_b, 2, day + timedelta(number))]
        drop_files(spark, rows, schema, tmp_path / "in", 1)
        stream_drift(
            follow(spark, schema, tmp_path / "in"), lambda tx: tx.read(spark, "config.registry"), None, log, str(tmp_path / "cp"),
            latest=lambda b: newest(b, CdcSpec(("table_schema", "table_name", "column_name"), "seen_at", None)),
        ).awaitTermination()
        return sorted((r.column_name, r.status, r.detected_at.day) for r in log.newest(spark).collect())

    assert batch(0) == [("B", "PENDING", 1)]
    assert batch(1) == [("B", "PENDING", 1)], "an open event is not reported again"

    def resolve(tx):
        mine = log.within(tx)
        mine.append(spark, resolved(mine.newest(spark), F.lit(True), F.lit(day)))
        tx.write(spark, "config.registry", local_rows(spark, [*base, with_b], registry_schema))

    wh.attempt(spark, resolve)
    assert batch(2) == [("B", "RESOLVED", 1)], "the column is registered now"
    wh.write(spark, "config.registry", local_rows(spark, base, registry_schema))
    assert batch(3) == [("B", "PENDING", 4), ("B", "RESOLVED", 1)]


def test_runs_are_folded_when_they_have_grown():
    for sizes, want in (([5], 0), ([11, 5], 0), ([10, 5], 2), ([40, 10, 5], 2), ([30, 10, 5], 3), ([1, 1], 2)):
        assert logs.folds(sizes) == want
    # However batches arrive, a bucket has few runs and a row is rewritten about log times.
    rng = random.Random(4)
    runs, rewritten, total = [], 0, 0
    for _ in range(3000):
        runs.append(rng.choice([1, 1, 3, 20]))
        total += runs[-1]
        n = logs.folds(runs)
        if n:
            rewritten += sum(runs[-n:])
            runs[-n:] = [sum(runs[-n:])]
        assert len(runs) <= math.log2(total) + 1
    assert rewritten / total <= math.log(total, 1.5)


def test_bucket_log_keeps_state_in_few_runs_and_reads_the_buckets_asked_for(spark, tmp_path):
    spec = CdcSpec(("k",), "v", None)
    log = bucket_log(local_rows(spark, [], SCHEMA), str(tmp_path / "log"), spec, 4)
    rows = [(i % 11, i, False, 0) for i in range(60)] + [(None, 3, None, 0)]
    for i in range(0, len(rows), 8):
        part = local_rows(spark, rows[i:i + 8], SCHEMA)
        log.write(newest(part, spec), i // 8)
        if i == 16:  # a repeated batch
            log.write(newest(part, spec), i // 8)
        want = sorted(current_state(local_rows(spark, rows[:i + 8], SCHEMA), spec).collect(), key=str)
        assert sorted(stored_state(spark, log, spec).collect(), key=str) == want
    assert max(len(r) for r in log.runs(spark).values()) <= 3
    assert sum(log.rewritten(spark, b) for b in range(8)) < 3 * len(rows)
    assert sorted(log.read(spark, before=1).collect()) == sorted(newest(local_rows(spark, rows[:8], SCHEMA), spec).collect())
    keys = local_rows(spark, [(3,)], "k int")
    (bucket,) = log.buckets_of(keys)
    some = log.read(spark, buckets=[bucket])
    assert {f.split("bucket=")[1].split("/")[0] for f in some.inputFiles()} == {str(bucket)}
    assert some.filter("k = 3").count() >= 1
    whole = sorted(map(str, stored_state(spark, log, spec).collect()))
    assert log.clean(spark) > 0
    assert sorted(map(str, stored_state(spark, log, spec).collect())) == whole


@pytest.mark.parametrize("name", ["gold.orders_daily", "gold.category_summary"])
def test_counting_equals_recomputation_batch_by_batch(spark, tmp_path, name):
    """Random inserts, moves between groups, deletions, NULLs and odd numbers."""
    model = MODELS[name]
    row = replace(MODELS[model.fact], spec=CdcSpec((model.fact_key,), tombstone_wins=True))
    tables = bronze(spark)
    source = tables[row.source]
    customers = MODELS["silver.customers"].build(tables) if model.dimension else None
    log = bucket_log(source, str(tmp_path / "log"), row.spec, 4)
    groups = GroupLog(str(tmp_path / "sums"), model, 4)
    step = groups.refresh(row, log, customers)
    rng, base, seen = random.Random(11), source.collect(), None
    measured = [c for m in model.measures if m.kind != "count_distinct" for c in m.columns]
    swapped = [g.column for g in model.groups if g.of == "fact"] + [c for c in ("customer_id",) if c in source.columns]
    for batch in range(3):
        rows = []
        for r in rng.sample(base, 10):
            new = r.asDict() | {"_snowflake_updated_at": datetime(2024, 5, 1 + batch), "_snowflake_deleted": rng.random() < 0.2}
            for c in swapped:
                new[c] = rng.choice(base)[c]
            for c in measured:
                odd = [None, float("nan"), float("inf")] if isinstance(new[c], float) else [None]
                new[c] = rng.choice([*odd, 0.1, 0.2, 1e9, new[c]] if isinstance(r[c], float) else [*odd, new[c]])
            rows.append(tuple(new[c] for c in source.columns))
        part = spark.createDataFrame(rows, source.schema)
        log.write(newest(part, row.spec), batch)
        step(spark, batch)
        if batch == 1:  # a repeated batch
            step(spark, batch)
        seen = part if seen is None else seen.unionByName(part)
        inputs = {model.fact: row.build({row.source: seen})} | ({model.dimension: customers} if model.dimension else {})

        def shown(df):
            return sorted(str([float(f"{v:.9g}") if isinstance(v, float) else v for v in r]) for r in df.select(*sorted(df.columns)).collect())

        assert shown(groups.read(spark)) == shown(model.build(inputs))
