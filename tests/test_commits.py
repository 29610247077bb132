"""Commit records: all tables or none, whatever breaks, and writers that meet."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from retail import bronze

from tidemark.plans.cycle import ARTIFACTS, CHANGES, DOCS, REGISTRY, SOURCES, Cycle
from tidemark.plans.retail import COLUMN_DOCS, MODELS
from tidemark.session import local_rows
from tidemark.sources import tables
from tidemark.sources.tables import Conflict, KeyedLog, Transaction, Warehouse, claim, put_once

TABLES = (ARTIFACTS, CHANGES, DOCS, REGISTRY, SOURCES, "silver.orders", "gold.orders_daily", "silver.customers")
KV = "k int, v string"


def now():
    return F.lit("2024-06-01").cast("timestamp_ntz")


def rows(df):
    return sorted(map(tuple, df.collect()))


def kv(spark, *pairs):
    return local_rows(spark, list(pairs), KV)


def state(cycle):
    """All tables and the events, as one value."""
    held = {t: sorted(map(str, cycle.warehouse.read(cycle.spark, t).collect())) if cycle.warehouse.exists(cycle.spark, t) else None for t in TABLES}
    return held | {"events": sorted(map(str, cycle.events().collect()))}


def test_a_merge_that_breaks_at_any_step_leaves_all_tables_as_they_were(spark, tmp_path, monkeypatch):
    sources = bronze(spark)
    cycle = Cycle(spark, Warehouse(str(tmp_path)), dict(MODELS), "SHOP", COLUMN_DOCS)
    cycle.set_up(sources, now())
    sources["bronze.orders"] = sources["bronze.orders"].withColumn("gift", F.lit("G"))
    cycle.check(sources, now())
    event_id = cycle.prepare_next(sources, now())
    before = state(cycle)

    class Broken(Exception):
        pass

    # Every step of a merge takes a number or puts a record: break the n-th, before it and after it, until none is left.
    real, left = tables.put_once, [0, True]

    def breaking(session, path, text):
        left[0] -= 1
        if left[0] == 0 and left[1]:
            raise Broken
        put = real(session, path, text)
        if left[0] == 0:
            raise Broken
        return put

    monkeypatch.setattr(tables, "put_once", breaking)
    steps, outcomes = 0, []
    while True:
        steps += 1
        left[:] = [steps, steps % 2 == 1]
        try:
            cycle.merge(event_id, sources, now())
            break
        except Broken:
            left[0] = 0
            outcomes.append(state(cycle) == before)
            if not outcomes[-1]:
                break
    left[0] = 0
    monkeypatch.undo()
    assert steps >= 9 and all(outcomes[:-1])
    # A merge that broke after its commit has happened as a whole; running it again changes nothing more.
    cycle.merge(event_id, sources, now())
    after = state(cycle)
    assert after != before and "gift" in cycle.warehouse.read(spark, "silver.orders").columns
    assert {e.status for e in cycle.events().collect()} == {"RESOLVED"}
    assert ("GIFT",) in {(r.column_name,) for r in cycle.warehouse.read(spark, REGISTRY).collect()}
    assert cycle.warehouse.read(spark, CHANGES).count() == 1
    assert cycle.merge(event_id, sources, now()) is None and state(cycle) == after


def test_readers_see_all_tables_of_a_transaction_or_none(spark, tmp_path):
    wh = Warehouse(str(tmp_path))
    wh.write(spark, "silver.a", kv(spark, (1, "old")))
    tx = wh.begin(spark)
    tx.write(spark, "silver.a", kv(spark, (1, "new")))
    tx.write(spark, "silver.b", kv(spark, (2, "new")))
    assert rows(tx.read(spark, "silver.a")) == [(1, "new")] and tx.exists(spark, "silver.b")
    assert rows(wh.read(spark, "silver.a")) == [(1, "old")] and not wh.exists(spark, "silver.b")
    tx.commit(spark)
    assert rows(wh.read(spark, "silver.a")) == [(1, "new")] and rows(wh.read(spark, "silver.b")) == [(2, "new")]
    assert wh.record(spark, 1).tables == {"SILVER/a": 1}
    with pytest.raises(RuntimeError, match="committed"):
        tx.commit(spark)


def test_transactions_on_different_tables_are_both_kept_and_on_one_the_second_conflicts(spark, tmp_path):
    wh = Warehouse(str(tmp_path))
    for name in ("a", "b"):
        wh.write(spark, name, kv(spark, (0, name)))
    one, two, three = (wh.begin(spark) for _ in range(3))
    one.append(spark, "a", kv(spark, (1, "x")))
    two.append(spark, "b", kv(spark, (2, "y")))
    three.append(spark, "a", kv(spark, (3, "z")))
    one.commit(spark)
    two.commit(spark)
    with pytest.raises(Conflict, match="a has a newer version"):
        three.commit(spark)
    assert rows(wh.read(spark, "a")) == [(0, "a"), (1, "x")] and rows(wh.read(spark, "b")) == [(0, "b"), (2, "y")]


def test_appends_from_many_threads_are_all_kept(spark, tmp_path):
    wh = Warehouse(str(tmp_path))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: wh.attempt(spark, lambda tx: tx.append(spark, "t", kv(spark, (i, "r"))), 50), range(8)))
    assert rows(wh.read(spark, "t")) == [(i, "r") for i in range(8)]


def test_a_number_is_given_once(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda _: claim(spark, str(tmp_path / "t"), "v"), range(24)))
    assert sorted(numbers) == list(range(1, 25))
    assert put_once(spark, f"file://{tmp_path}/one", "a") and not put_once(spark, str(tmp_path / "one"), "b")
    assert tables.read_file(spark, str(tmp_path / "one")) == "a"
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")] == []


def log_of(warehouse):
    return KeyedLog(warehouse, "config.events", T.StructType.fromDDL(KV), "k")


def test_newest_state_counts_and_folding_keeps_it(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FOLD", 3)
    wh = Warehouse(str(tmp_path))
    log, want = log_of(wh), {}
    for i in range(11):
        log.append(spark, kv(spark, (i % 4, f"s{i}"), (10 + i, "once")))
        want |= {i % 4: f"s{i}", 10 + i: "once"}
        assert rows(log.newest(spark)) == sorted(want.items())
        assert len(wh.record(spark).logs["config.events"]) <= 4


def test_two_writers_of_a_log(spark, tmp_path):
    wh = Warehouse(str(tmp_path))
    log_of(wh).append(spark, kv(spark, (1, "a"), (2, "a")))
    one, two, three, four = (wh.begin(spark) for _ in range(4))
    log_of(one).append(spark, kv(spark, (1, "b")))
    log_of(two).append(spark, kv(spark, (2, "c")))
    log_of(three).append(spark, kv(spark, (1, "lost")))
    log_of(four).append(spark, kv(spark, (9, "new")), alone=True)
    one.commit(spark)
    two.commit(spark)
    for late in (three, four):
        with pytest.raises(Conflict):
            late.commit(spark)
    assert rows(log_of(wh).newest(spark)) == [(1, "b"), (2, "c")]


def test_a_fold_meets_a_writer(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FOLD", 2)
    wh = Warehouse(str(tmp_path))
    log = log_of(wh)
    log.append(spark, kv(spark, (1, "a")))
    log.append(spark, kv(spark, (2, "a")))
    slow = wh.begin(spark)
    log_of(slow).append(spark, kv(spark, (3, "slow")))  # folds what it saw
    log.append(spark, kv(spark, (2, "b")))  # folds too, and is first
    slow.commit(spark)
    assert rows(log.newest(spark)) == [(1, "a"), (2, "b"), (3, "slow")]


def test_a_marked_batch_is_stored_once(spark, tmp_path):
    log = log_of(Warehouse(str(tmp_path)))
    assert log.append(spark, kv(spark, (1, "a")), mark=("s", 0))
    assert not log.append(spark, kv(spark, (1, "again")), mark=("s", 0))
    assert log.append(spark, kv(spark, (1, "b")), mark=("s", 1))
    assert rows(log.newest(spark)) == [(1, "b")]


def test_check_and_poll_at_a_time_keep_each_other_s_states(spark, tmp_path, monkeypatch):
    """A check reads the events, a review closes one, the check writes: it looks again, and both are there."""
    sources = bronze(spark)
    cycle = Cycle(spark, Warehouse(str(tmp_path)), {k: MODELS[k] for k in ("silver.orders",)}, "SHOP")
    cycle.set_up(sources, now())
    sources["bronze.orders"] = sources["bronze.orders"].withColumn("gift", F.lit("G"))
    cycle.check(sources, now())
    event_id = cycle.prepare_next(sources, now())
    reviews = local_rows(spark, [(f"schema-change/{event_id}", 1, None, "closed")], "branch_name string, position int, merged_at timestamp_ntz, state string")
    sources["bronze.orders"] = sources["bronze.orders"].withColumn("card", F.lit("C"))
    real, meet = Transaction.commit, [True]

    def met(tx, session):
        if meet[0]:
            meet[0] = False
            cycle.poll(reviews, sources, now())
        return real(tx, session)

    monkeypatch.setattr(Transaction, "commit", met)
    cycle.check(sources, now())
    monkeypatch.undo()
    got = {(e.column_name, e.pipeline_status, e.branch_name) for e in cycle.events().collect()}
    assert got == {("GIFT", "PENDING", None), ("CARD", "PENDING", None)}
