"""Inserts that look only where they must, and snapshots compared only where they differ."""

from __future__ import annotations

import random
import shutil

import pytest
from pyspark.sql import functions as F

from tidemark.operators import mutate
from tidemark.operators.drift import snapshot_diff
from tidemark.session import local_rows
from tidemark.sources import keyed
from tidemark.sources.keyed import KeyedTable, Snapshots
from tidemark.sources.tables import Conflict, Warehouse

KV = "k int, s string, v double"


def rows(df):
    return sorted(map(str, df.collect()))


def test_inserts_equal_those_into_plain_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "FOLD", 3)
    held = KeyedTable(Warehouse(str(tmp_path)), "silver.t", ("k", "s"), expected=200)
    rng, plain = random.Random(2), None
    for batch in range(6):
        own = [(rng.choice([None, *range(40)]), rng.choice([None, "a", "b"]), float(i)) for i in range(25)]
        df = local_rows(spark, own, KV)
        order = [F.col("v")]
        given = held.insert_ignore(spark, df, order)
        if plain is None:
            plain = mutate.insert_ignore(df.limit(0), df, ["k", "s"], order).collect()
        else:
            plain = mutate.insert_ignore(spark.createDataFrame(plain, KV), df, ["k", "s"], order).collect()
        assert rows(held.read(spark)) == sorted(map(str, plain))
        assert given.held <= given.asked <= given.given and given.added == given.given - sum(1 for _ in range(given.held))
    held.rebuild(spark, 5000)
    again = held.insert_ignore(spark, local_rows(spark, [(1, "a", 0.0), (99, "z", 0.0)], KV), [F.col("v")])
    assert (again.added, again.held) == (1, 1)


def test_a_batch_of_new_keys_does_not_look_at_the_table(spark, tmp_path):
    """The rows are taken away; new keys still go in. The share of false hits is what 16 bits a key give."""
    held = KeyedTable(Warehouse(str(tmp_path)), "silver.t", ("k",), expected=20_000)
    held.insert_if_absent(spark, spark.range(20_000).select(F.col("id").cast("int").alias("k")))
    some = held.insert_if_absent(spark, spark.range(100_000, 120_000).select(F.col("id").cast("int").alias("k")))
    assert some.held == 0 and some.added == 20_000 and some.asked < 0.01 * 20_000
    known = held.insert_if_absent(spark, spark.range(0, 20_000, 4).select(F.col("id").cast("int").alias("k")))
    assert (known.asked, known.held, known.added) == (5000, 5000, 0)
    few = spark.range(500_000, 500_010).select(F.col("id").cast("int").alias("k"))
    for part in (tmp_path / "PROD" / "SILVER" / "t").glob("batch=*"):
        shutil.rmtree(part)
    new = held.insert_if_absent(spark, few)
    assert (new.given, new.added, new.asked) == (10, 10, 0)


def test_two_writers_do_not_insert_one_key_twice(spark, tmp_path):
    wh = Warehouse(str(tmp_path))
    held = KeyedTable(wh, "silver.t", ("k",), expected=100)
    held.insert_if_absent(spark, local_rows(spark, [(1, "a", 0.0)], KV))
    slow = wh.begin(spark)
    KeyedTable(slow, "silver.t", ("k",), expected=100).insert_if_absent(spark, local_rows(spark, [(2, "slow", 0.0)], KV))
    held.insert_if_absent(spark, local_rows(spark, [(2, "fast", 0.0)], KV))
    with pytest.raises(Conflict):
        slow.commit(spark)
    assert rows(held.read(spark).select("k", "s")) == rows(local_rows(spark, [(1, "a"), (2, "fast")], "k int, s string"))


def test_diff_of_versions_reads_the_buckets_that_differ(spark, tmp_path):
    store = Snapshots(Warehouse(str(tmp_path)), "silver.s", ("k",), buckets=64, fan=4)
    base = spark.range(2000).select(F.col("id").cast("int").alias("k"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("s"), "id")).alias("s"), (F.col("id") / 4).alias("v"))
    changed = base.filter("k <> 11").withColumn("v", F.when(F.col("k") == 500, F.lit(None)).otherwise(F.col("v"))).unionByName(local_rows(spark, [(9001, None, 1.0)], KV))
    one, two, three = store.write(spark, base), store.write(spark, changed), store.write(spark, base.repartition(5).orderBy("v"))
    whole = snapshot_diff(base, changed, ["k"], ["s", "v"])
    assert rows(store.diff(spark, one, two, ["s", "v"])) == rows(whole) and whole.count() == 3
    differing = store.differing(spark, one, two)
    assert 1 <= len(differing) <= 3
    read = {f.split("_bucket=")[1].split("/")[0] for f in store.diff(spark, one, two, ["s", "v"]).inputFiles()}
    assert read == {str(b) for b in differing}
    assert store.differing(spark, one, three) == [] and store.diff(spark, one, three, ["s", "v"]).count() == 0
    assert rows(store.read(spark, two)) == rows(changed)
    assert store.versions(spark) == [one, two, three]


def test_diff_equals_the_full_join_on_random_versions(spark, tmp_path):
    """NULL moved between columns, swapped values, an empty version."""
    store, rng = Snapshots(Warehouse(str(tmp_path)), "silver.s", ("k",), buckets=8, fan=3), random.Random(8)
    versions = [local_rows(spark, [], KV)]
    for _ in range(3):
        versions.append(local_rows(spark, [(k, rng.choice([None, "x", "y"]), rng.choice([None, 1.0, 2.0])) for k in range(60) if rng.random() < 0.8], KV))
    numbers = [store.write(spark, v) for v in versions]
    for i, j in ((0, 1), (1, 2), (2, 3), (3, 0), (0, 0)):
        want = snapshot_diff(versions[i], versions[j], ["k"], ["s", "v"])
        assert rows(store.diff(spark, numbers[i], numbers[j], ["s", "v"])) == rows(want)
