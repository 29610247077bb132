"""Tests that follow changes give the report of a whole scan after each of them."""

from __future__ import annotations

import random

import pytest

from tidemark.operators.quality import duplicate_keys, orphan_counts
from tidemark.session import local_rows
from tidemark.streaming.checks import RelationshipTest, UniqueTest, key_counts

KEYS = "a int, b string"


def rows(df):
    return sorted(map(tuple, df.collect()))


def change(held, rng, make, n):
    """Some rows taken away and some added; returns both and what is held then."""
    gone = rng.sample(held, min(len(held), n // 3))
    new = [make() for _ in range(n)]
    left = list(held)
    for r in gone:
        left.remove(r)
    return gone, new, left + new


def test_duplicates_after_each_change(spark, tmp_path):
    rng, held = random.Random(6), []
    schema = local_rows(spark, [], KEYS).schema
    test = UniqueTest(str(tmp_path), schema, 4)
    for batch in range(4):
        gone, new, held = change(held, rng, lambda: (rng.choice([None, *range(12)]), rng.choice([None, "x", "y"])), 14)
        for _ in range(1 + (batch == 2)):  # a repeated batch
            test.apply(local_rows(spark, gone, KEYS), local_rows(spark, new, KEYS), batch)
        assert rows(test.report(spark)) == rows(duplicate_keys(local_rows(spark, held, KEYS), ["a", "b"]))


def test_orphans_after_each_change_of_either_table(spark, tmp_path):
    rng, child, parent = random.Random(7), [], []
    test = RelationshipTest(str(tmp_path), local_rows(spark, [], "v int").schema["v"].dataType, 4)
    for batch in range(4):
        lost, found, child = change(child, rng, lambda: (rng.choice([None, *range(20)]),), 12)
        away, come, parent = change(parent, rng, lambda: (rng.choice([None, *range(20)]),), 9 if batch != 2 else 0)
        tables = [local_rows(spark, r, "v int") for r in (lost, found, away, come)]
        test.apply((tables[0], tables[1]), (tables[2], tables[3]), "v", "v", batch)
        assert rows(test.report(spark)) == rows(orphan_counts(local_rows(spark, child, "v int"), "v", local_rows(spark, parent, "v int"), "v"))


@pytest.mark.parametrize("keys", [[(5, "x")]])
def test_only_the_buckets_of_moved_keys_are_read(spark, tmp_path, keys):
    schema = local_rows(spark, [], KEYS).schema
    test, none = UniqueTest(str(tmp_path), schema, 16), local_rows(spark, [], KEYS)
    test.apply(none, local_rows(spark, [(i, "x") for i in range(200)], KEYS), 0)
    test.apply(none, local_rows(spark, keys, KEYS), 1)
    log = key_counts(f"{tmp_path}/counts", schema, 16)
    asked = log.read(spark, 2, log.buckets_of(local_rows(spark, keys, KEYS)))
    assert len({f.split("bucket=")[1].split("/")[0] for f in asked.inputFiles()}) == 1
    assert rows(test.report(spark)) == [(5, "x", 2)]
