from __future__ import annotations

import random

import numpy as np
from llm_data import awkward, brute_components, brute_fingerprint, empty, prose, with_clashes
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_fingerprints_follow_their_definition():
    for text in [None, "", " \n", "A", "a b", "A b C", "a B c d", "Ä ä b " * 9, prose("en", 500), "the the the the the " * 40]:
        assert simhash.fingerprint(text.encode() if text is not None else None) == brute_fingerprint(text)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs}
    component = brute_components(sorted(expected.items()))
    got = QUERIES["op3_simhash_near_dedup"](spark, SF).collect()
    assert len(got) == len(docs)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {(i, f"{f:016x}", component[i]) for i, f in expected.items()}


def test_tiles_find_what_all_pairs_find(spark, monkeypatch):
    """Clusters, chains, and random fingerprints over many small tiles."""
    monkeypatch.setattr(simhash, "LEAST_TILE", 16)
    monkeypatch.setattr(simhash, "TILE", 1)
    draw = random.Random(3)
    prints = {0, (1 << 64) - 1}
    for _ in range(25):
        value = draw.getrandbits(64)
        for _ in range(12):
            prints.add(value)
            for bit in draw.sample(range(64), draw.randint(1, 4)):
                value ^= 1 << bit
    rows = [(i, int(np.uint64(v).view(np.int64))) for i, v in enumerate(sorted(prints, key=lambda v: v * 7919 % 10007))]
    table = spark.createDataFrame(rows + [(1000, rows[0][1]), (None, rows[1][1])], "doc_id bigint, fp bigint")
    component = brute_components([(i, v & (1 << 64) - 1) for i, v in rows])
    got = {r["fp"]: r["component_id"] for r in simhash.classes(table).collect()}
    assert got == {v: component[i] for i, v in rows}


def test_dense_group_gives_few_links():
    values = np.unique(np.array([1 << a | 1 << b for a in range(40) for b in range(a)], np.uint64))
    member, first = simhash.group_within(values, 0, 4)
    assert len(member) == len(values) - 1 and set(first.tolist()) == {int(values[0])}
    member, first = simhash.group_within(values, 300, 4)
    assert len(member) == len(values) - 1


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = simhash.near_duplicates(with_clashes(docs)).collect()
    assert len(got) == docs.count()
    blank = {r["component_id"] for r in got if r["fingerprint"] == "0" * 16}
    assert blank == {100}
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_one_row_of_each_group_stays(spark):
    docs = awkward(spark)
    source = with_clashes(docs).withColumn("twice", F.explode(F.array(F.lit(1), F.lit(1)))).drop("twice")
    kept = simhash.first_of_each(source)
    assert kept.columns == source.columns
    named = {(r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i in named if i is not None)
    assert simhash.first_of_each(empty(spark)).count() == 0
    lone = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (None, "f g h i j k"), (3, "q"), (2, "q")], "doc_id bigint, text string")
    assert sorted((str(r[0]), r[1]) for r in simhash.first_of_each(lone).collect()) == [("2", "q"), ("None", "a b c d e"), ("None", "f g h i j k")]
