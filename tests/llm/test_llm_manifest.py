"""The manifest against a tree built in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest
from llm_data import awkward, empty, with_clashes
from pyspark.sql import functions as F

from compare import compare, connect
from tidemark.llm import manifest
from tidemark.llm.queries import ORACLES, QUERIES


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(digests: list[str], fan: int):
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, a in enumerate(at):
            start = a // fan * fan
            paths[i].append(("".join(digests[start:a]), "".join(digests[a + 1 : start + fan])))
            at[i] = a // fan
        digests = [sha(*digests[i : i + fan]) for i in range(0, len(digests), fan)]
    return digests[0], paths


def brute(rows: list[tuple], fan: int = 8) -> list[tuple]:
    langs: dict = {}
    for row in rows:
        langs.setdefault(row[2], []).append(row)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    tops, ways = {}, {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        tops[lang], ways[lang] = tree([leaf(r) for r in langs[lang]], fan)
    root, above = tree([tops[x] for x in order], fan)
    out = []
    for lang, upper in zip(order, above):
        for row, way in zip(langs[lang], ways[lang]):
            now = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                now = (*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]))
            fold = leaf(now)
            for left, right in way + upper:
                fold = sha(left, fold, right)
            out.append((row[0], leaf(row), tops[lang], root, sha(*[a + b for a, b in way + upper]), fold, fold == root))
    return out


def both(docs, fan: int = 8):
    got = manifest.manifest(docs, manifest.lowered(), manifest.chosen(), fan).drop("path")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    return sorted(map(tuple, got.collect()), key=str), sorted(brute(rows, fan), key=str)


@pytest.mark.parametrize("fan", [2, 8])
def test_equals_brute_force_with_nulls_ties_repeats_and_clashing_names(spark, fan):
    got, want = both(with_clashes(awkward(spark)), fan)
    assert got == want


@pytest.mark.parametrize("rows", [1, 7, 8, 9, 64, 65, 513])
def test_runs_of_every_size(spark, rows):
    docs = spark.range(rows).select(
        (F.col("id") * 3).alias("doc_id"), F.concat(F.lit("Text "), F.col("id")).alias("text"), F.when(F.col("id") < 2, "a").otherwise("b").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars")
    )
    got, want = both(docs)
    assert got == want


def test_many_languages_have_a_tree_of_their_own(spark):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.lit("T").alias("text"), F.when(F.col("id") % 100 != 7, F.concat(F.lit("é"), F.col("id") % 100)).alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars")
    )
    got, want = both(docs)
    assert got == want


def test_only_tampered_rows_fail(spark):
    docs = awkward(spark).where("doc_id < 40").withColumn("text", F.concat(F.lit("A "), "text"))
    rows = manifest.manifest(docs, manifest.lowered(), manifest.chosen()).collect()
    assert {r["doc_id"] for r in rows if not r["verified"]} == {i for i in range(40) if zlib.crc32(str(i).encode()) % 3 == 0}
    assert all(r["verified"] for r in manifest.manifest(docs).collect())


def test_a_null_text_and_an_empty_one_differ(spark):
    rows = spark.createDataFrame([(1, None, None, None, None), (1, "", "", "", None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r["leaf"] for r in manifest.manifest(rows).collect()}
    assert got == {sha("1:1", "-", "-", "-", "-"), sha("1:1", "0:", "0:", "-", "0:")}


def test_empty_table(spark):
    assert manifest.manifest(empty(spark), manifest.lowered(), manifest.chosen()).count() == 0


def test_a_text_of_tens_of_megabytes(spark):
    docs = spark.createDataFrame([(1, "Ab c" * 6_000_000, "en", "s", 1), (2, "x", "en", "s", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got, want = both(docs)
    assert got == want


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    name = "op11_merkle_manifest"
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


def test_sql_crc_is_that_of_the_id():
    sql = ORACLES["op11_merkle_manifest"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT range * 977 AS doc_id, 'ABC' AS text, 'en' AS lang, 's' AS source, 1::BIGINT AS n_chars FROM range(200)")
    failed = {r[0] for r in con.execute(sql).fetchall() if not r[-1]}
    assert failed == {i * 977 for i in range(200) if zlib.crc32(str(i * 977).encode()) % 3 == 0}
