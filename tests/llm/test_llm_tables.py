"""Mixing, sharding, nearest neighbours and license scans: SQL, brute force, awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pytest
from compare import compare, connect
from llm_data import awkward, empty, with_clashes
from pyspark.sql import functions as F

from tidemark.llm import ann, license, mixing, sharding
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


def hash_of(doc_id, text):
    whole = ":".join(x for x in (None if doc_id is None else str(doc_id), text) if x is not None)
    return int(hashlib.md5(whole.encode()).hexdigest()[:15], 16)


# Mixing


def brute_targets(sizes: dict) -> dict:
    """Share by weight; whoever is above twice its size stops there; again with the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in stopped]
        rate = left / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if rate * weight[s] > 2 * sizes[s]]
        if not over:
            return stopped | {s: rate * weight[s] for s in rest}
        for s in over:
            stopped[s] = 2.0 * sizes[s]
            left -= 2 * sizes[s]


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 0, None: 7}, {"x": 5}, {"a": 0}, {"a": 1, "b": 2, "c": 3, "d": 1000, "é": 50, "z": 400, None: 9}])
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(table).collect()}
    expected = brute_targets(sizes)
    assert got.keys() == expected.keys() and all(math.isclose(got[s], expected[s], abs_tol=1e-9) for s in got)


def test_mix_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = docs.collect()
    got = mixing.mix(with_clashes(docs)).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes: dict = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += size(r["text"])
    target = brute_targets(sizes)
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(r["doc_id"]), size(r["text"])) for r in rows)
    expected = []
    for source in sizes:
        own = sorted((hash_of(r["doc_id"], r["text"]), size(r["text"])) for r in rows if r["source"] == source)
        copies = int(target[source] // sizes[source]) if sizes[source] else 0
        budget, upto, below = target[source] - copies * sizes[source], 0, 1 << 60
        for h in sorted({h for h, _ in own}):
            here = sum(s for k, s in own if k == h)
            if upto + here > budget:
                below = h + (upto + here - budget < budget - upto)
                break
            upto += here
        expected += [(s, sizes[source], s * (copies + (h < below and budget > 0))) for h, s in own]
    assert sorted((r["size"], r["source_size"], r["taken"]) for r in got) == sorted(expected)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    again = mixing.mix(docs.repartition(9)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(empty(spark)).count() == 0


def test_repeated_rows_are_what_the_mix_takes(spark):
    docs = with_clashes(spark.read.parquet(f"{SF}/documents.parquet"))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    taken = mixing.mix(docs).where("size > 0").select("doc_id", (F.col("taken") / F.col("size")).cast("int").alias("times"))
    expected = {r["doc_id"]: r["times"] for r in taken.collect() if r["times"]}
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == expected
    assert mixing.mixed(empty(spark)).count() == 0


# Sharding


def test_shards_fit_and_only_full_ones_are_split(spark):
    docs = awkward(spark)
    limit = 2000
    rows = docs.collect()
    got = sharding.shards(with_clashes(docs), limit).collect()
    assert len(got) == len(rows)
    keys = defaultdict(list)
    for r in rows:
        keys[f"{hash_of(r['doc_id'], r['text']):060b}"].append(len((r["text"] or "").encode()))
    for r in got:
        inside = {k: v for k, v in keys.items() if k.startswith(r["shard"])}
        total = sum(map(sum, inside.values()))
        assert (r["shard_bytes"], r["shard_rows"], r["depth"]) == (total, sum(map(len, inside.values())), len(r["shard"]))
        assert total <= limit or len(inside) == 1
        if r["shard"]:
            above = {k: v for k, v in keys.items() if k.startswith(r["shard"][:-1])}
            assert sum(map(sum, above.values())) > limit and len(above) > 1
    assert len({r["shard"] for r in got}) > 5
    assert sharding.shards(empty(spark), limit).count() == 0


def test_equal_prefixes_are_split_further(spark):
    """Hashes that agree in their first 40 bits need several rounds."""
    rows = [((5 << 20) + i, 10) for i in range(8)] + [(1 << 59, 10)]
    table = spark.createDataFrame(rows, "hash bigint, bytes bigint")
    got = {r["hash"]: r["depth"] for r in sharding.assign(table, 20).collect()}
    assert got[1 << 59] == 1 and {got[(5 << 20) + i] for i in range(8)} == {59}


def test_written_shards(spark, tmp_path):
    docs = with_clashes(awkward(spark)).drop("shard")
    sharding.write_shards(docs, str(tmp_path / "out"), 2000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select(docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert all(len(list(f.glob("*.parquet"))) == 1 for f in (tmp_path / "out").iterdir() if f.is_dir())
    named = sharding.shards(docs, 2000)
    assert {r[0] for r in back.select("shard").distinct().collect()} == {"b" + r[0] for r in named.select("shard").distinct().collect()}
    by_shard = {r["shard"]: r["n"] for r in back.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    assert by_shard == {"b" + r["shard"]: r["shard_rows"] for r in named.select("shard", "shard_rows").distinct().collect()}
    sharding.write_shards(docs.limit(3), str(tmp_path / "one"))
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "one")).select("shard").distinct().collect()] == ["b"]


def test_the_query_divides_the_given_table(spark):
    larger = "/root/testdata/sf0.01"
    got = QUERIES["op9_sharding"](spark, larger).collect()
    sums: dict[str, list[int]] = {}
    for r in got:
        sums.setdefault(r["shard"], []).append(r["bytes"])
    assert len(got) == spark.read.parquet(f"{larger}/documents.parquet").count() and len(sums) > 1 and "" not in sums
    assert all(sum(b) <= 1 << 20 or len(b) == 1 for b in sums.values())


# Nearest neighbours


def brute_nearest(vectors: dict, every: int, k: int) -> dict:
    ids = np.array(sorted(vectors))
    table = np.array([vectors[i] for i in ids], float)
    unit = table / np.sqrt((table * table).sum(1))[:, None]
    out = {}
    for q in ids[ids % every == 0]:
        score = unit @ unit[np.searchsorted(ids, q)]
        best = [(-s, i) for s, i in zip(score.tolist(), ids.tolist()) if i != q]
        out[int(q)] = sorted(best)[:k]
    return out


def recall(got, expected) -> float:
    found = defaultdict(set)
    for r in got:
        found[r["query_id"]].add(r["vec_id"])
    return sum(len(found[q] & {i for _, i in best}) for q, best in expected.items()) / sum(map(len, expected.values()))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_and_exact_scores(spark, sf):
    path = f"/root/testdata/{sf}"
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()}
    got = QUERIES["op10_nearest_neighbours"](spark, path).collect()
    expected = brute_nearest(vectors, 50, 5)
    assert len(got) == sum(map(len, expected.values()))
    assert recall(got, expected) >= 0.95
    by_query = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_query[r["query_id"]].append((-r["score"], r["vec_id"], r["rank"]))
        a, b = np.array(vectors[r["query_id"]], float), np.array(vectors[r["vec_id"]], float)
        assert abs(r["score"] - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
    for rows in by_query.values():
        assert [k for *_, k in rows] == [1, 2, 3, 4, 5] and [x[:2] for x in rows] == sorted(x[:2] for x in rows)


def test_probing_finds_every_code_within_the_radius():
    draw = np.random.default_rng(1)
    codes = draw.integers(0, 1 << 63, 500, dtype=np.uint64)
    codes[100:200] = codes[0] ^ (np.uint64(1) << draw.integers(0, 63, 100, dtype=np.uint64))
    block = ann.Block(np.arange(500), draw.standard_normal((500, 8)), codes)
    for radius in (0, 1, 3, 4, 11, 20, 29, 64):
        for at in (0, 150, 499):
            expected = np.flatnonzero(np.bitwise_count(codes ^ codes[at]) <= radius)
            assert block.within(codes[at : at + 1], radius).tolist() == expected.tolist()


def test_ties_and_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (50, [1.0, 1.0]), (7, [2.0, 0.0]), (3, [4.0, 0.0]), (9, [0.0, 1.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0]),
        (100, None), (150, [0.0, 0.0]), (200, [nan, 1.0]), (250, [inf, 1.0]), (300, [None, 1.0]), (350, []), (400, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]),
        (11, [1e-30, 1e-30]), (50, [1.0, 1.0]),
    ]
    table = spark.createDataFrame([(i, v, f"own {i}", 1) for i, v in rows], "vec_id bigint, embedding array<float>, code string, score int")
    got = defaultdict(list)
    for r in sorted(ann.nearest(table).collect()):
        got[r["query_id"]].append((r["vec_id"], round(r["score"], 9)))
    half = round(math.sqrt(0.5), 9)
    assert got == {0: [(3, 1.0), (4, 1.0), (4, 1.0), (7, 1.0), (11, half)], 50: [(11, 1.0), (0, half), (3, half), (4, half), (4, half)]}
    few = ann.nearest(table.where("vec_id in (0, 3, 9)")).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in few) == [(1, 3, 1.0), (2, 9, 0.0)]
    assert ann.nearest(table.limit(0)).count() == 0 and ann.nearest(table.where("vec_id = 0")).count() == 0


def test_blocks_give_what_one_block_gives(spark, monkeypatch):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    whole = sorted(map(str, ann.nearest(rows).collect()))
    monkeypatch.setattr(ann, "LEAST_BLOCK", 8)
    monkeypatch.setattr(ann, "BLOCK", 2)
    assert sorted(map(str, ann.nearest(rows).collect())) == whole


def test_each_length_is_searched(spark, monkeypatch):
    """Three lengths, one of them rare, against brute force; an id with two lengths is asked once."""
    monkeypatch.setattr(ann, "LEAST_BLOCK", 64)
    draw = np.random.default_rng(4)
    of_length = {d: {i: draw.standard_normal(d).tolist() for i in ids} for d, ids in ((6, range(0, 600)), (9, range(1000, 1400)), (4, range(2000, 2051)))}
    of_length[4][50] = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, v) for own in of_length.values() for i, v in own.items()]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), sample=300).collect()
    expected = {}
    for d, own in of_length.items():
        expected |= {q: best for q, best in brute_nearest(own, 50, 5).items() if d == 4 or q != 50}
    assert recall(got, expected) >= 0.95 and len(got) == sum(map(len, expected.values()))
    rare = [(r["query_id"], r["vec_id"]) for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])) if r["query_id"] in (50, 2000, 2050)]
    assert rare == [(q, i) for q in (50, 2000, 2050) for _, i in expected[q]]


# License scans


def test_every_template_finds_itself():
    items = tuple(license.TEMPLATES.items())
    for name, text in items:
        assert license.CUE.search(text), name
        for wrapped in (text, f"words before it\n{text.upper()}\nand words after", text.replace(" ", "\n  * ")):
            assert [(x[2], x[4], x[5]) for x in license.find(wrapped, items)] == [(name, 0, 0)], (name, wrapped)


def test_changed_wording():
    items = tuple(license.TEMPLATES.items())
    bsd = license.TEMPLATES["BSD"]
    changed = bsd.replace("source and binary", "source or binary")
    assert [(x[2], x[4], x[5]) for x in license.find(f"a {changed} b", items)] == [("BSD", 1, 1)]
    assert license.find("You need a license to drive; the copyright office is closed.", items) == []
    assert license.find("Licensed under the", items) == []
    two = "Released under the MIT License. " + "word " * 10 + "Licensed under CC BY-NC 4.0."
    assert [x[2] for x in license.find(two, items)] == ["MIT-notice", "CC-BY-NC-4.0-notice"]
    far = "Released under the MIT License. " + "word " * 900 + "Released under the MIT License."
    assert [(x[0], x[2]) for x in license.find(far, items)] == [(0, "MIT-notice"), (len(far) - 31, "MIT-notice")]


CHANGED = {
    "This project is licensed under the MIT License": "MIT-notice",
    "Distributed under the MIT License": "MIT-notice",
    "Made available under the terms of the MIT licence": "MIT-notice",
    "Released under our MIT License": "MIT-notice",
    "Licensed under the Apache License 2.0": "Apache-2.0-notice",
    "Apache License, v2.0": "Apache-2.0-notice",
    "Licensed under the Apache License, Version 1.1": None,
    "Released under the XYZ License.": None,
    "Licensed under the GNU General Public License version 3": "GPL-3.0-notice",
    "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0-notice",
    "This work is licensed under the GNU General Public License, version 1.": None,
    "Licensed under CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0-notice",
    "Licensed under CC BY-SA 3.0": None,
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "CC-BY-ND-4.0-notice",
    "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0-notice",
    "This program is made available under the terms of the Eclipse Public License 2.0": "EPL-2.0-notice",
    "This is the MIT campus; released under the old elms.": None,
}


def test_changed_notices_are_found(spark):
    """One generic word of a short notice may differ, its name and version may not."""
    padded = [(i, f"some words before {x} and others after it") for i, x in enumerate(CHANGED)]
    got = defaultdict(list)
    for r in license.scan(spark.createDataFrame(padded, "doc_id bigint, text string")).collect():
        got[r["doc_id"]].append(r["license"])
    assert {x: got[i] for i, x in enumerate(CHANGED)} == {x: [n] if n else [] for x, n in CHANGED.items()}
    items = (*license.TEMPLATES.items(), *license.NOTICES)
    for name, text in items:
        assert [(x[2], x[4], x[5]) for x in license.find(f"words before {text} words after", items)] == [(name, 0, 0)], text


def test_every_template_has_its_own_cues(spark):
    zlib = "This software is provided 'as-is', without any express or implied warranty."
    docs = spark.createDataFrame([(1, f"a b {zlib} c d"), (2, f"a {zlib.replace('warranty', 'promise')} b"), (3, "Published under CC BY-SA 4.0")], "doc_id bigint, text string")
    assert [tuple(r)[:2] for r in license.scan(docs, {"Z": zlib}).orderBy("doc_id").collect()] == [(1, "Z"), (2, "Z")]
    assert [tuple(r)[:2] for r in license.scan(docs.where("doc_id = 3")).collect()] == [(3, "CC-BY-SA-4.0-notice")]
    with pytest.raises(ValueError):
        license.scan(docs, {"none": "..."})
    for name, text in (*license.TEMPLATES.items(), *license.NOTICES):
        words = license._words(text)
        telling, needed, most = license.cues(words), license.fixed(words), license.allowed(len(words))
        assert telling & needed or len(telling) > most
    changed = {"BSD": "Redistribution", "Unlicense": "unencumbered", "CC0-1.0": "copyright"}
    for name, cue in changed.items():
        text = license.TEMPLATES[name].replace(cue, "xyz")
        assert [x[2] for x in license.find(f"before {text} after", tuple(license.TEMPLATES.items()))] == [name]


def test_scan_finds_the_planted_lines(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    expected = set()
    for r in docs:
        for name, text in license.TEMPLATES.items():
            plain = re.sub(r"[^a-z0-9.]+", " ", text.lower()).strip(" .")
            if plain in re.sub(r"[^a-z0-9.]+", " ", r["text"].lower()):
                expected.add((r["doc_id"], name))
    got = QUERIES["op4_license_scan"](spark, "/root/testdata/sf0.01").collect()
    assert expected and {(r["doc_id"], r["license"]) for r in got if r["missing"] + r["added"] == 0} == expected


def test_scan_of_awkward_rows(spark):
    notice = "Licensed under CC BY-NC 4.0."
    docs = awkward(spark)
    extra = spark.createDataFrame([(300, f"é😀 {notice}", None, None, None), (300, f"é😀 {notice}", None, None, None), (None, notice, None, None, None), (301, "license " * 30_000, None, None, None)], docs.schema)
    rows = license.scan(with_clashes(docs.union(extra))).collect()
    assert sorted((str(r["doc_id"]), r["start"], r["end"], r["license"]) for r in rows) == [("300", 3, 30, "CC-BY-NC-4.0-notice")] * 2 + [("None", 0, 27, "CC-BY-NC-4.0-notice")]
    assert license.scan(empty(spark)).count() == 0 and license.scan(extra, {}).count() == 0
