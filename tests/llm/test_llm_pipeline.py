"""The pipeline: its stages one by one, and the whole, against brute force."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import tiktoken
from llm_data import awkward, brute_components, brute_fingerprint, empty, with_clashes
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import language, mixing, quality
from tidemark.llm.bpe import Ranks
from tidemark.llm.queries import rank_file

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}


def test_whole_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.learn(docs)
    rows = docs.collect()
    found = dict(zip((r["doc_id"] for r in rows), zip(*model.predict([(r["text"] or "").encode() for r in rows]))))
    known = [r for r in rows if found[r["doc_id"]][0] != "und" and found[r["doc_id"]][1] >= corpus_pipeline.LEAST_COSINE]
    judge = quality.learn(spark.createDataFrame(known, docs.schema), spark.read.parquet(f"{SF}/labels.parquet"))
    good = [r for r in known if judge.scores([r["text"].encode()])[0] >= 0.3]
    component = brute_components(sorted((r["doc_id"], brute_fingerprint(r["text"])) for r in good))
    first = spark.createDataFrame([r for r in good if component[r["doc_id"]] == r["doc_id"]], docs.schema)
    times = mixing.mix(first).join(first.withColumnRenamed("doc_id", "of"), F.col("doc_id") == F.col("of"))
    ranks, pattern = rank_file()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=Ranks(ranks).rank, special_tokens={})
    expected = []
    for r in times.collect():
        ids = library.encode_ordinary(r["text"])
        digests = [hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), r["text"].encode())]
        expected += [(r["doc_id"], len(ids), *digests)] * (r["taken"] // r["size"])
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(expected) and len(got) > 100


def test_stages_take_awkward_rows(spark):
    docs = with_clashes(awkward(spark))
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, with_clashes(empty(spark))):
            out = stage(spark, table, SF)
            if name != "tokens":
                assert out.columns == table.columns
            n = out.count()
            assert n == 0 if table is not docs else n > 0


def test_clean_documents_stay(spark):
    """The filtering stages keep labelled good documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    good = {r["doc_id"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").collect()}
    for stage in (corpus_pipeline.known_language, corpus_pipeline.good_quality):
        kept = {r["doc_id"] for r in stage(spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
        assert len(good & kept) > 0.97 * len(good)


def test_texts_in_no_learned_language_go(spark):
    """Random letters, blobs and unlearned scripts are rejected; short clean documents and all but a few others stay."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    draw = np.random.default_rng(3)
    words = lambda letters, n: " ".join("".join(draw.choice(list(letters), draw.integers(2, 10))) for _ in range(n))
    latin = "abcdefghijklmnopqrstuvwxyz"
    kinds = {
        "latin": lambda: words(latin, 200),
        "long latin": lambda: words(latin, 2000),
        "consonants": lambda: words("bcdfghjklmnpqrstvwxz", 200),
        "greek": lambda: words("αβγδεζηθικλμνξοπρστυφχψω", 200),
        "cyrillic": lambda: words("абвгдежзийклмнопрстуфхцчшщ", 50),
        "base64": lambda: base64.b64encode(draw.bytes(1000)).decode(),
    }
    made = [(10_000_000 + i, kind, make()) for i, (kind, make) in enumerate((k, m) for k, m in kinds.items() for _ in range(20))]
    junk = spark.createDataFrame([(i, t, None, "made", len(t)) for i, _, t in made], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r["doc_id"] for r in corpus_pipeline.known_language(spark, docs.unionByName(junk.select([F.col(c).cast(docs.schema[c].dataType) for c in docs.columns])), sf).select("doc_id").collect()}
    assert [k for i, k, _ in made if i in kept] == []
    own = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert "Von." in {own[i] for i in kept if i in own} and len(kept) >= 0.995 * len(own)
    assert {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()} <= kept
