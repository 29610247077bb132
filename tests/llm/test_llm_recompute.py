"""Scores of the learned models, computed again in plain Python from what each model has learned."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import zstandard

from tidemark.llm import language, quality, toxicity
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def texts(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, "documents").select("doc_id", "text").collect()}


def test_quality_is_the_curve_over_compressed_sizes(spark):
    model = quality.learn(table(spark, "documents"), table(spark, "labels"))

    def size(text: bytes, dictionary: bytes) -> int:
        data = zstandard.ZstdCompressionDict(dictionary)
        packer = zstandard.ZstdCompressor(level=3, dict_data=data, write_content_size=False, write_dict_id=False)
        return sum(len(packer.compress(text[i : i + 1024])) for i in range(0, len(text), 1024))

    own = texts(spark)
    for r in QUERIES["op1_quality_classifier"](spark, SF).collect():
        raw = own[r["doc_id"]].encode()
        good, bad = size(raw, model.good), size(raw, model.bad)
        a, b, c = model.weights
        score = 1 / (1 + math.exp(-(a * (bad - good) / (bad + good) + b * max(0.0, 1 - good / len(raw)) + c)))
        # A dictionary that is prepared once may choose other matches than one that is read anew, by a byte or two a piece.
        assert abs(r["score"] - score) < 0.05 and r["predicted"] == (r["score"] >= 0.3)


def test_severity_is_the_expected_grade(spark):
    model = toxicity.learn(table(spark, "documents"), table(spark, "labels"))
    weight = {w: model.weights[i] for w, i in model.words.items()}
    own = texts(spark)
    for r in QUERIES["op5_toxicity"](spark, SF).collect():
        counts = Counter(m.lower() for m in re.findall(toxicity.WORD.pattern, own[r["doc_id"]].lower()))
        signal = sum(weight[w] * math.log(1 + n) for w, n in counts.items() if w in weight)
        at_most = [1 / (1 + math.exp(-(t - signal))) for t in model.thresholds] + [1.0]
        each = [p - q for p, q in zip(at_most, [0.0, *at_most])]
        assert abs(r["severity"] - sum(k * p for k, p in enumerate(each))) < 1e-9
        assert r["grade"] == each.index(max(each)) and r["toxic"] == (at_most[0] < 0.5)


def test_language_is_the_nearest_prototype(spark):
    model = language.learn(table(spark, "documents"))
    own, letters = texts(spark), {}

    def letter(c: str) -> np.ndarray:
        if c not in letters:
            letters[c] = language._letter_vector(ord(c), language.DIMENSIONS).astype(np.int64)
        return letters[c]

    for r in QUERIES["op6_language_id"](spark, SF).limit(60).collect():
        words = re.sub(r"[^a-z\x00]+", lambda m: "".join(c if c.isalpha() else "\0" for c in m.group()), own[r["doc_id"]].lower())
        words = "\0" + re.sub("\0+", "\0", words).strip("\0") + "\0"
        grams = Counter(words[i : i + 3] for i in range(len(words) - 2))
        vector = np.zeros(language.DIMENSIONS, np.int64)
        for (a, b, c), n in grams.items():
            vector += n * np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
        if not words.strip("\0"):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        cosines = {name: float(p @ vector / np.sqrt(p @ p) / np.sqrt(float(vector @ vector))) for name, p in zip(model.languages, model.prototypes)}
        best = max(cosines, key=cosines.get)
        assert r["lang_pred"] == best and abs(r["score"] - max(0.0, cosines[best])) < 1e-6
