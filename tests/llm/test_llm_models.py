"""Language, quality, toxicity and rules: held-out accuracy, brute force, and awkward rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_data import awkward, empty, labels_for, prose, with_clashes

from tidemark.llm import language, quality, rules, toxicity
from tidemark.llm.common import held_out
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def is_held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


def auc(scores, good) -> float:
    order = np.argsort(np.argsort(scores)) + 1
    good = np.asarray(good, bool)
    return (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / good.sum() / (~good).sum()


def test_the_held_out_fold(spark):
    rows = awkward(spark).select("doc_id", held_out().alias("h")).collect()
    assert [r["h"] for r in rows] == [is_held_out(r["doc_id"]) for r in rows]


# Language


def test_language_on_held_out_documents(spark):
    truth = {r["doc_id"]: r["lang"] for r in table(spark, "documents").select("doc_id", "lang").collect()}
    got = QUERIES["op6_language_id"](spark, SF).collect()
    assert len(got) == len(truth) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if is_held_out(i)}
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97


def test_the_vector_is_the_sum_of_bound_letters():
    text = "Ab, c!  ab"
    words = "\0ab\0c\0ab\0"
    expected = np.zeros(language.DIMENSIONS)
    for a, b, c in zip(words, words[1:], words[2:]):
        letter = lambda x: language._letter_vector(ord(x), language.DIMENSIONS).astype(int)
        expected += np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
    assert np.array_equal(language.text_vector(text.encode()), expected)
    assert language.text_vector(b"12 ##") is None and language.text_vector(None) is None


def test_the_held_grams_are_bounded(monkeypatch):
    text = prose("en", 300).encode()
    before = language.text_vector(text)
    monkeypatch.setattr(language, "HELD_GRAMS", 16)
    language._grams.cache_clear()
    assert np.array_equal(language.text_vector(text), before)
    language._grams.cache_clear()


def test_language_of_awkward_rows(spark):
    docs = awkward(spark)
    model = language.learn(docs)
    assert model.languages == ("de", "en")
    assert np.array_equal(model.prototypes, language.learn(docs.repartition(7)).prototypes)
    out = language.identify(with_clashes(docs), model)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out.collect()}
    assert all(got[i] == ("und", 0.0) for i in (100, 101, 102, 103))
    assert got[105][0] == "en" and got[1][0] == "en" and got[2][0] == "de"
    kept = language.accepted(with_clashes(docs), model, 0.05)
    assert kept.columns == with_clashes(docs).columns and not {100, 101, 102, 103} & {r["doc_id"] for r in kept.collect()}
    assert language.identify(empty(spark), model).count() == 0
    unlearned = language.learn(empty(spark))
    assert {tuple(r) for r in language.identify(docs.select("text"), unlearned).select("lang_pred", "score").collect()} == {("und", 0.0)}


def test_the_most_frequent_languages_are_learned(spark):
    from tidemark.llm.common import class_shares

    rows = spark.range(30).selectExpr("cast(pmod(id * id, 11) as string) as lang")
    counts = Counter(str(i * i % 11) for i in range(30))
    want = sorted(counts, key=lambda x: (-counts[x], x))[:4]
    assert {k: n for k, (_, n) in class_shares(rows, "lang", 5, max_classes=4).items()} == {k: counts[k] for k in want}
    docs = awkward(spark)
    assert rules.reference(docs, max_languages=1).languages == ("en",)
    got = rules.judge(docs, rules.reference(docs, max_languages=1)).collect()
    assert len(got) == docs.count() and {r["nearest"] for r in got} == {"en"}


# Quality


def test_quality_on_held_out_documents(spark):
    truth = {r["doc_id"]: r["quality"] for r in table(spark, "labels").collect()}
    got = QUERIES["op1_quality_classifier"](spark, SF).collect()
    assert len(got) == table(spark, "documents").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == is_held_out(r["doc_id"]) for r in got)
    held = [(r["score"], truth[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert auc([s for s, _, _ in held], [y for _, y, _ in held]) > 0.93
    assert np.mean([p for _, y, p in held if y]) > 0.95


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark)
    bad = spark.createDataFrame([(200 + i, f"### buy{i} &&& now$$$ %%% " * 40, "en", "s", None) for i in range(40)], docs.schema)
    both = docs.union(bad)
    labels = labels_for(spark, [(i, 1) for i in range(40)] + [(200 + i, 0) for i in range(40)], "quality")
    model = quality.learn(both, labels)
    assert model == quality.learn(both.repartition(5), labels.repartition(3))
    out = {r["doc_id"]: r["score"] for r in quality.score(with_clashes(both), model).collect()}
    assert min(out[i] for i in range(5, 40)) > 0.5 > max(out[200 + i] for i in range(40))
    assert out[100] == out[101] == model.scores([None])[0]
    kept = quality.accepted(with_clashes(both), model)
    assert kept.columns == with_clashes(both).columns
    assert quality.score(empty(spark), model).count() == 0
    assert quality.learn(docs, labels.limit(0)).scores([b"x", None]).tolist() == [0.5, 0.5]
    only_good = quality.learn(docs, labels.where("quality = 1"))
    assert only_good.scores([b"x"])[0] > 0.9


def test_labels_that_differ_teach_nothing(spark):
    from tidemark.llm.common import labelled_sample

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(1, 30)] * 2, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)] + [(2, 1)], "doc_id bigint, quality int")
    found, counts = labelled_sample(docs, labels, "quality", 100)
    taught = [i for i in range(1, 30) if i != 2 and not is_held_out(i)]
    assert sorted(found) == sorted((f"text {i}".encode(), i % 2) for i in taught)
    assert counts == dict(Counter(i % 2 for i in taught))


# Toxicity


def test_toxicity_on_held_out_documents(spark):
    truth = {r["doc_id"]: r["toxic"] for r in table(spark, "labels").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op5_toxicity"](spark, SF).collect()}
    assert len(got) == table(spark, "documents").count()
    held = [(got[i]["severity"], y, got[i]["toxic"]) for i, y in truth.items() if is_held_out(i)]
    assert np.mean([t for _, y, t in held if not y]) < 0.03
    assert auc([s for s, _, _ in held], [y for _, y, _ in held]) > 0.7


def test_ordinal_regression_recovers_ordered_grades():
    draw = np.random.default_rng(4)
    x = draw.integers(0, 3, (3000, 4)).astype(float)
    signal = x @ np.array([1.5, 1.0, 0.0, 2.0])
    noisy = signal + draw.logistic(size=3000)
    grades = np.searchsorted([2.0, 4.5, 7.0], noisy).astype(np.int64)
    rows = [[(j, v) for j, v in enumerate(r) if v] for r in x.tolist()]
    weights, thresholds = toxicity.fit_ordinal(rows, grades, np.ones(3000), 4, pull=1e-5, steps=2000)
    assert np.allclose(weights, [1.5, 1.0, 0.0, 2.0], atol=0.25) and np.allclose(thresholds, [2.0, 4.5, 7.0], atol=0.4)
    model = toxicity.ToxicityModel({}, weights, thresholds)
    at_most = model.at_most(x @ weights)
    assert (np.diff(at_most, axis=1) > 0).all()
    expected = (1 - at_most).sum(1)
    assert np.corrcoef(expected, signal)[0, 1] > 0.95


def test_the_gradient_is_that_of_the_likelihood():
    """One step from equal starts moves every weight as the numerical slope says."""
    rows, grades = [[(0, 1.0)], [(1, 2.0)], [(0, 1.0), (1, 1.0)], []], np.array([1, 2, 2, 0])

    def loss(w, t):
        edges = np.array([-np.inf, *t, np.inf])
        s = np.array([sum(w[j] * v for j, v in r) for r in rows])
        cdf = lambda x: 1 / (1 + np.exp(-x))
        return -np.mean(np.log(cdf(edges[grades + 1] - s) - cdf(edges[grades] - s))) + 0.005 * (w @ w)

    w, t = toxicity.fit_ordinal(rows, grades, np.ones(4), 2, pull=0.01, steps=4000)
    at = loss(w, t)
    for j in range(2):
        for d in (-1e-2, 1e-2):
            assert loss(np.maximum(w + d * np.eye(2)[j], 0), t) >= at - 1e-6
            assert loss(w, t + d * np.eye(2)[j]) >= at - 1e-6


def test_toxicity_of_awkward_rows(spark):
    docs = awkward(spark)
    bad = spark.createDataFrame([(200 + i, prose("en", 40, i) + " vile foul" * (1 + i % 3), "en", "s", None) for i in range(40)], docs.schema)
    both = docs.union(bad)
    labels = labels_for(spark, [(i, 0) for i in range(40)] + [(200 + i, 1) for i in range(40)], "toxic")
    model = toxicity.learn(both, labels)
    out = {r["doc_id"]: r for r in toxicity.grade(with_clashes(both), model).collect()}
    assert all(out[200 + i]["toxic"] for i in range(40)) and not any(out[i]["toxic"] for i in (*range(40), 100, 101, 102, 103, 104, 106))
    assert out[202]["severity"] > out[200]["severity"] > out[100]["severity"]
    assert toxicity.grade(empty(spark), model).count() == 0
    unlearned = toxicity.learn(docs, labels.limit(0))
    assert not any(r["toxic"] for r in toxicity.grade(docs, unlearned).collect())


# Rules


def brute_metrics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated)


def brute_distance(p, q):
    p, q = np.array(p, float) / sum(p), np.array(q, float) / sum(q)
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += (a * np.log2(a / m) if a else 0) / 2 + (b * np.log2(b / m) if b else 0) / 2
    return np.sqrt(max(total, 0))


def test_rules_against_brute_force(spark):
    docs = table(spark, "documents").select("doc_id", "text", "lang").collect()
    total, classes, known = {}, {}, {}
    for r in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"].lower())
        total.setdefault(r["lang"], Counter()).update(words)
        classes[r["lang"]] = classes.get(r["lang"], 0) + rules.class_counts(r["text"])
    for lang, counts in total.items():
        n = counts.total()
        common = [w for w, c in counts.items() if c >= 0.002 * n]
        known[lang] = common, [counts[w] for w in common] + [n - sum(counts[w] for w in common)]
    got = {r["doc_id"]: r for r in QUERIES["op7_quality_rules"](spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        mine, own = brute_metrics(r["text"]), got[r["doc_id"]]
        assert (own["n_words"], own["word_chars"], own["n_symbols"], own["n_dup_lines"], own["n_repeat_words"]) == mine
        failed = mine[0] < 50 or 100 * mine[4] > 50 * mine[0]
        assert own["base_failed"] == failed
        counts = Counter(re.findall(r"[^\x20\x09-\x0D]+", r["text"].lower()))
        found = []
        for lang, (common, shares) in known.items():
            hits = [counts[w] for w in common]
            by_class = brute_distance(rules.class_counts(r["text"]), classes[lang])
            by_word = brute_distance([*hits, mine[0] - sum(hits)], shares) if mine[0] >= 50 else 0.0
            found.append((by_class + by_word, lang, by_class, by_word))
        _, lang, by_class, by_word = min(found)
        slack = 1 / np.sqrt(max(1, mine[0]))
        assert own["nearest"] == lang and abs(own["class_distance"] - by_class) < 1e-9 and abs(own["word_distance"] - by_word) < 1e-6
        limit = own["word_limit"]
        assert (limit is None) == (mine[0] < 50)
        none = brute_distance([0] * len(known[lang][0]) + [mine[0]], known[lang][1])
        assert limit is None or 0 < limit < none
        assert own["kept"] == (not failed and by_class <= 0.2 + slack and (limit is None or by_word <= limit))


def test_rules_keep_good_documents(spark):
    good = {r["doc_id"] for r in table(spark, "labels").where("quality = 1").collect()}
    got = [r for r in QUERIES["op7_quality_rules"](spark, SF).collect() if r["doc_id"] in good and not r["base_failed"]]
    assert np.mean([r["kept"] for r in got]) > 0.99


def test_kept_texts_have_common_words(spark):
    """No text without a common word is kept, however many words it has; held-out labels agree."""
    known = rules.reference(table(spark, "documents").select("doc_id", "text", "lang"))
    for name, common, shares in zip(known.languages, known.words, known.shares):
        for n in (50, 51, 75, 100, 500, 2000, 200_000):
            none = brute_distance([0] * len(common) + [n], shares)
            passed, limit = known.is_prose(name, n, 0.0, none)
            assert not passed and limit < none and known.is_prose(name, n, 0.0, 0.2)[0]
        assert known.is_prose(name, 49, 0.0, 0.0) == (True, None)
    truth = {r["doc_id"]: r["quality"] for r in table(spark, "labels").collect() if is_held_out(r["doc_id"])}
    got = [r for r in QUERIES["op7_quality_rules"](spark, SF).collect() if not r["base_failed"]]
    assert all(r["kept"] <= (r["word_limit"] is None or r["word_distance"] <= r["word_limit"]) for r in got)
    junk, good = ([r["kept"] for r in got if truth.get(r["doc_id"]) == q] for q in (0, 1))
    assert len(junk) > 3 and not any(junk) and np.mean(good) > 0.97
    salad = [f"{a}{b}{c}{d}" for d in ("", "o", "ila", ",") for a in "blor grin stav pem trun".split() for b in "ek um ax il".split() for c in "ont ide ulm erf ast anz ein ole our ier".split()]
    rows = rules.judge(spark.createDataFrame([(n, " ".join(salad[:n])) for n in (60, 400, 800)], "doc_id bigint, text string"), known).collect()
    assert [(r["n_words"], r["base_failed"], r["class_distance"] < 0.2, r["kept"]) for r in rows] == [(n, False, True, False) for n in (60, 400, 800)]


def test_rules_on_awkward_rows(spark):
    docs = awkward(spark)
    known = rules.reference(docs)
    rows = rules.judge(with_clashes(docs), known).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_metrics(r["text"])
    assert not any(r["kept"] for r in rows if r["doc_id"] in (100, 101, 102, 103, 104, 106))
    nothing = rules.reference(empty(spark))
    assert nothing.languages == () and rules.judge(empty(spark), known).count() == 0
    assert all(r["kept"] != r["base_failed"] for r in rules.judge(docs, nothing).collect())


def test_repeated_windows_of_many_different_words():
    text = " ".join(map(str, range(4000))) + " 0 1 2 5 5 5 5 5"
    assert rules.base_metrics(text.encode(), len(text)) == brute_metrics(text)
