"""Toxicity grades by cumulative-link ordinal regression.

P(grade <= k) = logistic(threshold[k] - weights . features): all grades share the weights, and the thresholds rise.
Features are the words that occur in a text, out of those that tell the classes apart in the sample.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import append, labelled_sample

WORD = re.compile(r"[^\W\d_]{2,}")
#: Chi-square from which a word tells the classes apart: chance alone reaches it once in some million words.
LEAST_CHI = 25.0


def word_counts(text: bytes | None) -> Counter:
    return Counter(WORD.findall((text or b"").decode("utf-8", "replace").lower()))


@dataclass(frozen=True)
class ToxicityModel:
    """`weights` by word; `thresholds`, one fewer than there are grades."""

    words: dict[str, int] = field(repr=False)
    weights: np.ndarray = field(repr=False)
    thresholds: np.ndarray

    def signal(self, text: bytes | None) -> float:
        counts = word_counts(text)
        return float(sum(self.weights[self.words[w]] * np.log1p(n) for w, n in sorted(counts.items()) if w in self.words))

    def at_most(self, signals: np.ndarray) -> np.ndarray:
        """P(grade <= k) for each text (row) and each k below the last grade."""
        return 1 / (1 + np.exp(-np.clip(self.thresholds - signals[:, None], -500, 500)))


def pick(counted: list[Counter], toxic: np.ndarray, most: int, least_texts: int = 3) -> list[str]:
    """The words that occur more often in toxic sample texts and tell them from others best, by the chi-square of their occurrence."""
    n, n1 = len(counted), int(toxic.sum())
    inside: Counter = Counter()
    outside: Counter = Counter()
    for words, is_toxic in zip(counted, toxic.tolist()):
        (inside if is_toxic else outside).update(words.keys())
    found = []
    for word in inside.keys() | outside.keys():
        a, b = inside[word], outside[word]
        if a + b >= least_texts:
            expected = (a + b) * n1 / n
            spread = expected * (1 - n1 / n) * (1 - (a + b) / n) * n / max(1, n - 1)
            if spread > 0 and a > expected and (chi := (a - expected) ** 2 / spread) > LEAST_CHI:
                found.append((-chi, word))
    return [w for _, w in sorted(found)[:most]]


def fit_ordinal(rows: list[list[tuple[int, float]]], grades: np.ndarray, weight: np.ndarray, features: int, pull: float = 1e-3, steps: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds of the largest penalised likelihood, by Adam over all rows.

    The thresholds are the first one plus exponentials, so they stay in order. No word lowers a grade.
    """
    count = int(grades.max()) if len(grades) else 0
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.array([j for r in rows for j, _ in r], np.int64)
    value = np.array([v for r in rows for _, v in r], float)
    share = weight / weight.sum()
    below = np.clip([share[grades <= k].sum() for k in range(count)], 1e-4, 1 - 1e-4)
    start = np.maximum.accumulate(np.log(below / (1 - below)) + 1e-3 * np.arange(count))
    theta = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 1e-3)), np.zeros(features)))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    logistic = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for step in range(1, steps + 1):
        gaps, w = np.exp(theta[1:count]), theta[count:]
        edges = np.concatenate(([-np.inf], theta[0] + np.concatenate(([0.0], np.cumsum(gaps))), [np.inf]))
        signal = np.bincount(at, value * w[column], len(rows))
        upper, lower = logistic(edges[grades + 1] - signal), logistic(edges[grades] - signal)
        p = np.maximum(upper - lower, 1e-12)
        up, down = share * upper * (1 - upper) / p, share * lower * (1 - lower) / p
        edge_slope = np.bincount(grades + 1, up, count + 2) - np.bincount(grades, down, count + 2)
        tail = np.cumsum(edge_slope[1:-1][::-1])[::-1]
        slope = -np.concatenate((tail[:1], tail[1:] * gaps, np.bincount(column, value * (down - up)[at], features)))
        slope[count:] += pull * w
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        theta -= 0.1 * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        np.maximum(theta[count:], 0, out=theta[count:])
    return theta[count:], theta[0] + np.concatenate(([0.0], np.cumsum(np.exp(theta[1:count]))))


def severity_grades(counted: list[Counter], toxic: np.ndarray, words: list[str]) -> np.ndarray:
    """Grades from yes-or-no labels: 0 for no; 1, or 2 if the text has more occurrences of picked words than the middle one of the toxic texts."""
    picked = set(words)
    hits = np.array([sum(n for w, n in c.items() if w in picked) for c in counted])
    middle = float(np.median(hits[toxic])) if toxic.any() else 0.0
    return np.where(toxic, 1 + (hits > middle), 0).astype(np.int64)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 3000, features: int = 2000) -> ToxicityModel:
    """A model from about `per_class` documents of either label that are not held out; either label weighs as much.

    Without labels, or with one kind only, no word has a weight and every text gets the likeliest grade.
    """
    sample, _ = labelled_sample(docs, labels, "toxic", per_class)
    counted = [word_counts(t) for t, _ in sample]
    toxic = np.array([label == 1 for _, label in sample], bool)
    if not toxic.any() or toxic.all():
        return ToxicityModel({}, np.zeros(0), np.array([-10.0 if toxic.any() else 10.0, 11.0]))
    words = pick(counted, toxic, features)
    grades = severity_grades(counted, toxic, words)
    place = {w: i for i, w in enumerate(words)}
    rows = [[(place[w], np.log1p(n)) for w, n in c.items() if w in place] for c in counted]
    weight = np.where(toxic, 1 / toxic.sum(), 1 / (~toxic).sum())
    weights, thresholds = fit_ordinal(rows, grades, weight, len(words))
    return ToxicityModel(place, weights, thresholds)


def grade(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """`df` with `severity` (the expected grade), `grade` (the likeliest one, the lower of equals) and `toxic` (a grade above 0 is likelier than 0).

    Null and empty texts have no feature and get what the thresholds alone say. Repeated rows get the same result, an
    empty table gives no row, and columns that have the new names are replaced.
    """

    def compute(texts):
        at_most = model.at_most(np.array([model.signal(t) for t in texts], float))
        each = np.diff(np.concatenate((np.zeros((len(texts), 1)), at_most, np.ones((len(texts), 1))), axis=1), axis=1)
        return [
            pa.array((1 - at_most).sum(axis=1), pa.float64()),
            pa.array(each.argmax(axis=1).astype(np.int32), pa.int32()),
            pa.array(at_most[:, 0] < 0.5, pa.bool_()),
        ]

    return append(df, "severity double, grade int, toxic boolean", compute, text)
