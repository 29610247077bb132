"""Quality classifier by compression.

One zstandard dictionary is trained on good text and one on bad. A text is cut into pieces, each piece is
compressed with both. The normalised difference (bad size - good size) / (bad size + good size), together with the
share of the text that is left after compression with the good dictionary (little is left of a text that repeats
itself), becomes a score by a logistic curve that is fitted on texts the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import append, keep, labelled_sample

#: Bytes of a piece: small enough that the dictionary counts, not what the text repeats itself.
PIECE = 1024
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: Score from which a text counts as good.
THRESHOLD = 0.3


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


def pieces(text: bytes) -> list[bytes]:
    """The whole text in pieces of PIECE bytes; the last one may be shorter."""
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


@dataclass(frozen=True)
class QualityModel:
    good: bytes = field(repr=False)
    bad: bytes = field(repr=False)
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def features(self, text: bytes | None) -> tuple[float, float]:
        """Normalised difference of the compressed sizes, above 0 if the text is nearer to good text, and the share that compression takes away.

        Both are 0 for null, for empty text and if a class had no text to learn from.
        """
        if not text or not self.good or not self.bad:
            return 0.0, 0.0
        bad, good = (sum(map(len, map(_compressor(d).compress, pieces(text)))) for d in (self.bad, self.good))
        return (bad - good) / (bad + good), max(0.0, 1 - good / len(text))

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        x = np.array([(*self.features(t), 1.0) for t in texts], float).reshape(-1, 3)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -500, 500)))


def dictionary(texts: Sequence[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the text itself as one where there is too little to train on."""
    samples = [p for t in texts for p in pieces(t)]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of the weighted logistic curve, by Newton's method with a slight pull to 0; the last column of `x` is 1."""
    scale = np.sqrt(np.mean(x * x, axis=0))
    scale[scale == 0] = 1.0
    design, beta = x / scale, np.zeros(x.shape[1])
    pull = np.diag([1e-2] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + pull, design.T @ (weight * (y - p)) - pull @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta / scale


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 2000, text_bytes: int = 8 * PIECE) -> QualityModel:
    """Dictionaries and curve from about `per_class` documents of either label that are not held out.

    From a long sample text, pieces spread over it, `text_bytes` in all, teach the dictionary. Sample texts take
    turns: every second one teaches the dictionaries, the others, whole, the curve. Labels weigh as often as they
    occur. Without labels of one kind the score is the share of good labels, or 0.5 without any label.
    """
    sample, counts = labelled_sample(docs, labels, "quality", per_class)
    by_class = {c: [t for t, label in sample if label == c] for c in (0, 1)}
    teach: dict[int, list[bytes]] = {0: [], 1: []}
    for c, texts in by_class.items():
        for text in texts[::2]:
            own = pieces(text)
            step = max(1, -(-len(own) * PIECE // text_bytes))
            teach[c].append(b"".join(own[::step]))
    model = QualityModel(dictionary(teach[1]), dictionary(teach[0]))
    rest = [(*model.features(t), 1.0, c) for c, texts in by_class.items() for t in texts[1::2]]
    n = {c: sum(r[-1] == c for r in rest) for c in (0, 1)}
    if not n[0] or not n[1]:
        share = (counts.get(1, 0) + 0.5) / (counts.get(0, 0) + counts.get(1, 0) + 1)
        return QualityModel(model.good, model.bad, (0.0, 0.0, float(np.log(share / (1 - share)))))
    table = np.array(rest, float)
    x, y = table[:, :-1], table[:, -1]
    weight = np.where(y == 1, counts[1] / n[1], counts[0] / n[0])
    return QualityModel(model.good, model.bad, tuple(logistic(x, y, weight * len(rest) / weight.sum()).tolist()))


def score(df: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """`df` with `score` (0 to 1, higher: likelier good) and `predicted` of every whole text.

    Null and empty texts differ in nothing and get the curve's offset. Repeated rows get the same score, an empty
    table gives no row, and columns that have the new names are replaced.
    """

    def compute(texts):
        scores = model.scores(texts)
        return [pa.array(scores, pa.float64()), pa.array((scores >= THRESHOLD).astype(np.int32), pa.int32())]

    return append(df, "score double, predicted int", compute, text)


def accepted(df: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows that score at least THRESHOLD, whatever their number of repeats; columns stay as they are, also with clashing names.

    Null and empty texts have the score of the curve's offset, so they stay or go together. An empty table gives no row.
    """
    return keep(df, lambda texts: (model.scores(texts) >= THRESHOLD).tolist(), text)
