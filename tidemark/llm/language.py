"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A 3-gram of letters is the product of
its letters' vectors, each rotated by its place; a text is the sum of its 3-grams' vectors, a language the sum of
its texts' vectors. A text gets the language with the largest cosine.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append, class_shares, held_out, in_share, keep, raw_texts, ship

UNKNOWN = "und"
DIMENSIONS = 1024
SEED = 7
#: Distinct 3-grams whose vectors a worker holds; beyond that it starts anew.
HELD_GRAMS = 1 << 15
#: A text's vector has this length when it is added to a language: whole numbers add up alike in any order.
UNIT = 1000
#: Texts of up to SHORT distinct 3-grams may have any cosine from the least on, as a few grams say little. From there to
#: LONG the limit rises to what letters in random order share with a language, OVERLAP, and DEVIATIONS of the chance on top.
SHORT, LONG, OVERLAP, DEVIATIONS = 16, 96, 0.1, 3.0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@lru_cache(maxsize=4096)
def _letter_vector(code: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng([SEED, code]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1


class _Grams:
    """Vectors of 3-grams, made when first seen."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.vectors = np.empty((HELD_GRAMS, dimensions), np.int8)
        self.places: dict[int, int] = {}

    def rows(self, grams: np.ndarray) -> np.ndarray:
        if len(grams) > HELD_GRAMS:
            return np.stack([self._make(g) for g in grams.tolist()])
        new = [g for g in grams.tolist() if g not in self.places]
        if len(self.places) + len(new) > HELD_GRAMS:
            self.places.clear()
            new = grams.tolist()
        for g in new:
            self.vectors[len(self.places)] = self._make(g)
            self.places[g] = len(self.places)
        return self.vectors[[self.places[g] for g in grams.tolist()]]

    def _make(self, gram: int) -> np.ndarray:
        codes = gram >> 42, gram >> 21 & 0x1FFFFF, gram & 0x1FFFFF
        out = _letter_vector(codes[2], self.dimensions).copy()
        for shift, code in ((2, codes[0]), (1, codes[1])):
            out *= np.roll(_letter_vector(code, self.dimensions), shift)
        return out


@lru_cache(maxsize=2)
def _grams(dimensions: int) -> _Grams:
    return _Grams(dimensions)


def text_grams(text: bytes | None) -> tuple[np.ndarray, np.ndarray] | None:
    """The distinct 3-grams of the whole text and their counts, or None if it has no letter. What is no letter is a gap between words."""
    if not text:
        return None
    codes = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 0)
    first_of_gap = np.concatenate(([False], letter[:-1])) & ~letter
    last = len(letter) - int(np.argmax(letter[::-1]))
    codes = np.concatenate(([0], codes[:last][(letter | first_of_gap)[:last]], [0])).astype(np.uint64)
    return np.unique(codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:], return_counts=True)


def text_vector(text: bytes | None, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """The sum of the 3-gram vectors of the whole text, or None if it has no letter."""
    found = text_grams(text)
    if found is None:
        return None
    grams, counts = found
    total = np.zeros(dimensions)
    for start in range(0, len(grams), 4096):
        rows = _grams(dimensions).rows(grams[start : start + 4096])
        total += counts[start : start + 4096].astype(np.float32) @ rows.astype(np.float32)
    return total


@dataclass(frozen=True)
class LanguageModel:
    """Languages in the order of their names, and their unit vectors."""

    languages: tuple[str, ...]
    prototypes: np.ndarray = field(repr=False)

    def limit(self, n_grams: float, least: float) -> float:
        """The smallest cosine at which a text with so many distinct 3-grams counts as in a language.

        The cosine of unlike vectors has a standard deviation of 1 / sqrt(dimensions), and the largest of several is some
        sqrt(2 ln languages) of these above 0.
        """
        languages, dimensions = self.prototypes.shape
        chance = (np.sqrt(2 * np.log(max(1, languages))) + DEVIATIONS) / np.sqrt(dimensions)
        return float(np.interp(n_grams, (SHORT, LONG), (least, max(least, OVERLAP + chance))))

    def accepts(self, text: bytes | None, name: str, score: float, least: float) -> bool:
        if name == UNKNOWN or score < least:
            return False
        return score >= self.limit(np.inf, least) or score >= self.limit(len(text_grams(text)[0]), least)

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for text in texts:
            vector = text_vector(text, self.prototypes.shape[1]) if self.languages else None
            length = 0.0 if vector is None else float(np.sqrt(vector @ vector))
            if not length:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            cosine = self.prototypes @ vector / length
            best = int(np.argmax(cosine))
            names.append(self.languages[best])
            scores.append(float(min(1.0, max(0.0, cosine[best]))))
        return names, scores


def learn(docs: DataFrame, per_language: int = 3000, dimensions: int = DIMENSIONS) -> LanguageModel:
    """Prototypes from about `per_language` documents of each language that are not held out.

    Rows with null text or language teach nothing. The sample is drawn by a hash of id and text, so repeated rows
    are drawn together and count once. Tasks add up vectors; one vector per task and language reaches the driver.
    """
    rows = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    shares = class_shares(rows.select("lang"), "lang", per_language)
    sample = rows.where(in_share(F.col("lang"), shares, F.col("doc_id"), F.col("text"))).distinct()

    def sums(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(raw_texts(batch, "text"), raw_texts(batch, "lang")):
                vector = text_vector(text, dimensions)
                if vector is not None and (length := np.sqrt(vector @ vector)):
                    part = total.setdefault(lang.decode(), np.zeros(dimensions, np.int64))
                    part += np.rint(vector / length * UNIT).astype(np.int64)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array(list(total), pa.string()), "total": pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))}
        )

    ship(docs.sparkSession)
    totals: dict[str, np.ndarray] = {}
    for lang, total in sample.repartition(32, F.xxhash64("doc_id", "text")).mapInArrow(sums, "lang string, total array<bigint>").collect():
        totals[lang] = totals.get(lang, 0) + np.array(total, float)
    names = tuple(sorted(n for n, v in totals.items() if v.any()))
    unit = [totals[n] / np.sqrt(totals[n] @ totals[n]) for n in names]
    return LanguageModel(names, np.array(unit).reshape(len(names), dimensions))


def identify(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """`df` with `lang_pred` and `score` (cosine, 0 to 1) of every whole text.

    Null texts, and texts without a letter, get `und` and 0. Equal cosines go to the first name. Repeated rows get
    the same result, an empty table gives no row, and columns that have the new names are replaced.
    """

    def compute(texts):
        names, scores = model.predict(texts)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return append(df, "lang_pred string, score double", compute, text)


def accepted(df: DataFrame, model: LanguageModel, least: float = 0.2, text: str = "text") -> DataFrame:
    """The rows whose text has a language with a cosine of at least `least`, and of the model's limit where that is higher; columns stay as they are.

    Null and empty texts, and texts without a letter, go. Repeated rows stay or go together. An empty table gives no row.
    """
    return keep(df, lambda texts: [model.accepts(t, n, s, least) for t, n, s in zip(texts, *model.predict(texts))], text)
