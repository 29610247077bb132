"""Quality rules by distribution divergence.

A language reference is the share of each character class and of each common word in all documents of the language.
A text is compared with every reference by the Jensen-Shannon distance (base 2, 0 to 1) of both histograms; one that
is far from all of them is not prose of any known language. Short texts are compared by fewer histograms.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut

from .common import append, parts, raw_texts, ship

CLASSES = ("lower", "upper", "other letter", "digit", "space", "punctuation", "symbol")
PUNCTUATION = ".,;:!?'\"()-’“”«»¿¡–—"
SYMBOLS = b"#*$%&|<>"
#: A word is common if this share of a language's words is that word.
COMMON = 0.002
#: Base rules: least words, and most per cent of words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Distances of the two histograms that documents of a language may have. A histogram of n words lies away from its own
#: source by chance alone; for the classes the allowance for that is ALLOWANCE / sqrt(n).
MOST_CLASS_DISTANCE, MOST_WORD_DISTANCE, ALLOWANCE = 0.2, 0.35, 1.0
#: Words from which the common words count.
LEAST_FOR_WORDS = 50
#: The limit of the common words: this many standard deviations above the distance that n words of the language itself
#: have on average, measured on so many drawn texts of each of these sizes, but this share at most of the distance of a
#: text without any common word.
DEVIATIONS, DRAWN, BELOW_NONE = 3.0, 200, 0.98
DRAWN_WORDS = LEAST_FOR_WORDS * 2 ** np.arange(12)


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    table = np.full(0x110000, CLASSES.index("symbol"), np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            table[code] = 0 if c.islower() else 1 if c.isupper() else 2
        elif c.isdigit():
            table[code] = 3
        elif c.isspace():
            table[code] = 4
    table[[ord(c) for c in PUNCTUATION]] = 5
    return table


def class_counts(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.bincount(_class_table()[codes], minlength=len(CLASSES))


def base_metrics(raw: bytes, n_code_points: int) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, and words in repeated windows of three."""
    words = raw.split()
    n = len(words)
    symbols = sum(raw.count(bytes([s])) for s in SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    blanks = len(raw) - sum(map(len, words))
    repeated = 0
    if n > 3:
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        _, window, count = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        again = count[window] > 1
        inside = np.zeros(n, bool)
        for k in range(3):
            inside[k : n - 2 + k] |= again
        repeated = int(inside.sum())
    return n, n_code_points - blanks, symbols, len(lines) - len(set(lines)), repeated


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of histograms along the last axis; 0 where one is empty."""
    p, q = np.asarray(p, float), np.asarray(q, float)
    sums = p.sum(-1, keepdims=True), q.sum(-1, keepdims=True)
    p, q = (x / np.where(s > 0, s, 1) for x, s in zip((p, q), sums))
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda x: np.where(x > 0, x * np.log2(x / m), 0.0).sum(-1)
        both = (part(p) + part(q)) / 2
    return np.where((sums[0][..., 0] > 0) & (sums[1][..., 0] > 0), np.sqrt(np.clip(both, 0, 1)), 0.0)


@dataclass(frozen=True)
class Reference:
    """Of each language: shares of the character classes; the common words and their shares, that of all other words last."""

    languages: tuple[str, ...]
    classes: np.ndarray = field(repr=False)
    words: tuple[tuple[str, ...], ...] = field(repr=False)
    shares: tuple[np.ndarray, ...] = field(repr=False)

    @cached_property
    def limits(self) -> dict[str, np.ndarray]:
        """Of each language the largest word distance of prose with DRAWN_WORDS words."""
        return {name: word_limits(shares) for name, shares in zip(self.languages, self.shares)}

    def is_prose(self, name: str | None, n_words: int, by_class: float, by_word: float) -> tuple[bool, float | None]:
        """Whether a text that is so far from the language `name` passes both histograms, and its limit of the word distance, or None where words do not count."""
        close = by_class <= MOST_CLASS_DISTANCE + ALLOWANCE / np.sqrt(max(1, n_words))
        if name is None or n_words < LEAST_FOR_WORDS or len(self.limits[name]) == 0:
            return bool(close), None
        limit = float(np.interp(-1 / np.sqrt(n_words), -1 / np.sqrt(DRAWN_WORDS), self.limits[name]))
        return bool(close and by_word <= limit), limit

    def distances(self, text: str, n_words: int) -> tuple[str | None, float, float]:
        """The language that is nearest by the sum of both distances, and these; without a language, None and 0."""
        own, counts = class_counts(text), Counter(text.lower().encode("utf-8", "replace").split())
        found = []
        for name, classes, words, shares in zip(self.languages, self.classes, self.words, self.shares):
            hits = [counts[w.encode()] for w in words]
            by_word = float(divergence(np.array([*hits, n_words - sum(hits)]), shares)) if words and n_words >= LEAST_FOR_WORDS else 0.0
            by_class = float(divergence(own, classes))
            found.append((by_class + by_word, name, by_class, by_word))
        return min(found)[1:] if found else (None, 0.0, 0.0)


def word_limits(shares: np.ndarray) -> np.ndarray:
    """The largest word distance of prose with DRAWN_WORDS words, from a reference's shares; none where it has no common word.

    It is the mean and DEVIATIONS standard deviations of the distances of texts drawn from the reference, and
    MOST_WORD_DISTANCE at least, as documents differ by more than chance; but it stays below a text without common words.
    """
    if len(shares) < 2:
        return np.empty(0)
    draw = np.random.default_rng(11)
    away = [divergence(draw.multinomial(n, shares / shares.sum(), DRAWN), np.broadcast_to(shares, (DRAWN, len(shares)))) for n in DRAWN_WORDS.tolist()]
    none = divergence(np.eye(len(shares))[-1], shares)
    return np.minimum(np.maximum([x.mean() + DEVIATIONS * x.std() for x in away], MOST_WORD_DISTANCE), BELOW_NONE * none)


def reference(docs: DataFrame, max_languages: int = 1000) -> Reference:
    """References from all documents that have a text and a language.

    First every task adds up, for each part of its rows, the classes and the words that make up half of COMMON of
    that part. A common word is among those of some part, and the sums of these parts leave at most 2 / COMMON
    words of a language in question; the second pass counts these in all documents.

    The `max_languages` languages with most words have a reference, of equal ones the first by name. Texts of others are
    judged too, by the nearest reference.
    """
    ship(docs.sparkSession)
    known = docs.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())

    def counted(batches, chosen):
        for batch in batches:
            for part in parts(batch, "text"):
                words: dict[bytes, Counter] = {}
                classes: dict[bytes, np.ndarray] = {}
                for raw, lang in zip(raw_texts(part, "text"), raw_texts(part, "lang")):
                    text = raw.decode("utf-8", "replace")
                    words.setdefault(lang, Counter()).update(text.lower().encode("utf-8", "replace").split())
                    if chosen is None:
                        classes[lang] = classes.get(lang, 0) + class_counts(text)
                rows = []
                for lang, own in words.items():
                    total = own.total()
                    name = lang.decode()
                    if chosen is None:
                        rows += [(name, f"class {i}", None, int(n)) for i, n in enumerate(classes[lang])]
                        rows.append((name, "total", None, total))
                        rows += [(name, "word", w.decode(), n) for w, n in own.items() if n >= total * COMMON / 2]
                    else:
                        rows += [(name, "word", w, own[w.encode()]) for w in chosen.get(name, ())]
                yield pa.RecordBatch.from_pydict(dict(zip(("lang", "kind", "word", "n"), map(list, zip(*rows)))) if rows else {k: [] for k in ("lang", "kind", "word", "n")}, schema=pa.schema([("lang", pa.string()), ("kind", pa.string()), ("word", pa.string()), ("n", pa.int64())]))

    def summed(chosen):
        return known.mapInArrow(lambda b: counted(b, chosen), "lang string, kind string, word string, n bigint").groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))

    first = cut(summed(None), "rules-counts")
    totals = first.where("kind = 'total'").select(F.col("lang").alias("of"), F.col("n").alias("total")).orderBy(F.desc("total"), "of").limit(max_languages)
    totals = cut(totals, "rules-languages")
    rows = first.where("kind != 'word'").join(F.broadcast(totals), F.col("lang") == F.col("of")).collect()
    total = {r["lang"]: r["n"] for r in rows if r["kind"] == "total"}
    languages = tuple(sorted(total))
    classes = np.zeros((len(languages), len(CLASSES)))
    for r in rows:
        if r["kind"] != "total":
            classes[languages.index(r["lang"]), int(r["kind"].split()[1])] = r["n"]
    likely = first.where("kind = 'word'").join(totals, F.col("lang") == F.col("of")).where(F.col("n") >= F.col("total") * (COMMON / 2))
    chosen: dict[str, list[str]] = {}
    for r in likely.select("lang", "word").collect():
        chosen.setdefault(r["lang"], []).append(r["word"])
    common: dict[str, list[tuple[int, str]]] = {}
    for r in summed(chosen).collect() if chosen else []:
        if r["n"] >= total[r["lang"]] * COMMON:
            common.setdefault(r["lang"], []).append((-r["n"], r["word"]))
    ordered = [sorted(common.get(lang, ())) for lang in languages]
    shares = [np.array([-n for n, _ in own] + [total[lang] + sum(n for n, _ in own)], float) for lang, own in zip(languages, ordered)]
    return Reference(languages, classes, tuple(tuple(w for _, w in own) for own in ordered), tuple(shares))


def judge(df: DataFrame, known: Reference, text: str = "text") -> DataFrame:
    """`df` with `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`, `base_failed`, `kept`, `nearest`, `class_distance`, `word_distance` and `word_limit` of every whole text.

    `kept` is true for texts that pass the base rules and are close to the nearest language by both histograms: the
    character classes up to a fixed distance and an allowance for few words, the common words up to `word_limit` (null
    for texts too short for it), which lies below the distance of a text without any common word.

    Null and empty texts have no words and fail the base rules. Without any reference the base rules decide. Equal
    distances go to the first language by name. Repeated rows get the same result, an empty table gives no row, and
    columns that have the new names are replaced.
    """

    known.limits  # noqa: B018 - drawn here once, not by every task

    def compute(texts):
        rows = []
        for raw in texts:
            raw = raw or b""
            decoded = raw.decode("utf-8", "replace")
            metrics = base_metrics(raw, len(decoded))
            failed = base_failed(metrics[0], metrics[4])
            name, by_class, by_word = known.distances(decoded, metrics[0])
            prose, limit = known.is_prose(name, metrics[0], by_class, by_word)
            rows.append((*metrics, failed, not failed and prose, name, by_class, by_word, limit))
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()] + [pa.float64()] * 3
        return [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)]

    counts = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
    return append(df, f"{counts}, base_failed boolean, kept boolean, nearest string, class_distance double, word_distance double, word_limit double", compute, text)
