"""Small tables with every awkward case, and brute-force versions that share no code with the operators."""

from __future__ import annotations

import re

import xxhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for their own results or between steps.
CLASHING = ["score", "predicted", "fp", "hash", "size", "ids", "decoded", "bytes", "shard", "lang_pred", "held_out", "sample_id", "mix_copy", "owner", "rows", "kept"]
WORDS = {
    "en": "the of and to in is that it was for on with as his they at be this from have".split(),
    "de": "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch".split(),
}


def prose(lang: str, n: int, start: int = 0) -> str:
    words = WORDS[lang]
    return " ".join(words[(start * 7 + i * i + i // 3) % len(words)] + ("." if i % 9 == 8 else "") for i in range(n))


def awkward(spark, rows: int = 40):
    """Documents in two languages, with null, empty, blank, letterless, one-word and very long texts, null fields, repeated rows and null ids."""
    out = [(i, prose("en" if i % 2 else "de", 30 + 5 * i, i), "en" if i % 2 else "de", f"s{i % 3}", None) for i in range(rows)]
    out += [
        (100, None, "en", "s1", None),
        (101, "", None, None, None),
        (102, " \n\t ", "en", "s1", 3),
        (103, "12 $$ 34 \u0000 ##", "en", None, None),
        (104, "word", "de", "s2", None),
        (105, prose("en", 150_000), "en", "s1", None),
        (106, "x" * 300_000, None, "s2", None),
        (107, "naïve 😀 𐲗 ퟿� 日本語", "en", "s0", None),
        (None, prose("en", 60, 3), "en", "s1", None),
        (None, None, None, None, None),
        (7, prose("en", 65, 7), "en", "s1", None),
        (7, prose("en", 65, 7), "en", "s1", None),
    ]
    return spark.createDataFrame(out, SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels_for(spark, ids, column: str):
    other = {"quality": "toxic", "toxic": "quality"}[column]
    return spark.createDataFrame([(i, v, 0) for i, v in ids] + [(None, 1, 0), (5000, None, None)], f"doc_id bigint, {column} int, {other} int")


def brute_fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[tuple[int, int]]) -> dict[int, int]:
    """Smallest id reachable, by id, for (id, fingerprint) pairs."""
    group = {i: i for i, _ in prints}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in prints:
        for j, b in prints:
            if i < j and (a ^ b).bit_count() <= 4:
                x, y = sorted((root(i), root(j)))
                group[y] = x
    return {i: root(i) for i in group}
