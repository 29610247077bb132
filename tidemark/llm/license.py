"""License scans by conditional compression.

A candidate block is a stretch of words, about twice as long as some template, that has a rare word of it (a cue) and all
but a few of its other words, in any order. It is compressed without a dictionary and with each template as zstandard raw
dictionary, and the templates are ranked by what they take away. A template wins if that is a good part of what it takes away from its own
text. Winners are compared with the block word by word, those that took away most first, and are reported where
their wording is there, up to a few words; where two finds overlap the larger reduction stays.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import parts, raw_texts, ship

# Wording of licenses and of the notices by which works name them.
TEMPLATES: dict[str, str] = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
_CC = {"": "", "-SA": "-ShareAlike", "-NC": "-NonCommercial", "-ND": "-NoDerivatives", "-NC-SA": "-NonCommercial-ShareAlike", "-NC-ND": "-NonCommercial-NoDerivatives"}
_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
# Other usual wordings, and licenses beyond those above.
NOTICES: tuple[tuple[str, str], ...] = (
    ("MIT-notice", "MIT License"),
    ("MIT-notice", "License: MIT"),
    ("MIT-notice", "Licensed under the MIT License"),
    ("MIT-notice", "Licensed under the terms of the MIT License"),
    ("MIT-notice", "SPDX-License-Identifier: MIT"),
    ("MIT-notice", "The MIT License (MIT)"),
    ("Apache-2.0-notice", "Licensed under the Apache License 2.0"),
    ("Apache-2.0-notice", "Licensed under the terms of the Apache License, Version 2.0"),
    ("Apache-2.0-notice", "Apache License, v2.0"),
    ("Apache-2.0-notice", "Licensed under Apache 2.0"),
    ("Apache-2.0-notice", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause-notice", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause-notice", "Licensed under the BSD 3-Clause License"),
    ("MPL-2.0-notice", "Licensed under the Mozilla Public License 2.0"),
    ("MPL-2.0-notice", "Licensed under the Mozilla Public License, v2.0"),
    *((f"{name}-{n}.0-notice", f"Distributed under the {text} {v}") for name, text in _GNU.items() for n in ((2, 3) if name == "GPL" else (3,)) for v in (f"version {n}", f"version {n}.0", f"v{n}", f"v{n}.0")),
    *((f"{name}-{n}.0-notice", f"Licensed under the {name}{v}") for name in _GNU for n in ((2, 3) if name == "GPL" else (3,)) for v in (f"v{n}", f" v{n}", f"-{n}.0", f" version {n}")),
    *((f"CC-BY{kind}-4.0{'' if kind in ('', '-SA', '-NC') else '-notice'}", f"Licensed under the Creative Commons Attribution{words} 4.0 International License") for kind, words in _CC.items()),
    *((f"{name}-{n}.0-notice", text) for name in _GNU for n in ((2, 3) if name == "GPL" else (3,)) for text in (f"License: {name}v{n}", f"{name}v{n} License")),
    *((f"CC-BY{kind}-4.0-notice", f"Creative Commons Attribution{words} 4.0") for kind, words in _CC.items()),
    *((f"CC-BY{kind}-4.0-notice", f"Available under CC BY{kind} 4.0") for kind in _CC),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC-notice", "Licensed under the ISC License"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Zlib-notice", "Licensed under the zlib License"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software"),
    ("BSL-1.0-notice", "Distributed under the Boost Software License, Version 1.0"),
    ("EPL-1.0-notice", "made available under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0-notice", "made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0-notice", "Licensed under the Eclipse Public License v2.0"),
)
#: Words that name a license: none of a template's may be missing, and none may be added. Its numbers may not be missing either.
NAMES = frozenset(
    "mit apache bsd isc zlib boost bsl eclipse epl mozilla mpl gnu gpl lgpl agpl lesser affero cc cc0 creative commons "
    "attribution sharealike noncommercial noderivatives noderivs sa nc nd".split()
)
#: In a template so short that its share of words is none, one word may differ, but only these: all others name something.
GENERIC = frozenset("a an available code distributed file for in is it license licensed made of program project provided public released software source terms the this to under v version with work".split())
WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
LEVEL = 19
#: Share of a template's words that may be missing, and of words that may be added between them: at least one, but none
#: in a template of fewer than WHOLE words.
TOLERANCE, WHOLE = 0.1, 4
#: A template wins in a block if it takes away this share of what it takes away from its own text. Of 6,120 wordings with all
#: differences that are allowed, amid other words, 6,085 reach it, and of blocks of
#: other words 0.16 %; both by `tests/llm/test_llm_license.py`.
LEAST_SHARE = 0.15


def allowed(length: int) -> int:
    return max(1, int(length * TOLERANCE)) if length >= WHOLE else 0


def fixed(template: tuple[str, ...]) -> frozenset[str]:
    """The words of a template that must be there."""
    short = int(len(template) * TOLERANCE) == 0
    return frozenset(w for w in template if w in NAMES or re.search("[0-9]", w) or (short and w not in GENERIC))


#: Other spellings of the same words.
SPELLINGS = {"licence": "license", "licenced": "licensed"}


def _words(text: str) -> tuple[str, ...]:
    return tuple(SPELLINGS.get(w := m.lower(), w) for m in WORD.findall(text))


def cues(template: tuple[str, ...]) -> frozenset[str]:
    """Words of which every tolerated wording of the template has one: a name that must be there, else so many that not all may be missing.

    Names come before other words without digits, these before generic ones, and longer words first, as they are rarer.
    """
    words, needed = set(template), fixed(template)
    order = sorted(words, key=lambda w: (w in GENERIC, bool(re.search("[0-9]", w)), w not in NAMES, -len(w), w))
    sure = [w for w in order if w in needed]
    if sure:
        return frozenset(sure[:1])
    most = allowed(len(template))
    if len(words) <= most:
        raise ValueError(f"a template of {len(words)} different words has no cue: {' '.join(template)!r}")
    return frozenset(order[: most + 1])


#: Matches every default template; blocks lie around the words that `cues` gives for each.
CUE = re.compile(rf"\b(?:{'|'.join(sorted(re.escape(w) for w in {w for _, text in (*TEMPLATES.items(), *NOTICES) for w in cues(_words(text))}))})\b", re.IGNORECASE)


@dataclass(frozen=True)
class Template:
    """A license's wording, the words looked for, and what it takes away from its own text when that is compressed with it."""

    name: str
    words: tuple[str, ...]
    cues: frozenset[str]
    needed: frozenset[str]
    dictionary: zstandard.ZstdCompressor
    gain: int


@lru_cache(maxsize=4)
def templates_of(items: tuple[tuple[str, str], ...]) -> list[Template]:
    out = []
    for name, text in items:
        words = _words(text)
        raw = " ".join(words).encode()
        data = zstandard.ZstdCompressionDict(raw.rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False)
        out.append(Template(name, words, cues(words), fixed(words), dictionary, compressed(raw) - compressed(raw, dictionary)))
    return out


@lru_cache(maxsize=1)
def _plain() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)


def compressed(raw: bytes, dictionary: zstandard.ZstdCompressor | None = None) -> int:
    """The size of some bytes, compressed alone or with a template as dictionary."""
    return len((dictionary or _plain()).compress(raw))


def taken_away(words: list[str], t: Template) -> tuple[int, float]:
    """The bytes that a template takes away from some words, and the share of their compressed size that this is."""
    raw = " ".join(words).encode()
    alone = compressed(raw)
    taken = alone - compressed(raw, t.dictionary)
    return taken, taken / alone


def ranking(block: list[str], known: list[Template]) -> list[Template]:
    """The templates that win in a block, those that take away most first."""
    raw = " ".join(block).encode()
    alone = compressed(raw)
    taken = [(alone - compressed(raw, t.dictionary), t) for t in known]
    winners = [(n, t) for n, t in taken if n > 0 and n >= LEAST_SHARE * t.gain]
    return [t for _, t in sorted(winners, key=lambda w: (-w[0], -len(w[1].words), w[1].name))]


def blocks(places: list[int], words: int, length: int) -> list[tuple[int, int]]:
    """Blocks for a template of `length` words, as ranges of word numbers.

    Whatever can begin a find with a cue at one of `places` is covered by blocks of twice that and a little more, each beginning
    `length` words after the one before, so every place of the template lies whole in the block it begins in the
    first half of.
    """
    spans: list[list[int]] = []
    for place in places:
        low, high = max(0, place - length - allowed(length)), place + 1
        if spans and low <= spans[-1][1]:
            spans[-1][1] = high
        else:
            spans.append([low, high])
    return [(start, min(words, start + 2 * length + allowed(length))) for low, high in spans for start in range(low, high, length)]


def differences(template: tuple[str, ...], block: list[str]) -> list[tuple[int, int, int, int]]:
    """Places that begin in the first half of `block` and hold the template's wording: first and last word, words missing, words added."""
    out, start = [], 0
    most, needed = allowed(len(template)), fixed(template)
    first = set(template[: most + 1])
    while start < min(len(block), len(template)):
        part = block[start : start + len(template) + most]
        if part[0] in first and needed.issubset(part):
            runs = [r for r in SequenceMatcher(None, template, part, autojunk=False).get_matching_blocks() if r.size]
            same, end = sum(r.size for r in runs), runs[-1].b + runs[-1].size
            missing, added = len(template) - same, end - runs[0].b - same
            if runs[0].b == 0 and missing <= most and added <= most and _names_agree(template, part[:end], runs, needed):
                out.append((start, start + end - 1, missing, added))
                start += end
                continue
        start += 1
    return out


def _names_agree(template: tuple[str, ...], part: list[str], runs: list, needed: frozenset[str]) -> bool:
    """Whether no word that must be there is missing, and no added word names another license."""
    there, here = ({i for r in runs for i in range(at(r), at(r) + r.size)} for at in (lambda r: r.a, lambda r: r.b))
    return not any(w in needed for i, w in enumerate(template) if i not in there) and not any(w in NAMES for i, w in enumerate(part) if i not in here)


def candidates(words: list[str], known: list[Template]) -> list[tuple[int, int]]:
    """Blocks of a text, as ranges of word numbers, that have all words of some template but those that may be missing, in any order."""
    places: dict[str, list[int]] = {}
    telling = frozenset().union(*[t.cues for t in known])
    for i, word in enumerate(words):
        if word in telling:
            places.setdefault(word, []).append(i)
    present = set(words) if places else set()
    found = set()
    for t in known:
        own = sorted(i for cue in t.cues for i in places.get(cue, ()))
        if own and t.needed <= present:
            for low, high in blocks(own, len(words), len(t.words)):
                here = set(words[low:high])
                if t.needed <= here and sum(w not in here for w in set(t.words)) <= allowed(len(t.words)):
                    found.add((low, high))
    return sorted(found)


def find(text: str, items: tuple[tuple[str, str], ...]) -> list[tuple[int, int, str, float, int, int]]:
    """Licenses in a text: first and last character, name, size reduction, words missing, words added; in the order of the text.

    A text without a word has none. A long text costs its list of words, and work only around the cues.
    """
    words, known = list(_words(text)), templates_of(items)
    near = []
    for low, high in candidates(words, known):
        for t in ranking(words[low:high], known):
            for a, b, missing, added in differences(t.words, words[low:high]):
                near.append((*taken_away(words[low + a : low + b + 1], t), t, low + a, low + b, missing, added))
    return resolved(text, near)


def resolved(text: str, near: list[tuple]) -> list[tuple[int, int, str, float, int, int]]:
    """Of overlapping finds the one with the larger reduction; of equal ones that with fewer differences, the longer one, the first by name."""
    matches = list(WORD.finditer(text)) if near else []
    taken = bytearray(len(matches))
    out: list[tuple[int, int, str, float, int, int]] = []
    for _, share, t, a, b, missing, added in sorted(near, key=lambda n: (-n[0], n[5] + n[6], -len(n[2].words), n[2].name, n[3])):
        if not any(taken[a : b + 1]):
            taken[a : b + 1] = bytes([1]) * (b + 1 - a)
            out.append((matches[a].start(), matches[b].end(), t.name, share, missing, added))
    return sorted(out)


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per license found in a text: `doc_id`, `license`, `start` and `end` (code points), `reduction`, `missing`, `added`.

    `missing` and `added` count the template's words that are not there and the words between them; both are 0 for
    the exact wording, whatever its case, punctuation and line breaks. `reduction` is the share of its words' compressed
    size that the template takes away; of overlapping finds the one that takes away more stays. Names and numbers of licenses may not differ. Without `templates`
    TEMPLATES and NOTICES are looked for. A template that has too few different words for a cue is refused. Null and empty texts have no license. Repeated rows give repeated
    rows; an empty table, or no template, gives no row; other columns do not matter.
    """
    items = (*TEMPLATES.items(), *NOTICES) if templates is None else tuple(templates.items())

    for _, wording in items:
        cues(_words(wording))

    def run(batches):
        for batch in batches:
            for part in parts(batch, "text"):
                rows = []
                for at, text in enumerate(raw_texts(part, "text")):
                    if text and items:
                        rows += [(at, *x) for x in find(text.decode("utf-8", "replace"), items)]
                at, start, end, name, reduction, missing, added = zip(*rows) if rows else [()] * 7
                ids = part.column(0).take(pa.array(at, pa.int64()))
                whole = [pa.array(x, pa.int64()) for x in (start, end)]
                counts = [pa.array(x, pa.int32()) for x in (missing, added)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(name, pa.string()), *whole, pa.array(reduction, pa.float64()), *counts], names=["doc_id", "license", "start", "end", "reduction", "missing", "added"])

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, license string, `start` bigint, `end` bigint, reduction double, missing int, added int")
