"""Byte-level BPE: encoding and decoding with a given rank file.

A piece of text starts as its bytes. A segment tree over the byte positions holds at each leaf the rank of the pair
that starts there, joined with the position, so its root names the leftmost pair of the lowest rank. A merge joins
two live neighbours and updates three leaves: the left part's, the right part's, and the one before.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import append

#: Pieces up to so many bytes are merged many at a time, in arrays; longer ones one by one.
SHORT = 64
#: Distinct pieces whose ids a worker holds; beyond that it starts anew.
HELD_PIECES = 1 << 18
#: Byte positions of the pieces merged at a time.
TOGETHER = 1 << 18
NONE = np.int64(1 << 62)
#: Bits of a place in a long piece; the bits above hold a rank.
PLACE_BITS = 38


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks by token, from lines of a token in base64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line.strip())}


class Ranks:
    """The tokens of a rank file; a token's id is its rank."""

    def __init__(self, data: bytes):
        self.rank = read_ranks(data)
        if len(set(self.rank.values())) != len(self.rank) or any(bytes([b]) not in self.rank for b in range(256)):
            raise ValueError("a rank file needs every single byte, and each rank once")
        self.first = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        left, right, joined = array("q"), array("q"), array("q")
        for token, rank in self.rank.items():
            for k in range(1, len(token)):
                if (a := self.rank.get(token[:k])) is not None and (b := self.rank.get(token[k:])) is not None:
                    left.append(a)
                    right.append(b)
                    joined.append(rank)
        pairs = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(pairs)
        self.pairs = np.append(pairs[order], NONE)
        self.joined = np.append(np.array(joined, np.int64)[order], 0)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, NONE where the two make no token."""
        key = left << 32 | right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.joined[at], NONE)


def merge_long(piece: bytes, ranks: Ranks) -> list[int]:
    """The ids of one piece.

    A pair's rank and place are one number, so the least of a node is the leftmost pair of the least rank. Tree and
    neighbours are plain arrays, 24 bytes for each byte of the piece.
    """
    n, rank, none = len(piece), ranks.rank, int(NONE)
    raw = np.frombuffer(piece, np.uint8)
    tree = array("q", [none]) * n
    for start in range(0, n, TOGETHER):
        ids = ranks.first[raw[start : start + TOGETHER + 1]]
        own = ranks.join(ids[:-1], ids[1:])
        places = np.arange(start, start + len(own), dtype=np.int64)
        tree.frombytes(np.where(own != NONE, own << PLACE_BITS | places, NONE).tobytes())
    tree.append(none)  # the last byte begins no pair
    for node in range(n - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    kind = "i" if n < 1 << 31 else "q"
    after, before = array(kind, range(1, n + 1)), array(kind, range(-1, n - 1))

    def update(i: int) -> None:
        j = after[i]
        r = rank.get(piece[i : after[j]]) if j < n else None
        put(i, none if r is None else r << PLACE_BITS | i)

    def put(i: int, value: int) -> None:
        node = n + i
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                return
            tree[node] = least

    while n > 1 and (top := tree[1]) != none:
        i = top & ((1 << PLACE_BITS) - 1)
        j = after[i]
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        put(j, none)
        update(i)
        if before[i] >= 0:
            update(before[i])
    ids, i = [], 0
    while i < n:
        ids.append(rank[piece[i : after[i]]])
        i = after[i]
    return ids


def merge_short(pieces: list[bytes], ranks: Ranks, width: int) -> list[np.ndarray]:
    """The ids of many pieces of at most `width` bytes, a power of two: one tree for each piece, updated side by side."""
    count, place_bits = len(pieces), width.bit_length() - 1
    length = np.array([len(p) for p in pieces])
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(count, width)
    live = np.arange(width) < length[:, None]
    ids = np.where(live, ranks.first[raw], -1)
    place = np.arange(width, dtype=np.int64)
    after = np.broadcast_to(place + 1, (count, width)).copy()
    before = np.broadcast_to(place - 1, (count, width)).copy()
    tree = np.full((count, 2 * width), NONE, np.int64)
    rank = ranks.join(ids[:, :-1], ids[:, 1:])
    tree[:, width:-1] = np.where(live[:, 1:] & (rank != NONE), rank << place_bits | place[:-1], NONE)
    for node in range(width - 1, 0, -1):
        np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
    flat, ids, after, before = tree.reshape(-1), ids.reshape(-1), after.reshape(-1), before.reshape(-1)
    row = np.arange(count)
    while True:
        top = flat[row * (2 * width) + 1]
        row, top = row[top != NONE], top[top != NONE]
        if not len(row):
            break
        base, end, root = row * width, length[row], row * (2 * width)
        i = top & (width - 1)
        j = after[base + i]
        k = after[base + j]
        ids[base + i] = top >> place_bits
        ids[base + j] = -1
        after[base + i] = k
        inner = k < end
        before[(base + k)[inner]] = i[inner]
        p = before[base + i]
        outer = p >= 0
        right = np.full(len(row), NONE)
        right[inner] = ranks.join(ids[(base + i)[inner]], ids[(base + k)[inner]])
        left = ranks.join(ids[(base + p)[outer]], ids[(base + i)[outer]])
        flat[root + width + j] = NONE
        flat[root + width + i] = np.where(right != NONE, right << place_bits | i, NONE)
        flat[(root + width + p)[outer]] = np.where(left != NONE, left << place_bits | p[outer], NONE)
        roots = np.concatenate((root, root, root[outer]))
        node = np.concatenate((i, j, p[outer])) + width
        while node[0] > 1:
            node >>= 1
            flat[roots + node] = np.minimum(flat[roots + 2 * node], flat[roots + 2 * node + 1])
    ids = ids.reshape(count, width)
    found = ids >= 0
    return np.split(ids[found].astype(np.uint32), np.cumsum(found.sum(1))[:-1])


def merge_all(pieces: list[bytes], ranks: Ranks) -> list[np.ndarray]:
    """The ids of each piece, a piece that is a token being that token."""
    out: list[np.ndarray | None] = [None] * len(pieces)
    widths: dict[int, list[int]] = {}
    for at, piece in enumerate(pieces):
        if (r := ranks.rank.get(piece)) is not None:
            out[at] = np.array([r], np.uint32)
        elif len(piece) > SHORT:
            out[at] = np.array(merge_long(piece, ranks), np.uint32)
        else:
            widths.setdefault(1 << (len(piece) - 1).bit_length(), []).append(at)
    for width, places in widths.items():
        step = max(1, TOGETHER // width)
        for start in range(0, len(places), step):
            some = places[start : start + step]
            for at, ids in zip(some, merge_short([pieces[p] for p in some], ranks, width)):
                out[at] = ids
    return out


class _Seen(dict):
    """Numbers for pieces, in the order in which they are first seen."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Encoder:
    """Encodes texts; keeps the ids of the pieces it has met."""

    def __init__(self, data: bytes, pattern: str, unassigned: str = ""):
        self.ranks, self.pattern = Ranks(data), regex.compile(pattern)
        self.unassigned, self.private = frozenset(unassigned), dict.fromkeys(map(ord, unassigned), "\ue000")
        #: In UTF-8, a text whose bytes all lie below this one has no unassigned character.
        self.least_byte = min(unassigned).encode()[0] if unassigned else 256
        self.clear()

    def clear(self) -> None:
        """Forget all pieces."""
        self.seen, self.ids = _Seen(), np.empty(0, np.uint32)
        self.starts, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def pieces(self, raw: bytes) -> list[str]:
        """The matches of the pattern; an unassigned character counts as one of private use, neither letter nor digit."""
        text = raw.decode("utf-8", "replace")
        if not raw or np.frombuffer(raw, np.uint8).max() < self.least_byte or self.unassigned.isdisjoint(text):
            return self.pattern.findall(text)
        return [text[slice(*m.span())] for m in self.pattern.finditer(text.translate(self.private))]

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The ids of each text; null and empty texts have none."""
        if len(self.seen) > HELD_PIECES:
            self.clear()
        known = len(self.seen)
        number = self.seen.__getitem__
        numbered = [np.array([*map(number, self.pieces(t or b""))], np.int64) for t in texts]
        if len(self.seen) > known:
            new = merge_all([p.encode() for p in list(self.seen)[known:]], self.ranks)
            counts = np.array([len(x) for x in new])
            self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(counts) - counts))
            self.counts = np.concatenate((self.counts, counts))
            self.ids = np.concatenate((self.ids, *new))
        out = []
        for numbers in numbered:
            counts = self.counts[numbers]
            ends = np.cumsum(counts)
            shift = np.repeat(self.starts[numbers] - (ends - counts), counts)
            out.append(self.ids[shift + np.arange(len(shift))])
        return out


@lru_cache(maxsize=2)
def _encoder(data: bytes, pattern: str, unassigned: str = "") -> Encoder:
    return Encoder(data, pattern, unassigned)


def newer_characters(classes: tuple[str, ...] = (r"\p{L}", r"\p{N}")) -> str:
    """Characters that the pattern library here has in these classes and the tokenizer library has not, as it knows an older Unicode."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    found = set()
    for name in classes:
        theirs = tiktoken.Encoding("one", pat_str=name, mergeable_ranks=single, special_tokens={})
        found |= set(regex.findall(name, every)) - set(theirs.decode(theirs.encode_ordinary(every)))
    return "".join(sorted(found))


def encode(df: DataFrame, ranks: bytes, pattern: str, text: str = "text", unassigned: str = "") -> DataFrame:
    """`df` with `ids`, the token ids of the whole text as little-endian unsigned 32-bit integers.

    `ranks` is the content of a rank file. Each match of `pattern` is encoded by itself; there are no special
    tokens. Characters of `unassigned` count as neither letters nor digits. Null and empty texts give no ids (an empty value). Repeated rows get the same ids, an empty table gives
    no row, and a column `ids` is replaced.
    """

    def compute(texts):
        return [pa.array([ids.astype("<u4").tobytes() for ids in _encoder(ranks, pattern, unassigned).encode(texts)], pa.binary())]

    return append(df, "ids binary", compute, text, done=lambda: _encoder(ranks, pattern, unassigned).clear())


@lru_cache(maxsize=2)
def _tokens(data: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(data).items()}


def decoded(ids: np.ndarray, ranks: bytes) -> bytes:
    """The bytes of the tokens with these ids."""
    return b"".join(map(_tokens(ranks).__getitem__, ids.tolist()))


def decode(df: DataFrame, ranks: bytes, ids: str = "ids") -> DataFrame:
    """`df` with `decoded`, the bytes of the tokens in `ids`; nothing for null. An id without a token is an error."""

    def compute(values):
        return [pa.array([decoded(np.frombuffer(v or b"", "<u4"), ranks) for v in values], pa.binary())]

    return append(df, "decoded binary", compute, ids)


def round_trip(df: DataFrame, ranks: bytes, pattern: str, text: str = "text", unassigned: str = "") -> DataFrame:
    """`df` with `ids` and `decoded`, as `encode` and then `decode` give them, in one pass through the same workers."""

    def compute(texts):
        ids = _encoder(ranks, pattern, unassigned).encode(texts)
        return [pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array([decoded(x, ranks) for x in ids], pa.binary())]

    return append(df, "ids binary, decoded binary", compute, text, done=lambda: _encoder(ranks, pattern, unassigned).clear())
