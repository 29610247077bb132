"""Best-fit packing of documents into sequences, in bulk-synchronous rounds.

Documents and the gaps of open sequences are sorted by size; each row has a place among those of its size. A round
sweeps the sizes from large to small: documents of a length go to their successors, the smallest gaps that are large
enough, as many into each as it holds. Where several want one gap the place decides: those of a length with places
a to b go to the gaps of a size with places c to d. A sweep needs only the number of rows of each size, so it passes
on a few numbers, at most two for each size, and gives a list of such runs; the rows meet their gaps in tasks, by
place. Then the gaps have new sizes, whose order follows from the runs, and the next round begins.

Documents that no gap holds open sequences, the largest first: a round that has opened some for a length goes down to
a share of that length, so that smaller documents find the new gaps in the next one.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut, local_rows

from .common import parts, raw_texts, ship, unused
from .ranks import ranked

CAPACITY, END = 1024, 2
#: In a round sequences are opened down to this share of the largest length that no gap holds.
SHARE = 0.6

#: Fixed: the characters that the tokenizer's pattern takes for white space.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run of white space and what follows it. The tokenizer's pattern never joins what lies before such a run with the run.
SPACES = frozenset(c for c in map(chr, range(0x3001)) if re.fullmatch(f"[{SPACE}]", c))
#: Fixed: ranges of characters that are letters in every version of Unicode, and signs and digits that never are.
LETTER = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f\u0391-\u03a1\u03a3-\u03a9\u03b1-\u03c9\u0410-\u044f"
SIGN = r"!-@\[-`{-~"
#: What is encoded by itself: a run of white space with the letters behind it, if a sign follows them, or with all that
#: follows. The tokenizer's pattern joins neither white space with what lies before it nor a letter with a later sign.
UNIT = re.compile(f"[{SPACE}]*[{LETTER}]+(?=[{SPACE}{SIGN}]|$)|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+$")
RUN_START = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")
#: In a long unit, the places behind a letter and before a sign or digit are ends too.
SIGN_START = re.compile(r"(?<=[A-Za-z\u3041-\u3096\u4e00-\u9fa5])(?=[0-9.,;:!?\u3001\u3002])")
LONG_UNIT, WINDOW = 1 << 16, 1 << 20
#: Characters of new units that the library encodes at a time.
BLOCK = 1 << 16
#: Units that a worker remembers before it forgets them all, and their bytes.
UNITS, UNIT_BYTES = 1 << 19, 64 << 20


class Tokens:
    """Ids of whole texts. A unit is encoded by the tokenizer library once and remembered; a text's ids are those of its units."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer)
        self.library.encode_special_tokens = True  # what looks like a special token in a text is text
        # A byte-level token has one character for each byte.
        names = self.library.get_vocab()
        self.lengths = np.zeros(max(names.values()) + 1, np.int64)
        self.lengths[list(names.values())] = list(map(len, names))
        self.known: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers. A long text is taken in windows that end before a run of white space."""
        found: list[bytes] = []
        for some in self._windows(texts):
            units = [_units(text) for text, _ in some]
            self._learn_new(units)
            for own, (_, last) in zip(units, some):
                found.append(b"".join(map(self.known.__getitem__, own)))
                if last:
                    yield b"".join(found)
                    found.clear()

    @staticmethod
    def _windows(texts: list[str]) -> Iterator[list[tuple[str, bool]]]:
        """The texts in order, in windows marked by whether they end a text, some at a time."""
        some, size = [], 0
        for text in texts:
            start, last = 0, False
            while not last:
                stop = RUN_START.search(text, start + WINDOW) if len(text) - start > WINDOW else None
                last, end = stop is None, stop.start() if stop else len(text)
                some.append((text[start:end], last))
                size, start = size + end - start, end
                if size >= WINDOW:
                    yield some
                    some, size = [], 0
        if some:
            yield some

    def _learn_new(self, units: list[list[str]]) -> None:
        if len(self.known) > UNITS or self.held > UNIT_BYTES:
            self.known, self.held = {}, 0
        new = list(set().union(*units).difference(self.known))
        spaced = [u for u in new if u[0] in SPACES and u[-1] not in SPACES]
        for some in _blocks(spaced):
            self._learn_joined(some)
        for some in _blocks([u for u in new if u[0] not in SPACES or u[-1] in SPACES]):
            for unit, encoding in zip(some, self.library.encode_batch(some, add_special_tokens=False)):
                self._learn(unit, np.array(encoding.ids, "<u4").tobytes())
    def _learn(self, unit: str, ids: bytes) -> None:
        self.known[unit] = ids
        self.held += len(unit) + len(ids)

    def _learn_joined(self, units: list[str]) -> None:
        """Units that begin with white space and end with something else, in one call: the library never joins two of them."""
        ids = np.array(self.library.encode("".join(units), add_special_tokens=False).ids, "<u4")
        ends = np.cumsum(self.lengths[ids])
        stops = np.searchsorted(ends, np.cumsum([len(u.encode()) for u in units])) + 1
        whole, start = ids.tobytes(), 0
        for unit, stop in zip(units, (4 * stops).tolist()):
            self._learn(unit, whole[start:stop])
            start = stop


def _blocks(units: list[str]) -> Iterator[list[str]]:
    """The units in lists of bounded size, since the library holds a block's tokens at once; a long unit is one by itself."""
    held: list[str] = []
    size = 0
    for unit in units:
        if held and size + len(unit) > BLOCK:
            yield held
            held, size = [], 0
        held.append(unit)
        size += len(unit)
    if held:
        yield held


def _units(text: str) -> list[str]:
    units = UNIT.findall(text)
    if len(text) > LONG_UNIT:
        return [part for u in units for part in ([u] if len(u) <= LONG_UNIT else filter(None, SIGN_START.split(u)))]
    return units


@lru_cache(maxsize=2)
def _tokens(tokenizer: str) -> Tokens:
    return Tokens(tokenizer)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """The pieces of every document: `key`, `piece` (from 0), `start`, `length`, `ids_crc32`, and with `ids` their token ids as bytes too.

    `tokenizer` is the content of a tokenizer file; each document's ids end with `end`. A document of more than
    `capacity` ids is cut into pieces of that length, of which the first may be shorter. Null texts count as empty
    and have the one id `end`; bytes that are no UTF-8 count as replacement characters. Texts of any length are
    encoded whole, in windows; what costs memory is one run without white space, signs or digits.
    """
    id_type = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, id_type), *T.StructType.fromDDL("piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if ids else "")).fields])
    last = np.array([end], "<u4").tobytes()
    content = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(content.value)
        for batch in batches:
            for part in parts(batch, text):
                row, piece, start, length, crc, held = [], [], [], [], [], []
                texts = [(t or b"").decode("utf-8", "replace") for t in raw_texts(part, text)]
                for i, encoded in enumerate(tokens.encode(texts)):
                    encoded += last
                    n = len(encoded) // 4
                    at, stop, number = 0, (n - 1) % capacity + 1, 0
                    while at < n:
                        own = encoded[4 * at : 4 * stop]
                        row.append(i)
                        piece.append(number)
                        start.append(at)
                        length.append(stop - at)
                        crc.append(zlib.crc32(own))
                        if ids:
                            held.append(own)
                        at, stop, number = stop, stop + capacity, number + 1
                columns = [pa.array(piece, pa.int32()), *[pa.array(c, pa.int64()) for c in (start, length, crc)]] + ([pa.array(held, pa.binary())] if ids else [])
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(key)).take(pa.array(row, pa.int64())), *columns], names=schema.names)

    ship(docs.sparkSession)
    return docs.select(key, text).mapInArrow(run, schema)


class Round:
    """What one sweep decides, as runs of places.

    `matches`: (length, first, until, gap, first gap, each) - documents of a length with places from `first` go to the gaps of
    a size with places from `first gap`, `each` to a gap. `opens`: (length, first, until, sequence, offset, each) - they open
    sequences from that number. `births`: (length, first, each, size, place) gaps of opened sequences that hold one
    length, `singles`: (sequence, size, place) those of others. `moves`: (size, first, until, new size, place).
    """

    def __init__(self) -> None:
        self.matches, self.opens, self.births, self.singles, self.moves = [], [], [], [], []


def sweep(waiting: Counter, placed: Counter, gaps: Counter, opened: int, capacity: int, share: float = SHARE) -> tuple[Round, Counter, int]:
    """One sweep over the sizes; takes what it places out of `waiting` and returns the gaps afterwards and the number of sequences.

    `waiting` and `gaps` are numbers of rows by size, `placed` the place up to which the documents of a length are gone.
    """
    out, after = Round(), Counter()
    stack: list[list[int]] = []  # (size, next place, rows left), the smallest gap that is large enough on top
    loose: list[list[int]] = []  # (gap, sequence) of sequences opened in this sweep that may take more
    limit = None

    def move(size: int, first: int, rows: int, new: int) -> None:
        if rows and new:
            out.moves.append((size, first, first + rows, new, after[new]))
            after[new] += rows

    for length in range(capacity, 0, -1):
        if gaps[length]:
            stack.append([length, 0, gaps[length]])
        if not waiting[length] or (limit is not None and length <= limit):
            continue
        at, left = placed[length], waiting[length]
        while left and stack:
            size, place, rows = stack[-1]
            each = size // length
            used = min(rows, -(-left // each))
            taken = min(left, used * each)
            out.matches.append((length, at, at + taken, size, place, each))
            move(size, place, taken // each, size - each * length)
            move(size, place + taken // each, used - taken // each, size - taken % each * length)
            at, left = at + taken, left - taken
            stack[-1][1:] = [place + used, rows - used]
            if rows == used:
                stack.pop()
        if left:
            if limit is None:
                limit = capacity // 2 if length > capacity // 2 else int(length * share)
            for one in sorted(loose):
                taken = min(left, one[0] // length)
                if taken:
                    out.opens.append((length, at, at + taken, one[1], capacity - one[0], taken))
                    one[0] -= taken * length
                    at, left = at + taken, left - taken
            each = capacity // length
            whole, rest = divmod(left, each)
            if whole:
                out.opens.append((length, at, at + whole * each, opened, 0, each))
                if capacity - each * length:
                    out.births.append((length, at, at + whole * each, each, capacity - each * length, after[capacity - each * length]))
                    after[capacity - each * length] += whole
                at, opened = at + whole * each, opened + whole
            if rest:
                out.opens.append((length, at, at + rest, opened, 0, rest))
                loose.append([capacity - rest * length, opened])
                at, opened = at + rest, opened + 1
        waiting[length] -= at - placed[length]
        placed[length] = at
    for size, place, rows in stack:
        move(size, place, rows, size)
    # Sizes below the limit have been pushed too: the loop goes through all of them.
    for gap, sequence in loose:
        if gap:
            out.singles.append((sequence, gap, after[gap]))
            after[gap] += 1
    return out, after, opened


def _runs(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A list that a sweep gave, a bounded number for each size, sent to all tasks."""
    return F.broadcast(local_rows(spark, rows, ", ".join(f"{n} bigint" for n in names.split())))


def pack(items: DataFrame, capacity: int = CAPACITY, share: float = SHARE) -> tuple[DataFrame, int]:
    """`uid`, `sequence_id` and `offset` of every item (`uid`, `length` from 1 to `capacity`), and the number of sequences.

    The numbers of items by length reach the driver, at most `capacity` of them. Every round is stored.
    """
    spark = items.sparkSession
    sorted_ = ranked(items.select("uid", F.col("length").cast("bigint").alias("length")), "length", ["uid"]).drop("total")
    sorted_ = cut(sorted_, "packing-items")
    waiting = Counter({r["length"]: r["count"] for r in sorted_.groupBy("length").count().collect()})
    placed: Counter = Counter()
    gaps: Counter = Counter()
    opened, stored, found = 0, None, []

    def items_of(runs: list[tuple], names: str) -> DataFrame:
        some = _runs(spark, runs, "r_length first until " + names)
        return sorted_.join(some, (F.col("length") == F.col("r_length")) & (F.col("at") >= F.col("first")) & (F.col("at") < F.col("until")))

    while sum(waiting.values()):
        plan, after, opened = sweep(waiting, placed, gaps, opened, capacity, share)
        order = F.col("at") - F.col("first")
        inside = (order % F.col("each")) * F.col("length")
        if plan.matches:
            wanted = items_of(plan.matches, "size first_gap each").select("uid", "size", (F.col("first_gap") + F.floor(order / F.col("each"))).alias("place"), inside.alias("inside"))
            met = wanted.join(stored, ["size", "place"]).select("uid", "sequence_id", (capacity - F.col("size") + F.col("inside")).alias("offset"))
            found.append(cut(met, "packing-matched"))
        if plan.opens:
            new = items_of(plan.opens, "sequence start each").select("uid", (F.col("sequence") + F.floor(order / F.col("each"))).alias("sequence_id"), (F.col("start") + inside).alias("offset"))
            found.append(new)
        if sum(waiting.values()):
            parts_of = []
            if plan.moves:
                moves = _runs(spark, plan.moves, "m_size first until new_size new_place")
                moved = stored.join(moves, (F.col("size") == F.col("m_size")) & (F.col("place") >= F.col("first")) & (F.col("place") < F.col("until")))
                parts_of.append(moved.select("sequence_id", F.col("new_size").alias("size"), (F.col("new_place") + F.col("place") - F.col("first")).alias("place")))
            if plan.births:
                # The first document of a sequence stands for it; its number follows from the run that opened it.
                starts = {(length, first): sequence for length, first, _, sequence, offset, _ in plan.opens if not offset}
                born = items_of([(n, a, b, starts[n, a], each, size, place) for n, a, b, each, size, place in plan.births], "sequence each size new_place")
                nth = F.floor(order / F.col("each"))
                parts_of.append(born.where(order % F.col("each") == 0).select((F.col("sequence") + nth).alias("sequence_id"), "size", (F.col("new_place") + nth).alias("place")))
            parts_of.append(local_rows(spark, plan.singles, "sequence_id bigint, size bigint, place bigint"))
            stored = cut(reduce(DataFrame.union, parts_of), "packing-gaps")
        gaps = after
    none = spark.createDataFrame([], "uid bigint, sequence_id bigint, offset bigint")
    return reduce(DataFrame.union, found, none), opened


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, share: float = SHARE, ids: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of `pieces` with `sequence_id` and `offset`; the sequences are filled from 0 without a hole.

    Documents longer than a sequence, and no others, are cut. Pieces as long as a sequence have one of their own; all
    others take part in the rounds. Null and empty texts are pieces of one id. Rows that repeat, and null keys, are
    packed like others; an empty table gives no row; other columns do not matter. Any number of documents may have
    one length: places divide them, not the length.
    """
    cut_up = pieces(docs, tokenizer, capacity, end, key, text, ids)
    uid = unused(cut_up, "uid")
    held = cut(cut_up.withColumn(uid, F.monotonically_increasing_id()), "packing-pieces")
    short = held.where(F.col("length") < capacity)
    placed, opened = pack(short.select(F.col(uid).alias("uid"), "length"), capacity, share)
    placed = placed.withColumnRenamed("uid", "placed_uid")
    both = short.join(placed, F.col(uid) == F.col("placed_uid")).drop("placed_uid", uid)
    whole = held.where(F.col("length") == capacity).withColumn("sequence_id", F.col(uid) + F.lit(opened)).withColumn("offset", F.lit(0).cast("bigint")).drop(uid)
    return both.unionByName(whole)


def sequences(packed_ids: DataFrame) -> DataFrame:
    """One row for each sequence of `packed(..., ids=True)`: `sequence_id`, `length` and its `ids` as bytes."""
    order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    filled = packed_ids.groupBy("sequence_id").agg(F.sum("length").alias("length"), order.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    return filled.select("sequence_id", "length", joined.alias("ids"))
