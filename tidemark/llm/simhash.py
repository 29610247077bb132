"""Near-duplicates by SimHash, compared exactly in tiles.

Distinct fingerprints are dealt into tiles by their number of set bits, and tiles whose numbers lie further apart
than the radius never meet. A task that gets two tiles compares them by exclusive-or and bit counts and returns, for
each fingerprint that has a link, one link to the smallest of its group in these tiles. What hangs together across
tiles is then found by joins.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut

from .common import append, ship, unused

BITS, WORDS, SEED, RADIUS = 64, 4, 42, 4
#: A tile has about this times the square root of the number of fingerprints: 16 thousand of a million, 16 million of a trillion.
TILE = 16
LEAST_TILE = 1024
#: Fingerprints of one tile compared at a time with those of another, so that a task's arrays stay small.
ROWS, COLUMNS = 256, 4096


def fingerprint(text: bytes | None, words: int = WORDS, seed: int = SEED) -> int:
    """The SimHash of all shingles of `words` words, repeats included; A-Z count as a-z. 0 if there is no word."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - words + 1)
    spans = zip(starts[:n].tolist(), ends[min(words, len(found)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, n)
    set_bits = np.zeros(BITS, np.int64)
    for start in range(0, n, 1 << 16):
        some = hashes[start : start + (1 << 16)]
        set_bits += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, column: str = "fp", text: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """`df` with the fingerprint of every whole text as a signed 64-bit integer; 0 for null, empty and blank texts."""

    def compute(texts):
        return [pa.array(np.array([fingerprint(t, words, seed) for t in texts], np.uint64).view(np.int64), pa.int64())]

    return append(df, f"`{column}` bigint", compute, text)


def group_within(values: np.ndarray, split: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints `values`, which are distinct: a fingerprint and the smallest of its group, for each that is not the smallest.

    With `split` 0 all are compared with one another, else those before `split` with those from there on.
    """
    order = np.argsort(values, kind="stable")
    values, side = values[order], order >= split
    group = np.arange(len(values))
    bits = np.bitwise_count(values).astype(np.int64)
    left = np.flatnonzero(~side) if split else np.arange(len(values))
    right = np.flatnonzero(side) if split else left
    left, right = (x[np.argsort(bits[x], kind="stable")] for x in (left, right))
    right_bits = bits[right]
    apart = np.empty((ROWS, COLUMNS), np.uint64)
    count = np.empty((ROWS, COLUMNS), np.uint8)
    for a in range(0, len(left), ROWS):
        rows = left[a : a + ROWS]
        low = a if not split else int(np.searchsorted(right_bits, bits[rows[0]] - radius, "left"))
        high = int(np.searchsorted(right_bits, bits[rows[-1]] + radius, "right"))
        for b in range(low, high, COLUMNS):
            columns = right[b : min(b + COLUMNS, high)]
            x, n = apart[: len(rows), : len(columns)], count[: len(rows), : len(columns)]
            np.bitwise_xor(values[rows][:, None], values[columns], out=x)
            np.bitwise_count(x, out=n)
            if n.min() <= radius:
                i, j = np.nonzero(n <= radius)
                _unite(group, rows[i], columns[j])
    group = _roots(group)
    linked = np.flatnonzero(group != np.arange(len(group)))
    return values[linked], values[group[linked]]


def _roots(group: np.ndarray) -> np.ndarray:
    while True:
        further = group[group]
        if np.array_equal(further, group):
            return group
        group[:] = further


def _unite(group: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Join the groups of linked places; a group is named by its smallest place."""
    while True:
        a, b = _root_of(group, u), _root_of(group, v)
        differ = a != b
        if not differ.any():
            return
        a, b, u, v = a[differ], b[differ], u[differ], v[differ]
        np.minimum.at(group, np.maximum(a, b), np.minimum(a, b))


def _root_of(group: np.ndarray, places: np.ndarray) -> np.ndarray:
    at = group[places]
    while True:
        further = group[at]
        if np.array_equal(further, at):
            group[places] = at
            return at
        at = further


def _classes(counts: dict[int, int], size: int) -> list[tuple[int, int, int]]:
    """Ranges of bit counts with the number of tiles each is dealt into: neighbouring counts share a tile while they fit."""
    out: list[list[int]] = []
    for bits in sorted(counts):
        if out and out[-1][2] + counts[bits] <= size:
            out[-1][1:] = [bits, out[-1][2] + counts[bits]]
        else:
            out.append([bits, bits, counts[bits]])
    return [(low, high, -(-n // size)) for low, high, n in out]


def links(prints: DataFrame, column: str = "fp", radius: int = RADIUS) -> DataFrame:
    """Links (`a`, `b`) that join all distinct fingerprints within `radius` bits as all their pairs would.

    Every pair of tiles that can hold a link is compared in full. What reaches the driver is the number of
    fingerprints for each number of set bits, 65 rows.
    """
    spark = prints.sparkSession
    bits = F.bit_count(F.col(column))
    counts = {r[0]: r[1] for r in prints.groupBy(bits.alias("bits")).count().collect()}
    size = max(LEAST_TILE, math.ceil(TILE * math.sqrt(sum(counts.values()))))
    classes = _classes(counts, size)
    link = T.StructType.fromDDL("a bigint, b bigint")
    if not classes:
        return spark.createDataFrame([], link)
    which = F.coalesce(*[F.when(bits <= high, F.lit(i)) for i, (_, high, _) in enumerate(classes)])
    slices = F.element_at(F.array(*[F.lit(n) for *_, n in classes]), which + 1)
    tiled = prints.select(F.col(column).alias("fp"), which.alias("kind"), F.pmod(F.xxhash64(column), slices).cast("int").alias("slice"))

    def pack(key, table):
        return pa.table({"kind": [key[0].as_py()], "slice": [key[1].as_py()], "fps": [table["fp"].combine_chunks().to_numpy().tobytes()]}, pa.schema([("kind", pa.int32()), ("slice", pa.int32()), ("fps", pa.binary())]))

    ship(spark)
    tiles = cut(tiled.groupBy("kind", "slice").applyInArrow(pack, "kind int, slice int, fps binary"), "simhash-tiles")
    # A tile goes to each pair it is part of, named by its two tiles in order; a pair with itself has it once.
    near = [
        F.when(
            F.col("kind") == i,
            F.array(*[F.struct(F.lit(j).alias("kind"), F.lit(m).alias("slices")) for j, (l2, h2, m) in enumerate(classes) if l2 - high <= radius and low - h2 <= radius]),
        )
        for i, (low, high, _) in enumerate(classes)
    ]
    pairs = (
        tiles.withColumn("other", F.explode(F.coalesce(*near)))
        .withColumn("other_slice", F.explode(F.sequence(F.lit(0), F.col("other.slices") - 1)))
        .withColumn("this", F.struct("kind", "slice"))
        .withColumn("that", F.struct(F.col("other.kind").alias("kind"), F.col("other_slice").cast("int").alias("slice")))
        .select(F.least("this", "that").alias("first"), F.greatest("this", "that").alias("second"), "fps")
    )

    def compare(key, table):
        packed = [np.frombuffer(x.as_py(), np.uint64) for x in table["fps"]]
        values = np.concatenate(packed)
        a, b = group_within(values, len(packed[0]) if len(packed) > 1 else 0, radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return pairs.groupBy("first", "second").applyInArrow(compare, link)


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root` (the smallest node reachable) of all nodes that occur in `edges` (`a`, `b`) with `a` != `b`.

    Rounds of large-star and small-star (Kiveris et al., 2014): each node's neighbours are linked to the smallest
    one. Every step is a grouping and a join, written to the shared folder, so a lost executor costs one step.
    The smallest neighbours are a table of one row per node, so a hub's links can be split in the join.
    """
    one_way = lambda df: df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = cut(one_way(edges.where("a != b")), "simhash-links")
    while not _stars(current):
        both = current.union(current.select("b", "a"))
        least = cut(both.groupBy(F.col("a").alias("u")).agg(F.least("u", F.min("b")).alias("m")), "simhash-least")
        large = both.join(least, F.col("a") == F.col("u")).where("b > u").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = cut(one_way(large.where("a != b")), "simhash-large")
        least = cut(current.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "simhash-least")
        small = current.join(least, F.col("a") == F.col("u")).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        current = cut(one_way(small.select("e.*").where("a != b")), "simhash-small")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node is linked to one smaller node, which has no smaller one itself."""
    return edges.groupBy("a").count().where("count > 1").isEmpty() and edges.join(edges.select(F.col("b").alias("root")).distinct(), F.col("a") == F.col("root"), "left_semi").isEmpty()


def classes(prints: DataFrame, key: str = "doc_id", column: str = "fp", radius: int = RADIUS) -> DataFrame:
    """For each distinct fingerprint (`fp`) the smallest one of its component (`root`) and its `component_id`, the smallest key reachable.

    Null keys count only where a component has no other key; its id is then null. Rows with a null fingerprint are left out.
    """
    own = cut(prints.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("fp")).agg(F.min(key).alias("least")), "simhash-prints")
    nodes = cut(components(links(own, "fp", radius)), "simhash-nodes")
    member = nodes.union(nodes.select("root", "root").distinct())
    linked = cut(member.join(own, F.col("node") == F.col("fp")).select("fp", "root", "least"), "simhash-linked")
    named = cut(linked.groupBy(F.col("root").alias("named")).agg(F.min("least").alias("component_id")), "simhash-named")
    linked = linked.join(named, F.col("root") == F.col("named")).select(F.col("fp").alias("linked"), "root", "component_id")
    alone = F.col("linked").isNull()
    return own.join(linked, F.col("fp") == F.col("linked"), "left").select(
        "fp",
        F.coalesce("root", "fp").alias("root"),
        F.when(alone, F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
    )


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits) and `component_id` of every row of `docs`.

    Null, empty and blank texts have the fingerprint 0, which is linked like any other. Rows that repeat are one
    more row each. A null id gets a result too, but names a component only where there is no other id. An empty
    table gives no row; other columns do not matter.
    """
    prints = cut(fingerprints(docs.select("doc_id", "text"), "fp").select("doc_id", "fp"), "simhash-docs")
    named = cut(classes(prints, radius=radius).withColumnRenamed("fp", "own"), "simhash-classes")
    return prints.join(named, F.col("fp") == F.col("own")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with the columns of `docs`: that with the smallest id.

    Of rows that share the smallest id and differ, one with the smallest fingerprint stays; of rows that agree in
    both, any one. Where a component has no id, its row without id stays in the same way. The documents are written
    once with their fingerprints, to the shared folder.
    """
    fp, owner, owner_fp = unused(docs, "fp"), unused(docs, "owner"), unused(docs, "owner_fp")
    held = cut(fingerprints(docs, fp), "simhash-held")
    prints = held.select("doc_id", F.col(fp).alias("fp"))
    named = cut(classes(prints, radius=radius), "simhash-classes")
    rows = cut(prints.groupBy(F.col("fp").alias("own"), "doc_id").count(), "simhash-rows")
    mine = rows.join(named, (F.col("own") == F.col("fp")) & F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = cut(mine.groupBy("root", "component_id").agg(F.min(F.struct("own", "count")).alias("first")), "simhash-first")
    chosen = first.select(F.col("component_id").alias(owner), F.col("first.own").alias(owner_fp), F.col("first.count").alias("rows"))
    same = (F.col(fp) == F.col(owner_fp)) & F.col("doc_id").eqNullSafe(F.col(owner))
    single = held.join(chosen.where("rows = 1").drop("rows"), same, "left_semi")
    repeated = held.join(chosen.where("rows > 1").drop("rows"), same, "left_semi").dropDuplicates(["doc_id", fp])
    return single.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
