"""Nearest neighbours by multi-index hashing.

Vectors get binary codes from a learned rotation (PCA, then iterative quantisation). A code is cut into substrings,
each with an index of its values. Codes within a radius of r bits agree with the query's in some substring up to
r / substrings bits, so probing those values finds every code within the radius; the floats then rank them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut

from .common import ship

SUBSTRINGS, SUBSTRING_BITS = 4, 16
BITS = SUBSTRINGS * SUBSTRING_BITS
SAMPLE = 8192
#: Rows and queries of a block: this times the square root of their number, so that copies of rows grow slowly.
BLOCK, LEAST_BLOCK = 16, 1024


@dataclass(frozen=True)
class AnnModel:
    """`mean` and `rotation` (dimensions x bits) of the codes, and the radius to search first."""

    mean: np.ndarray = field(repr=False)
    rotation: np.ndarray = field(repr=False)
    radius: int

    @property
    def dimensions(self) -> int:
        return len(self.mean)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """64-bit codes of vectors (rows); bits beyond the rotation's are 0."""
        unit = vectors / _lengths(vectors)[:, None]
        bits = np.zeros((len(vectors), BITS), bool)
        bits[:, : self.rotation.shape[1]] = (unit - self.mean) @ self.rotation > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Lengths that neither overflow nor vanish for finite vectors that are not 0."""
    most = np.abs(vectors).max(axis=1, initial=0)
    scale = np.where(most > 0, most, 1.0)
    return scale * np.sqrt(((vectors / scale[:, None]) ** 2).sum(axis=1))


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines in double precision; the same for equal vectors wherever they stand."""
    scale = lambda x: x / np.abs(x).max(axis=-1, keepdims=True)
    a, b = scale(vectors), scale(query)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum()))


def usable(column: str | Column = "embedding") -> Column:
    """Whether a vector takes part: not null, not empty, every component finite, one at least not 0."""
    vector = F.col(column) if isinstance(column, str) else column
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def lengths(rows: DataFrame) -> dict[int, int]:
    """The number of usable vectors of each length, the most frequent one first, the longer one of equals. One row a length reaches the driver."""
    counts = rows.where(usable()).groupBy(F.size("embedding").alias("size")).count().collect()
    return {r["size"]: r["count"] for r in sorted(counts, key=lambda r: (-r["count"], -r["size"]))}


def fit(rows: DataFrame, sample: int = SAMPLE, neighbours: int = 5, found: float = 0.98, rounds: int = 30, length: tuple[int, int] | None = None) -> AnnModel | None:
    """Rotation and radius from about `sample` usable vectors, drawn by a hash of the id; None without any.

    They are for vectors of one `length`, given with their number; without it the most frequent length counts. The radius is that within which, in the
    sample, the share `found` of true nearest neighbours lies; in the whole table they are nearer still.
    """
    good = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(usable())
    length = length or next(iter(lengths(good).items()), None)
    if length is None:
        return None
    dimensions, count = length
    drawn = good.where(F.size("embedding") == dimensions).where(F.pmod(F.xxhash64(F.lit(20), "vec_id"), F.lit(1 << 30)) < round(min(1.0, sample / count) * (1 << 30)))
    taken = drawn.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(2 * sample).toArrow()["embedding"].combine_chunks()
    if len(taken) == 0:
        taken = good.where(F.size("embedding") == dimensions).orderBy("vec_id", "embedding").limit(1).toArrow()["embedding"].combine_chunks()
    vectors = taken.flatten().to_numpy().reshape(-1, dimensions)
    unit = vectors / _lengths(vectors)[:, None]
    mean = unit.mean(axis=0)
    centred = unit - mean
    bits = min(BITS, dimensions)
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    low = centred @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((bits, bits)))
    for _ in range(rounds):
        u, _, v = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
        turn = v.T @ u.T
    model = AnnModel(mean, axes @ turn, BITS)
    asked = unit[:: max(1, len(unit) // 512)][:512]
    codes, own = model.codes(unit), model.codes(asked)
    distances = []
    for vector, code in zip(asked, own):
        near = unit @ vector
        best = np.argsort(-near, kind="stable")[1 : neighbours + 1]
        distances.extend(np.bitwise_count(codes[best] ^ code).tolist())
    radius = int(np.ceil(np.quantile(distances, found))) if distances else BITS
    return AnnModel(mean, axes @ turn, radius)


def index(rows: DataFrame, model: AnnModel) -> DataFrame:
    """`vec_id`, `embedding` (double) and `code` of every usable vector of the model's length."""
    good = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(usable() & (F.size("embedding") == model.dimensions))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                vectors = batch.column(1).flatten().to_numpy().reshape(-1, model.dimensions)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.codes(vectors).view(np.int64))], names=["vec_id", "embedding", "code"])

    ship(rows.sparkSession)
    return good.mapInArrow(run, "vec_id bigint, embedding array<double>, code bigint")


class Block:
    """Codes and vectors of some rows, with an index for each substring."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        self.ids, self.vectors, self.codes = ids, vectors, codes
        self.unit = vectors / _lengths(vectors)[:, None]
        self.buckets = [np.unique(part, return_inverse=True) for part in codes.view(np.uint16).reshape(-1, SUBSTRINGS).T]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """The rows whose code differs in at most `radius` bits, found by probing the substrings.

        With a radius of s * SUBSTRINGS + a, the first a + 1 substrings are probed up to s bits and the others up to
        s - 1: a code beyond all of these differs in more bits than the radius.
        """
        probed = np.zeros(len(self.ids), bool)
        each, more = divmod(radius, SUBSTRINGS)
        for i, ((values, bucket), part) in enumerate(zip(self.buckets, code.view(np.uint16))):
            probed |= (np.bitwise_count(values ^ part) <= (each if i <= more else each - 1))[bucket]
        rows = np.flatnonzero(probed)
        return rows[np.bitwise_count(self.codes[rows] ^ code[0]) <= radius]

    def nearest(self, own: int, vector: np.ndarray, code: np.ndarray, radius: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the `k` nearest rows within the radius, but for those with the id `own`; it grows until there are `k`, or holds all."""
        while True:
            rows = self.within(code, radius)
            rows = rows[self.ids[rows] != own]
            if len(rows) >= k or radius >= BITS:
                break
            radius += SUBSTRINGS
        if len(rows) > k:
            rough = self.unit[rows] @ (vector / _lengths(vector[None])[0])
            rows = rows[rough >= np.partition(rough, len(rows) - k)[len(rows) - k] - 1e-9]
        exact = cosines(self.vectors[rows], vector)
        best = np.lexsort((self.ids[rows], -exact))[:k]
        return self.ids[rows][best], exact[best]


def search(queries: DataFrame, indexed: DataFrame, model: AnnModel, k: int = 5) -> DataFrame:
    """`query_id`, `rank`, `vec_id` and `score` of the `k` nearest found for each row of `queries`, both given as `index` returns them.

    Rows and queries are dealt into blocks, and each block of rows meets each block of queries in one task, which
    returns at most `k` rows per query. An id that occurs in several queries is asked once, with its smallest vector.
    Rows that repeat an id are candidates one by one, but none of them is a candidate for a query of that id.
    """
    asked = queries.groupBy("vec_id").agg(F.min(F.struct("embedding", "code")).alias("q")).select("vec_id", "q.*")
    indexed, asked = cut(indexed, "ann-index"), cut(asked, "ann-queries")
    blocks = lambda n: max(1, math.ceil(n / max(LEAST_BLOCK, BLOCK * math.sqrt(n))))
    rows, groups = blocks(indexed.count()), blocks(asked.count())
    dealt = lambda df, own, n, other, m: df.withColumn(own, F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    left, right = dealt(indexed, "block", rows, "group", groups), dealt(asked, "group", groups, "block", rows)
    width = model.dimensions

    def parts(table):
        return table["vec_id"].to_numpy(), table["embedding"].combine_chunks().flatten().to_numpy().reshape(-1, width), table["code"].to_numpy().view(np.uint64)

    def compare(table, asked):
        out: list[tuple[int, int, float]] = []
        if table.num_rows and asked.num_rows:
            block = Block(*parts(table))
            ids, vectors, codes = parts(asked)
            for at, own in enumerate(ids.tolist()):
                found, scores = block.nearest(own, vectors[at], codes[at : at + 1], model.radius, k)
                out.extend(zip([own] * len(found), found.tolist(), scores.tolist()))
        q, v, s = zip(*out) if out else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    found = left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInArrow(compare, "query_id bigint, vec_id bigint, score double")
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def compared(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """As `search`, by plain comparison of all vectors of a length, for lengths of at most LEAST_BLOCK vectors. `asked` has the ids and lengths of the queries."""

    def compare(table, queries):
        ids, vectors = table["vec_id"].to_numpy(), table["embedding"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        out: list[tuple[int, int, float]] = []
        for own in sorted(set(queries["vec_id"].to_pylist())):
            vector = min(vectors[ids == own].tolist())
            others = np.flatnonzero(ids != own)
            scores = cosines(vectors[others], np.array(vector))
            best = np.lexsort((ids[others], -scores))[:k]
            out.extend(zip([own] * len(best), ids[others][best].tolist(), scores[best].tolist()))
        q, v, s = zip(*out) if out else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    ship(rows.sparkSession)
    sized = rows.withColumn("size", F.size("embedding"))
    found = sized.groupBy("size").cogroup(asked.groupBy("size")).applyInArrow(compare, "query_id bigint, vec_id bigint, score double")
    return _ranked(found, k)


def nearest(rows: DataFrame, every: int = 50, k: int = 5, sample: int = SAMPLE) -> DataFrame:
    """The `k` nearest rows, by cosine, for each row whose id is divisible by `every`; all rows of its length but the query's own are searched.

    Vectors of each length are fitted and searched by themselves, as there is no cosine between two lengths; lengths
    with at most LEAST_BLOCK vectors are compared plainly, all in one job. Null vectors, zero vectors and those with null or non-finite components
    take no part; nor do null ids. An id that occurs in several queries is asked once, with its shortest vector, of these the smallest. Equal cosines: the smaller id
    first. A query with fewer than `k` candidates gets all of them, an empty table gives no row, and other columns do
    not matter.
    """
    rows = rows.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sizes = lengths(rows)
    is_query = F.col("vec_id") % every == 0
    # With several lengths each query id has one of them, its shortest.
    own = cut(rows.where(is_query & usable()).groupBy("vec_id").agg(F.min(F.size("embedding")).alias("size")), "ann-asked") if len(sizes) > 1 else None
    found = []
    for size, count in sizes.items():
        if count > LEAST_BLOCK or own is None:
            model = fit(rows, sample, k, length=(size, count))
            indexed = cut(index(rows, model), "ann-codes")
            asked = indexed.where(is_query)
            found.append(search(asked if own is None else asked.join(own.where(F.col("size") == size), "vec_id", "left_semi"), indexed, model, k))
    few = [size for size, count in sizes.items() if count <= LEAST_BLOCK]
    if few and own is not None:
        some = cut(rows.where(usable() & F.size("embedding").isin(few)), "ann-few")
        found.append(compared(some, own.where(F.col("size").isin(few)), k))
    none = rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return reduce(DataFrame.union, found) if found else none
