"""Whitening of embeddings with the covariance found by polarisation.

Entries become integers, so all sums are exact. A first pass sums each dimension. A second one centres every entry
and adds up the squares of each dimension and of each sum of two dimensions; half of what the variance of a sum has
above the two variances is their covariance. That matrix, of the dimensions only, goes to the driver for its
eigenvectors; the rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Integers that an entry becomes lie within this distance of 0; an entry of more than two million million is taken as that bound.
LARGEST = 1 << 47
#: Rows that a task centres and squares at a time.
ROWS = 4096
LOW_BITS = 32


@dataclass(frozen=True)
class Model:
    """What whitens vectors of one length: `n` rows, sums `S` of the integers, components (one a row), eigenvalues, `explained` shares."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean of each dimension as a whole number and the numerator (below `n`) of the rest."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, np.int64), np.array([s - w * self.n for s, w in zip(self.sums, whole)], np.int64)


def integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the usable vectors of each length in the column, and their entries as integers, one row each.

    Null vectors and those that hold a null or a non-finite entry are left out, and so are vectors without an entry.
    """
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    spoiled = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    usable = (sizes > 0) & (spoiled[ends] == spoiled[ends - sizes])
    for size in np.unique(sizes[usable]):
        for at in np.array_split(np.flatnonzero(usable & (sizes == size)), max(1, -(-int((sizes == size).sum()) // ROWS))):
            if len(at):
                picked = values[(ends[at] - size)[:, None] + np.arange(size)]
                yield at, np.clip(np.floor(SCALE * picked) + SHIFT, -LARGEST, LARGEST).astype(np.int64)


def _totals(df: DataFrame, vector: str, add: Callable[[dict, np.ndarray], None], names: list[str]) -> list:
    """Sums over all rows of what `add` gathers in a dict of exact integers by (length, dimension, dimension); one row a key.

    A task holds its integers in two parts, so that none overflows, and sends one row for each key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for _, x in integers(batch.column(0)):
                add(held, x)
        for size, table in held.items():
            d = table["low"].shape
            at = np.indices(d).reshape(len(d), -1)
            yield pa.record_batch(
                [np.full(at.shape[1], size, np.int32), at[0].astype(np.int32), at[-1].astype(np.int32), table["low"].ravel(), table["high"].ravel(), np.full(at.shape[1], table["rows"])], names=names
            ).filter(pa.array(at[0] <= at[-1]))

    ship(df.sparkSession)
    parts = df.select(vector).mapInArrow(run, "size int, i int, j int, low bigint, high bigint, `rows` bigint")
    return parts.groupBy("size", "i", "j").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high", "rows")]).collect()


NAMES = ["size", "i", "j", "low", "high", "rows"]


def _put(held: dict, size: int, rows: int, totals: np.ndarray, where: object = ...) -> None:
    """Add exact `totals` (64-bit or Python integers) to the two parts held for vectors of this size."""
    table = held[size]
    table["low"][where] += (totals & ((1 << LOW_BITS) - 1)).astype(np.int64)
    table["high"][where] += (totals >> LOW_BITS).astype(np.int64)
    table["rows"] += rows


def _new(shape: tuple[int, ...]) -> dict:
    return {"low": np.zeros(shape, np.int64), "high": np.zeros(shape, np.int64), "rows": 0}


def _whole(row) -> int:
    return (int(row["high"]) << LOW_BITS) + int(row["low"])


def dimension_sums(df: DataFrame, vector: str = "embedding") -> dict[int, tuple[int, list[int]]]:
    """For each length of vectors the number of rows and the sum of each dimension's integers."""

    def add(held, x):
        held.setdefault(x.shape[1], _new((x.shape[1],)))
        _put(held, x.shape[1], len(x), x.sum(0))

    found: dict[int, tuple[int, list[int]]] = {}
    for row in sorted(_totals(df, vector, add, NAMES), key=lambda r: (r["size"], r["i"])):
        found.setdefault(row["size"], (int(row["rows"]), []))[1].append(_whole(row))
    return found


def squares(y: np.ndarray, i: int) -> np.ndarray:
    """Sums of squares over the rows of `y`, exact: of dimension `i`, then of its sum with each later one."""
    both = y[:, i:] + y[:, i : i + 1]
    both[:, 0] = y[:, i]
    most = int(np.abs(both).max(initial=0))
    if most * most * len(y) < 1 << 62:
        return np.einsum("rd,rd->d", both, both)
    return (both.astype(object) ** 2).sum(0)


def square_sums(df: DataFrame, sums: dict[int, tuple[int, list[int]]], vector: str = "embedding") -> dict[int, dict[tuple[int, int], int]]:
    """For each length the exact sums of squares of the centred dimensions (`i`, `i`) and of the centred sums of two (`i`, `j`), each times n squared.

    A task takes the whole part of the mean off every entry; the sum of what that leaves is known, so the rest of the
    mean is taken off the totals, without a rounding.
    """
    whole = {size: np.array([s // n for s in total], np.int64) for size, (n, total) in sums.items()}

    def add(held, x):
        d = x.shape[1]
        table = held.setdefault(d, _new((d, d)))
        y = x - whole[d]
        for i in range(d):
            _put(held, d, 0, squares(y, i), (i, slice(i, None)))
        table["rows"] += len(x)

    found: dict[int, dict[tuple[int, int], int]] = {size: {} for size in sums}
    for row in _totals(df, vector, add, NAMES):
        n, total = sums[row["size"]]
        i, j = row["i"], row["j"]
        rest = total[i] % n + (total[j] % n if j != i else 0)
        found[row["size"]][i, j] = n * n * _whole(row) - n * rest * rest
    return found


def covariance(n: int, squared: dict[tuple[int, int], int], d: int) -> np.ndarray:
    """The covariances with divisor `n`, each the nearest double to its exact value."""
    out = np.empty((d, d))
    for (i, j), both in squared.items():
        # Var(i + j) = Var(i) + Var(j) + 2 Cov(i, j)
        doubled = 2 * both if i == j else both - squared[i, i] - squared[j, j]
        out[i, j] = out[j, i] = doubled / (2 * n**3)
    return out


def fit(df: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> dict[int, Model]:
    """A model for each length of vectors in `df`, with up to `most` components by falling eigenvalue.

    The driver holds one number for each pair of dimensions, whatever the number of rows.
    """
    sums = dimension_sums(df, vector)
    models = {}
    for size, squared in (square_sums(df, sums, vector) if sums else {}).items():
        n, total = sums[size]
        v = covariance(n, squared, size)
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:most]
        trace = float(np.trace(v))
        models[size] = Model(n, tuple(total), vectors.T[order].copy(), values[order], values[order] / trace if trace > 0 else np.full(len(order), np.nan))
    return models


def spread(model: Model) -> np.ndarray:
    """For each component whether its eigenvalue is more than rounding of the largest one; only then can it be whitened."""
    top = float(model.values[0]) if len(model.values) else 0.0
    return model.values > max(top, 0.0) * len(model.sums) * np.finfo(float).eps


def project(model: Model, x: np.ndarray) -> np.ndarray:
    """Whitened components of the rows of `x`; NaN for a component without spread."""
    whole, rest = model.centre
    centred = (x - whole) - rest / model.n
    scale = np.full(len(model.values), np.nan)
    scale[spread(model)] = 1 / np.sqrt(model.values[spread(model)])
    return centred @ (model.components.T * scale)


def deviations(model: Model, x: np.ndarray) -> list[int]:
    """For each row the exact sum over dimensions of (n * x - S) squared."""
    whole, rest = model.centre
    y = x - whole
    most = int(np.abs(y).max(initial=0)) + 1
    if (most * model.n) ** 2 * x.shape[1] < 1 << 62:
        z = y * model.n - rest
        return np.einsum("rd,rd->r", z, z).tolist()
    z = y.astype(object) * model.n - rest.astype(object)
    return (z * z).sum(1).tolist()


def identity_errors(df: DataFrame, models: dict[int, Model], vector: str = "embedding") -> dict[int, float]:
    """For each length the largest absolute entry of the whitened rows' covariance minus the identity, from the rows themselves.

    The projection takes the mean off before; its products are added up by task, one row a task and length.
    """

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in integers(batch.column(0)):
                size = x.shape[1]
                w = project(models[size], x)[:, spread(models[size])]
                product = np.vstack([w.T @ w, w.sum(0)])
                held[size] = held[size] + product if size in held else product
        if held:
            yield pa.record_batch({"size": pa.array(held, pa.int32()), "products": pa.array([p.ravel().tolist() for p in held.values()], pa.list_(pa.float64()))})

    ship(df.sparkSession)
    each = df.select(vector).mapInArrow(run, "size int, products array<double>").select("size", F.posexplode("products").alias("place", "value"))
    totals: dict[int, dict[int, float]] = {}
    for row in each.groupBy("size", "place").agg(F.sum("value").alias("value")).collect():
        totals.setdefault(row["size"], {})[row["place"]] = row["value"]
    errors = {}
    for size, places in totals.items():
        m = int(spread(models[size]).sum())
        table = np.array([places[p] for p in sorted(places)]).reshape(m + 1, m) / models[size].n
        errors[size] = float(np.abs(table[:m] - np.outer(table[m], table[m]) - np.eye(m)).max(initial=0.0))
    return errors


def whiten(df: DataFrame, models: dict[int, Model], vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """`key`, `size` (length of the vector), exact `deviation` as decimal and `whitened`, an array with an entry for each component."""
    id_type = df.schema[key].dataType

    def run(batches):
        for batch in batches:
            for at, x in integers(batch.column(1)):
                model = models[x.shape[1]]
                w = project(model, x)
                values = pa.array(w.ravel(), mask=np.isnan(w.ravel()))
                offsets = np.arange(0, w.size + 1, max(1, w.shape[1]), dtype=np.int32)
                deviation = pa.array([Decimal(v) for v in deviations(model, x)], pa.decimal128(38, 0))
                size = pa.array(np.full(len(at), x.shape[1], np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), size, deviation, pa.ListArray.from_arrays(offsets, values)], names=[key, "size", "deviation", "whitened"])

    ship(df.sparkSession)
    return df.select(key, vector).mapInArrow(run, f"`{key}` {id_type.simpleString()}, size int, deviation decimal(38,0), whitened array<double>")


def whitening(df: DataFrame, vector: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """`key`, `size`, `component`, `n`, `deviation`, `whitened`, `explained` and `identity_error`, one row for each usable vector and component up to `most`.

    Vectors that are null or hold a null or non-finite entry are left out. Vectors of each length are fitted by
    themselves, with their own `n` and `identity_error`; a vector without an entry has no component. A component
    whose eigenvalue is no more than rounding (of a constant dimension, or with fewer rows than dimensions) is
    returned with null `whitened`; where all rows are equal `explained` is null too. Components of equal eigenvalue
    come in any order. Repeated rows and null keys are rows like others. An empty table gives no row; other columns do
    not matter. An entry beyond `LARGEST` counts as that bound.
    """
    models = fit(df, vector, most)
    if not models:
        # Nothing to whiten: the same columns without a row.
        errors: dict[int, float] = {}
    else:
        errors = identity_errors(df, models, vector)
    rows = whiten(df, models, vector, key)

    def of_length(value: Callable[[int], object], kind: str):
        cases = F.lit(None)
        for size in models:
            cases = F.when(F.col("size") == size, F.lit(value(size))).otherwise(cases)
        return cases.cast(kind)

    shares = of_length(lambda s: [None if np.isnan(e) else float(e) for e in models[s].explained], "array<double>")
    each = rows.select(key, "size", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        key, "size", (F.col("place") + 1).alias("component"), of_length(lambda s: models[s].n, "bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"), of_length(lambda s: errors.get(s, 0.0), "double").alias("identity_error"),
    )
