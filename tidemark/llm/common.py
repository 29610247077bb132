"""What the operators share: Arrow batches in tasks, the held-out fold, bounded samples of labelled rows."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows handled at once in a task, and UTF-8 bytes after which such a part ends early.
PART_ROWS, PART_BYTES = 1024, 8 << 20
#: Longer documents are left out of samples that the driver learns from; like all others they are scored in full.
SAMPLE_BYTES = 64 << 10


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=8)
def _zipped(application: str) -> str | None:
    package = Path(__file__).resolve().parents[1]
    if not package.is_dir():
        return None
    return shutil.make_archive(f"{tempfile.mkdtemp(prefix='tidemark-')}/tidemark", "zip", package.parent, package.name)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as --py-files would; once per application. One that was sent so itself is there already."""
    context = spark.sparkContext
    before = _zipped.cache_info().misses
    path = _zipped(context.applicationId)
    if path and _zipped.cache_info().misses > before:
        context.addPyFile(path)


def raw_texts(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """The column's values as UTF-8 bytes."""
    column = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_null(column.type):
        return [None] * len(column)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if large else pa.binary()).to_pylist()


def parts(batch: pa.RecordBatch, name: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded rows and bytes, so that a task holds few texts at a time."""
    column = batch.column(batch.schema.get_field_index(name))
    sizes = pc.binary_length(column).to_pylist() if not pa.types.is_null(column.type) else [0] * len(column)
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= PART_ROWS or held + (size or 0) > PART_BYTES):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if start < len(sizes):
        yield batch.slice(start)


def append(
    df: DataFrame, added: str, compute: Callable[[list[bytes | None]], list[pa.Array]], text: str = "text", done: Callable[[], object] = lambda: None
) -> DataFrame:
    """`df` with the columns `added` (a DDL list), computed from `text`; an input column of such a name is replaced.

    `done` is called at the end of each task, to give back what `compute` has held.
    """
    extra = T.StructType.fromDDL(added)
    kept = [f for f in df.schema.fields if f.name not in extra.names]
    names = [f.name for f in kept] + extra.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in parts(batch, text):
                    old = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                    yield pa.RecordBatch.from_arrays(old + compute(raw_texts(part, text)), names=names)
        finally:
            done()

    ship(df.sparkSession)
    return df.mapInArrow(run, T.StructType(kept + extra.fields))


def keep(df: DataFrame, accept: Callable[[list[bytes | None]], list[bool]], text: str = "text") -> DataFrame:
    """The rows whose text is accepted, with all their columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, text):
                yield part.filter(pa.array(accept(raw_texts(part, text)), pa.bool_()))

    ship(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def unused(df: DataFrame, name: str) -> str:
    """`name`, or a longer one, that no column of `df` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """Whether a document is kept out of learning: crc32 of its id as text, modulo `folds`, is 0. A null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % folds == 0


def class_shares(rows: DataFrame, label: str, per_class: int, max_classes: int = 1000) -> dict:
    """For each label the share of its rows that gives about `per_class` of them, and their number.

    One row per label reaches the driver, for the `max_classes` labels with most rows; of equal ones the first stay.
    """
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).count().orderBy(F.desc("count"), label).limit(max_classes).collect()
    return {r[0]: (min(1.0, per_class / r[1]), r[1]) for r in sorted(counts, key=lambda r: str(r[0]))}


def in_share(label: Column, shares: dict, *key: Column) -> Column:
    """Whether a row is in its label's share, by a hash of `key`: the same rows in every run and on every cluster."""
    if not shares:
        return F.lit(False)
    draw = F.pmod(F.xxhash64(F.lit(20), *key), F.lit(1 << 30))
    case = F.lit(False)
    for value, (share, _) in shares.items():
        case = F.when(label == F.lit(value), draw < F.lit(round(share * (1 << 30)))).otherwise(case)
    return F.coalesce(case, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[list, dict]:
    """Texts and labels of about `per_class` documents of each label, and the number of labelled ids per label.

    Held-out ids, null ids and null labels are left out, and so are ids whose labels differ. The sample is
    drawn from the labels alone, so its ids are a bounded broadcast; repeated rows count once. At most
    2 * `per_class` * labels texts of SAMPLE_BYTES reach the driver, in the order of a hash of the id.
    """
    key, value = unused(docs, "sample_id"), unused(docs, "sample_label")
    ids = (
        labels.select(F.col("doc_id").alias(key), F.col(label).cast("int").alias(value))
        .where(F.col(key).isNotNull() & F.col(value).isNotNull() & ~held_out(key))
        .groupBy(key)
        .agg(F.min(value).alias(value), F.max(value).alias("high"))
        .where(F.col(value) == F.col("high"))
        .drop("high")
    )
    shares = class_shares(ids, value, per_class, 64)
    drawn = ids.where(in_share(F.col(value), shares, F.col(key)))
    rows = (
        docs.select("doc_id", "text")
        .where(F.octet_length("text") <= SAMPLE_BYTES)
        .join(F.broadcast(drawn), F.col("doc_id") == F.col(key))
        .select("doc_id", "text", value)
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        .limit(2 * per_class * max(1, len(shares)))
    )
    found = [(r[1].encode(), r[2]) for r in rows.collect()] if shares else []
    return found, {k: n for k, (_, n) in shares.items()}
