"""Sharding by extendible hashing.

A document's place is a hash of 60 bits. The directory starts with one bucket; a bucket that holds more bytes than
allowed is split by the next bit, and only that one. The bytes are summed by 12 more bits at a time, and the
directory for these bits follows from the sums alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut

from .common import unused
from .mixing import HASH_BITS, LEVEL_BITS, hash60

LIMIT = 256 << 20


def directory(sums: DataFrame, depth: int, first: int, limit: int) -> DataFrame:
    """For each cell (`cell`: the first `depth` bits) that lies in a finished bucket its `depth`, `shard_bytes` and `shard_rows`.

    `sums` has `cell`, `bytes`, `rows`, `low` and `high` hash; buckets of fewer than `first` bits are known to be too large. A
    bucket is finished if it holds at most `limit` bytes or a single hash.
    """
    path = sums.withColumn("at", F.explode(F.sequence(F.lit(first), F.lit(depth)))).withColumn("prefix", F.expr(f"shiftright(cell, {depth} - at)"))
    whole = path.groupBy("at", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"), F.min("low").alias("low"), F.max("high").alias("high"))
    ready = whole.where((F.col("shard_bytes") <= limit) | (F.col("low") == F.col("high"))).drop("low", "high")
    return path.select("cell", "at", "prefix").join(ready, ["at", "prefix"]).groupBy("cell").agg(F.min(F.struct(F.col("at").alias("depth"), "shard_bytes", "shard_rows")).alias("s")).select("cell", "s.*")


def assign(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """`rows` (with `hash` and `bytes`) with `shard` (its bits as text), `depth`, `shard_bytes` and `shard_rows`."""
    found, rest, done = [], rows, 0
    while done < HASH_BITS:
        depth = done + LEVEL_BITS
        cell = F.shiftright("hash", HASH_BITS - depth)
        sums = rest.groupBy(cell.alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        entries = cut(directory(sums, depth, done, limit), "shard-directory")
        found.append(rest.join(entries, cell == F.col("cell")).drop("cell"))
        rest = cut(rest.join(entries, cell == F.col("cell"), "left_anti"), "shard-rest")
        done = depth
        if rest.isEmpty():
            break
    bits = F.expr(f"if(depth = 0, '', lpad(bin(shiftright(hash, {HASH_BITS} - depth)), depth, '0'))")
    return reduce(DataFrame.unionByName, found).withColumn("shard", bits)


def shards(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """`doc_id`, `bytes` of the text in UTF-8, `shard`, `depth`, `shard_bytes` and `shard_rows` of every row of `docs`.

    A shard is named by the bits that its documents' hashes start with; the only shard of small input has no bits.
    Null and empty texts have 0 bytes. A document above the limit gets a shard of its own, larger than the limit.
    Rows that repeat an id and a text have one hash and share a shard. An empty table gives no row; other columns do
    not matter.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = cut(docs.select("doc_id", hash60("doc_id", "text").alias("hash"), size.alias("bytes")), "shard-rows")
    return assign(rows, limit).select("doc_id", "bytes", "shard", "depth", "shard_bytes", "shard_rows")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Write `docs` as Parquet with one folder, and one file, for each shard.

    A folder is named `shard=b` and the shard's bits, so that the name is text for every reader and keeps its leading
    zeros; the only shard of small input is `shard=b`. Null and empty texts lie in the shard of their hash like others,
    repeated rows in one; an empty table gives no folder; columns with clashing names stay as they are, but for one
    called `shard`, whose place the shard's name takes.
    """
    hashed, size, shard = unused(docs, "hash"), unused(docs, "bytes"), "shard"
    rows = docs.drop(shard).select("*", hash60("doc_id", "text").alias(hashed), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias(size))
    keys = cut(rows.select(F.col(hashed).alias("hash"), F.col(size).alias("bytes")), "shard-keys")
    of = assign(keys, limit).select(F.col("hash").alias("of"), F.concat(F.lit("b"), "shard").alias(shard)).distinct()
    rows.join(of, F.col(hashed) == F.col("of")).drop("of", hashed, size).repartition(shard).write.partitionBy(shard).parquet(path)
