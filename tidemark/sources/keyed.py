"""Tables that know their keys: inserts that look only where they must, and snapshots that are compared only where they differ."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import first_per_key
from ..operators.drift import snapshot_diff
from ..session import cut
from .tables import FOLD, Conflict, Record, Transaction, Warehouse, claim, folders, put_once, read_file

WORDS, BITS_PER_KEY = 8, 16


def bloom_bits(keys: list[Column], blocks: int) -> dict[str, Column]:
    """Where a key lies in a filter of so many blocks: its `block` and one bit in each of the block's WORDS words of 64 bits."""
    place = F.xxhash64(F.lit(1), *keys)
    return {"block": F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(blocks)), **{f"w{i}": _bit(place, i) for i in range(WORDS)}}


def _bit(place: Column, word: int) -> Column:
    number = F.shiftrightunsigned(place, 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), number)


def bloom_filter(rows: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """A Bloom filter as rows, one for each block that a key lies in: tasks combine the bits of their keys before they are dealt by
    block. NULL keys match nothing and are left out."""
    whole = rows.filter(_whole(keys))
    bits = whole.select(*[c.alias(n) for n, c in bloom_bits([F.col(k) for k in keys], blocks).items()])
    return merged(bits)


def merged(filters: DataFrame) -> DataFrame:
    """One filter from several: what any of them holds, the result may hold."""
    return filters.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def may_hold(rows: DataFrame, keys: list[str], filters: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key the filter does not rule out. Only the blocks of these keys are taken from the filter."""
    own = {f"_{n}": c for n, c in bloom_bits([F.col(k) for k in keys], blocks).items()}
    asked = rows.filter(_whole(keys)).withColumns(own)
    wanted = asked.select(F.col("_block").alias("block")).distinct()
    held = merged(filters.join(wanted, "block", "left_semi"))
    all_set = reduce(Column.__and__, [F.col(f"w{i}").bitwiseAND(F.col(f"_w{i}")) == F.col(f"_w{i}") for i in range(WORDS)])
    return asked.join(held, F.col("_block") == F.col("block")).filter(all_set).select(*rows.columns)


def _whole(keys: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


@dataclass(frozen=True)
class Inserted:
    """What an insert did: rows `given` and `added`; rows that the filter did not rule out (`asked`), and of those the keys that the table held."""

    given: int
    added: int
    asked: int
    held: int


@dataclass(frozen=True)
class KeyedTable:
    """A table of parts with a Bloom filter of its keys, kept by the commit records.

    An insert adds a part and the filter of its keys. Keys that the filter rules out are added without a look at the
    table; for the others the table gives its keys, exactly. So a batch of new keys reads the filter's blocks for these
    keys and nothing else. The filter is laid out for `expected` keys, with BITS_PER_KEY bits for each; with many more
    the share of false hits grows, not the result, and `rebuild` lays it out anew.
    """

    warehouse: Warehouse | Transaction
    name: str
    keys: tuple[str, ...]
    expected: int = 1 << 20

    def read(self, spark: SparkSession) -> DataFrame:
        return self._parts(spark, self.name, self.warehouse.record(spark))

    def insert_if_absent(self, spark: SparkSession, incoming: DataFrame) -> Inserted:
        """Add the rows whose key the table does not hold; a NULL key never matches. Begins anew if another writer was faster."""
        return self.warehouse.attempt(spark, lambda tx: self._insert(spark, tx, incoming))

    def insert_ignore(self, spark: SparkSession, batch: DataFrame, order: list[Column]) -> Inserted:
        """As above, and a key repeated inside the batch keeps its first row in `order`."""
        return self.insert_if_absent(spark, first_per_key(batch, self.keys, order))

    def rebuild(self, spark: SparkSession, expected: int) -> None:
        """Lay the filter out for so many keys, from the keys of all rows."""

        def step(tx: Transaction) -> None:
            blocks = _blocks(expected)
            rows = self._parts(spark, self.name, tx.record(spark)).select(*self.keys)
            log = self._filter_name(blocks)
            number = self._write(spark, tx, log, bloom_filter(rows, list(self.keys), blocks))
            if tx.base.logs.get(log):
                tx.folded[log] = (tx.base.logs[log], number)
            else:
                tx.added[log] = [number]
            tx.checks.append(self._unchanged(tx.base))

        self.warehouse.attempt(spark, step)

    def _insert(self, spark: SparkSession, tx: Transaction, incoming: DataFrame) -> Inserted:
        record, keys = tx.record(spark), list(self.keys)
        blocks = self._laid_out(record)
        given = cut(incoming, "keyed-incoming")
        asked = held = 0
        fresh = given
        if record.logs.get(self.name):
            filters = self._parts(spark, self._filter_name(blocks), record)
            likely = cut(may_hold(given.select(*keys), keys, filters, blocks), "keyed-likely")
            asked = likely.count()
            if asked:
                there = self._parts(spark, self.name, record).select(*keys).join(likely.distinct(), keys, "left_semi").distinct()
                there = cut(there, "keyed-held")
                held = there.count()
                fresh = given.join(there, keys, "left_anti").select(*given.columns)
        number = self._store(spark, tx, self.name, fresh)
        part = spark.read.parquet(f"{tx.path(self.name)}/batch={number}")
        self._store(spark, tx, self._filter_name(blocks), bloom_filter(part, keys, blocks))
        parts = record.logs.get(self._filter_name(blocks), [])
        if len(parts) >= FOLD:
            one = self._write(spark, tx, self._filter_name(blocks), merged(self._parts(spark, self._filter_name(blocks), record)))
            tx.folded[self._filter_name(blocks)] = (parts, one)
        tx.checks.append(self._unchanged(tx.base))
        return Inserted(given.count(), part.count(), asked, held)

    def _unchanged(self, base: Record):
        def check(spark: SparkSession, newest: Record) -> None:
            if newest.logs.get(self.name) != base.logs.get(self.name):
                raise Conflict(f"{self.name} has new rows")

        return check

    def _filter_name(self, blocks: int) -> str:
        return f"{self.name}__keys_{blocks}"

    def _laid_out(self, record: Record) -> int:
        """The blocks of the filter in force: the largest one."""
        prefix = f"{self.name}__keys_"
        return max((int(n[len(prefix):]) for n in record.logs if n.startswith(prefix)), default=_blocks(self.expected))

    def _store(self, spark: SparkSession, tx: Transaction, log: str, df: DataFrame) -> int:
        number = self._write(spark, tx, log, df)
        tx.added.setdefault(log, []).append(number)
        return number

    def _write(self, spark: SparkSession, tx: Transaction, log: str, df: DataFrame) -> int:
        number = claim(spark, tx.path(log), "batch")
        df.write.mode("overwrite").parquet(f"{tx.path(log)}/batch={number}")
        return number

    def _parts(self, spark: SparkSession, log: str, record: Record) -> DataFrame:
        numbers = record.logs.get(log, [])
        if not numbers:
            raise FileNotFoundError(f"no part of {log}")
        return spark.read.parquet(*[f"{self.warehouse.path(log)}/batch={n}" for n in numbers])


def _blocks(expected: int) -> int:
    return max(1, -(-expected * BITS_PER_KEY // (64 * WORDS)))


@dataclass(frozen=True)
class Snapshots:
    """Versions of a table by key, each stored in buckets of its keys with a tree of hashes over them.

    A leaf is the number of rows of a bucket and two sums of hashes of its rows, whatever their order; a node has the
    sums of its `fan` children. Two versions are compared from the root down, only below nodes that differ, and only rows
    of buckets that differ are read and joined. Rows whose hashes agree twice, 128 bits, count as equal.
    """

    warehouse: Warehouse
    name: str
    keys: tuple[str, ...]
    buckets: int = 1024
    fan: int = 16

    def write(self, spark: SparkSession, df: DataFrame) -> int:
        """Store a version with its tree; returns its number."""
        number = claim(spark, self.warehouse.path(self.name), "v")
        path = f"{self.warehouse.path(self.name)}/v={number:08d}"
        put_once(spark, f"{path}/_schema", df.schema.json())
        bucket = F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")
        df.withColumn("_bucket", bucket).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/rows")
        stored = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(f"{path}/rows")
        hashed = [F.xxhash64(F.lit(seed), *[x for c in sorted(df.columns) for x in (F.col(c).isNull(), F.col(c))]).cast("decimal(38,0)") for seed in (0, 1)]
        leaves = stored.select("_bucket", *[h.alias(f"h{i}") for i, h in enumerate(hashed)]).groupBy(F.col("_bucket").alias("node"))
        level = leaves.agg(F.count("*").alias("rows"), F.sum("h0").alias("h0"), F.sum("h1").alias("h1")).withColumn("level", F.lit(0))
        shown = ["level", "node", "rows", "h0", "h1"]
        level, levels, width, depth = cut(level.select(*shown), "tree-leaves"), [], self.buckets, 0
        while True:
            levels.append(level)
            if width == 1:
                break
            depth, width = depth + 1, -(-width // self.fan)
            above = level.groupBy(F.floor(F.col("node") / self.fan).cast("int").alias("node"))
            level = above.agg(*[F.sum(c).cast(level.schema[c].dataType).alias(c) for c in ("rows", "h0", "h1")]).withColumn("level", F.lit(depth)).select(*shown)
        reduce(DataFrame.unionByName, levels).coalesce(1).write.mode("overwrite").parquet(f"{path}/tree")

        def put(tx: Transaction) -> None:
            tx.added[self.name] = [number]

        self.warehouse.attempt(spark, put)
        return number

    def versions(self, spark: SparkSession) -> list[int]:
        """The stored versions, oldest first."""
        return list(self.warehouse.record(spark).logs.get(self.name, []))

    def read(self, spark: SparkSession, version: int, buckets: list[int] | None = None) -> DataFrame:
        """A version, or what lies in some of its buckets."""
        path = f"{self.warehouse.path(self.name)}/v={version:08d}"
        schema = T.StructType.fromJson(json.loads(read_file(spark, f"{path}/_schema")))
        there = folders(spark, f"{path}/rows", "_bucket")
        paths = list(there.values()) if buckets is None else [there[b] for b in buckets if b in there]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def differing(self, spark: SparkSession, old: int, new: int) -> list[int]:
        """The buckets in which two versions differ, at most all of them, found from the root down."""
        trees = [spark.read.parquet(f"{self.warehouse.path(self.name)}/v={v:08d}/tree") for v in (old, new)]
        level = trees[0].unionByName(trees[1]).agg(F.max("level")).first()[0]
        nodes = [0]
        while level is not None and nodes:
            here, below = [t.filter((F.col("level") == level) & F.col("node").isin(nodes)).drop("level") for t in trees]
            same = here.intersect(below).select("node")
            found = here.unionByName(below).select("node").distinct().join(same, "node", "left_anti")
            nodes = sorted(r["node"] for r in found.collect())
            if level == 0:
                return nodes
            nodes = [c for n in nodes for c in range(n * self.fan, (n + 1) * self.fan)]
            level -= 1
        return []

    def diff(self, spark: SparkSession, old: int, new: int, compare: list[str]) -> DataFrame:
        """Rows added, removed or changed between two versions, as `snapshot_diff` gives them for the whole tables."""
        buckets = self.differing(spark, old, new)
        return snapshot_diff(self.read(spark, old, buckets), self.read(spark, new, buckets), list(self.keys), compare)
