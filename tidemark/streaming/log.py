"""What streaming queries write, batch by batch, and others read.

In a `BatchLog` each micro-batch owns the folder batch=N and overwrites it when it is run again, so a repeated batch
changes nothing. `base=N` folders hold everything up to batch N in compacted form.

A `BucketLog` also deals its rows by a hash of their key. A batch is a run of such buckets; a bucket whose latest runs
have grown to the size of the one before is folded, so that a row is rewritten a number of times that grows with the
logarithm of the state, a bucket has few runs at any time, and who knows the keys reads their buckets only.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import claim, delete, finished, folders, numbered, path_exists, put_once, read_file


@dataclass(frozen=True)
class BatchLog:
    path: str
    schema: T.StructType

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """Rows of all finished batches (of those before one, if given)."""
        paths = self._paths(spark, before)
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def read_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Rows of one batch."""
        return spark.read.schema(self.schema).parquet(f"{self.path}/batch={batch_id}")

    def compact(self, spark: SparkSession, reduce: Callable[[DataFrame], DataFrame]) -> None:
        """Fold all finished batches into one base folder, then drop the folders it holds. Without a new batch
        nothing happens, and a base that was broken off is written anew. No reader may be at work on the old folders."""
        batches = finished(spark, folders(spark, self.path, "batch"))
        bases = finished(spark, folders(spark, self.path, "base"))
        newest = max(batches, default=-1)
        if newest > max(bases, default=-1):
            reduce(self.read(spark)).write.mode("overwrite").parquet(f"{self.path}/base={newest}")
            bases[newest] = f"{self.path}/base={newest}"
        held = max(bases, default=-1)
        for old in [p for n, p in batches.items() if n <= held] + [p for n, p in bases.items() if n < held]:
            delete(spark, old)

    def _paths(self, spark: SparkSession, before: int | None) -> list[str]:
        batches = finished(spark, folders(spark, self.path, "batch"))
        bases = finished(spark, folders(spark, self.path, "base"))
        usable = [n for n in bases if before is None or n < before]
        base = max(usable, default=None)
        paths = [] if base is None else [bases[base]]
        wanted = [n for n in batches if (base is None or n > base) and (before is None or n < before)]
        return paths + [batches[n] for n in sorted(wanted)]


def folds(sizes: list[int]) -> int:
    """How many of a bucket's latest runs are to become one, given the rows of all its runs, oldest first; 0 if none.

    Runs are folded while the one before is not twice as large as what has been folded so far. So each run is more than
    twice as large as the next, and a row that is rewritten lies in a run of at least one and a half times the size.
    """
    taken, rows = 1, sizes[-1]
    while taken < len(sizes) and sizes[-taken - 1] <= 2 * rows:
        taken, rows = taken + 1, rows + sizes[-taken - 1]
    return taken if taken > 1 else 0


@dataclass(frozen=True)
class BucketLog:
    """Rows by key in runs of buckets. `reduce` makes one state of several: the newest rows of each key, or its sums.

    After each batch a manifest names the runs of every bucket. It is put in place once: a repeated batch that has one
    changes nothing, one that has none is stored anew. Old runs stay for those who read as of an earlier batch, until
    `clean`.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    reduce: Callable[[DataFrame], DataFrame]
    buckets: int = 32

    def bucket(self, *keys: Column) -> Column:
        return F.pmod(F.xxhash64(*(keys or [F.col(k) for k in self.keys])), F.lit(self.buckets)).cast("int")

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets in which rows of these keys lie, at most all of them."""
        return sorted(r[0] for r in keys.select(self.bucket(*[F.col(k) for k in self.keys]).alias("b")).distinct().collect())

    def write(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if path_exists(spark, self._manifest(batch_id)):
            return
        state = self._state(spark, batch_id)
        own, rows = self._run(df)
        lists = {b: [*state["buckets"].get(b, []), [own, n]] for b, n in rows.items()}
        due = {b: folds([n for _, n in runs]) for b, runs in lists.items()}
        due = {b: n for b, n in due.items() if n}
        rewritten = 0
        if due:
            parts = [f"{self.path}/run={run}/bucket={b}" for b, n in due.items() for run, _ in lists[b][-n:]]
            one, left = self._run(self.reduce(self._rows(spark, parts)))
            rewritten = sum(left.values())
            for b, n in due.items():
                lists[b] = lists[b][:-n] + ([[one, left[b]]] if b in left else [])
        manifest = {"run": own, "rewritten": rewritten, "buckets": {**state["buckets"], **lists}}
        put_once(spark, self._manifest(batch_id), json.dumps(manifest))

    def read(self, spark: SparkSession, before: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of all batches (of those before one, if given), in some buckets or all. `reduce` gives their state."""
        held = self._state(spark, before)["buckets"]
        wanted = held if buckets is None else [str(b) for b in buckets if str(b) in held]
        return self._rows(spark, [f"{self.path}/run={run}/bucket={b}" for b in wanted for run, _ in held[b]])

    def read_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Rows of one batch."""
        own = json.loads(read_file(spark, self._manifest(batch_id)))["run"]
        return self._rows(spark, [f"{self.path}/run={own}"])

    def runs(self, spark: SparkSession, before: int | None = None) -> dict[int, list[int]]:
        """The rows of each run, by bucket, oldest first."""
        return {int(b): [n for _, n in runs] for b, runs in self._state(spark, before)["buckets"].items()}

    def rewritten(self, spark: SparkSession, batch_id: int) -> int:
        """Rows that a batch has folded, besides its own."""
        return json.loads(read_file(spark, self._manifest(batch_id)))["rewritten"]

    def clean(self, spark: SparkSession) -> int:
        """Delete the runs that the newest manifest does not name; returns their number. No reader may be at work on them."""
        named = {run for runs in self._state(spark, None)["buckets"].values() for run, _ in runs}
        old = [p for n, p in folders(spark, self.path, "run").items() if n not in named]
        for p in old:
            delete(spark, p)
        return len(old)

    def _manifest(self, batch_id: int) -> str:
        return f"{self.path}/manifests/{batch_id:012d}"

    def _state(self, spark: SparkSession, before: int | None) -> dict:
        batches = [b for b in numbered(spark, f"{self.path}/manifests") if before is None or b < before]
        return json.loads(read_file(spark, self._manifest(max(batches)))) if batches else {"buckets": {}}

    def _run(self, df: DataFrame) -> tuple[int, dict[str, int]]:
        """Write a run; returns its number and the rows of each bucket. Large buckets are shared by several tasks."""
        spark = df.sparkSession
        number = claim(spark, self.path, "run")
        target = f"{self.path}/run={number}"
        df.select(*self.schema.names).withColumn("bucket", self.bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
        if not folders(spark, target, "bucket"):
            return number, {}
        written = spark.read.schema(T.StructType([T.StructField("bucket", T.IntegerType())])).parquet(target)
        return number, {str(r["bucket"]): r["count"] for r in written.groupBy("bucket").count().collect()}

    def _rows(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        there = [p for p in paths if "/bucket=" in p or folders(spark, p, "bucket")]
        if not there:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*there).select(*self.schema.names)
