"""Data tests that follow a table change by change.

Counts of keys are kept in logs of key buckets. A change brings rows removed and added; only the keys whose count it
moves are looked up, in their buckets, and their verdicts stored. The report is what the newest verdicts say, and
equals that of a scan of the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import first_per_key
from ..session import cut
from .jobs import among
from .log import BucketLog


def key_counts(path: str, keys: T.StructType, buckets: int) -> BucketLog:
    """A log of changes to the number of rows of each key; its state is the sums, without keys of no row."""
    schema = T.StructType([*keys.fields, T.StructField("n", T.LongType())])

    def total(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys.names).agg(F.sum("n").alias("n")).filter("n <> 0")

    return BucketLog(path, schema, tuple(keys.names), total, buckets)


def verdicts(path: str, keys: T.StructType, value: str, buckets: int) -> BucketLog:
    """A log of verdicts by key, of which the one of the last batch counts."""
    schema = T.StructType([*keys.fields, T.StructField(value, T.LongType()), T.StructField("batch", T.LongType())])
    return BucketLog(path, schema, tuple(keys.names), lambda df: first_per_key(df, keys.names, [F.col("batch").desc()]), buckets)


def moved(removed: DataFrame, added: DataFrame, keys: list[str]) -> DataFrame:
    """By how much a change moves the number of rows of each key; keys with a NULL are left out, and so is what does not move."""
    signed = [df.select(*keys, F.lit(sign).cast("bigint").alias("n")) for df, sign in ((removed, -1), (added, 1))]
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return signed[0].unionByName(signed[1]).filter(whole).groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0")


def counts_of(log: BucketLog, keys: DataFrame, batch_id: int) -> DataFrame:
    """The counts of some keys as of a batch, read from their buckets; keys of no row have none."""
    spark = keys.sparkSession
    return log.reduce(among(log.read(spark, batch_id + 1, log.buckets_of(keys)), keys))


@dataclass(frozen=True)
class UniqueTest:
    """Keys that occur more than once, followed. `keys` has the key columns with their types."""

    path: str
    keys: T.StructType
    buckets: int = 32

    def apply(self, removed: DataFrame, added: DataFrame, batch_id: int) -> None:
        """Take over one change of the table; a repeated batch changes nothing."""
        names, spark = self.keys.names, added.sparkSession
        counts = key_counts(f"{self.path}/counts", self.keys, self.buckets)
        counts.write(moved(removed, added, names), batch_id)
        touched = cut(counts.read_batch(spark, batch_id).select(*names), "moved-keys")
        now = touched.join(counts_of(counts, touched, batch_id), names, "left")
        told = now.select(*names, F.coalesce("n", F.lit(0)).cast("bigint").alias("occurrences"), F.lit(batch_id).cast("bigint").alias("batch"))
        self._verdicts.write(told, batch_id)

    def report(self, spark: SparkSession) -> DataFrame:
        """As `duplicate_keys` of the whole table."""
        log = self._verdicts
        return log.reduce(log.read(spark)).filter("occurrences > 1").select(*self.keys.names, "occurrences")

    @property
    def _verdicts(self) -> BucketLog:
        return verdicts(f"{self.path}/verdicts", self.keys, "occurrences", self.buckets)


@dataclass(frozen=True)
class RelationshipTest:
    """Values of a foreign key that the parent lacks, followed. `kind` is the type of the values.

    Looked up are values whose number of rows a change moves, in the child or in the parent.
    """

    path: str
    kind: T.DataType
    buckets: int = 32

    def apply(self, child: tuple[DataFrame, DataFrame], parent: tuple[DataFrame, DataFrame], column: str, parent_column: str, batch_id: int) -> None:
        """Take over one change of either table, each as rows removed and rows added; a repeated batch changes nothing."""
        spark, logs = child[1].sparkSession, []
        for name, (removed, added), own in (("child", child, column), ("parent", parent, parent_column)):
            log = key_counts(f"{self.path}/{name}", self._keys, self.buckets)
            values = [df.select(F.col(own).cast(self.kind).alias("value")) for df in (removed, added)]
            log.write(moved(*values, ["value"]), batch_id)
            logs.append(log)
        touched = logs[0].read_batch(spark, batch_id).select("value").unionByName(logs[1].read_batch(spark, batch_id).select("value"))
        touched = cut(touched.distinct(), "moved-values")
        rows, parents = (counts_of(log, touched, batch_id).withColumnRenamed("n", name) for log, name in zip(logs, ("rows", "parents")))
        now = touched.join(rows, "value", "left").join(parents, "value", "left")
        orphans = F.when(F.col("parents").isNull(), F.coalesce("rows", F.lit(0))).otherwise(0).cast("bigint")
        self._verdicts.write(now.select("value", orphans.alias("child_rows"), F.lit(batch_id).cast("bigint").alias("batch")), batch_id)

    def report(self, spark: SparkSession) -> DataFrame:
        """As `orphan_counts` of the whole tables."""
        log = self._verdicts
        return log.reduce(log.read(spark)).filter("child_rows > 0").select("value", "child_rows")

    @property
    def _keys(self) -> T.StructType:
        return T.StructType([T.StructField("value", self.kind)])

    @property
    def _verdicts(self) -> BucketLog:
        return verdicts(f"{self.path}/verdicts", self._keys, "child_rows", self.buckets)
