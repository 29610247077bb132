"""Streaming forms of current state, drift check and refresh."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..constants import LIVE_STATES
from ..operators.cdc import CdcSpec, current_state, newest
from ..operators.drift import CHANGE, TABLE, detect
from ..operators.events import new_events
from ..plans.models import AggregateModel, Model, RowModel
from ..plans.run import downstream_of, materialize
from ..session import cut
from ..sources.tables import KeyedLog, Transaction, Warehouse, finished, folders
from .log import BatchLog, BucketLog

#: A table, or what gives it as of a transaction.
Source = DataFrame | Callable[[Transaction], DataFrame]


def state_log(changes: DataFrame, path: str) -> BatchLog:
    return BatchLog(path, changes.schema)


def bucket_log(changes: DataFrame, path: str, spec: CdcSpec, buckets: int = 32) -> BucketLog:
    """A log of the newest versions, dealt by key and folded as it grows."""
    return BucketLog(path, changes.schema, tuple(spec.keys), partial(newest, spec=spec), buckets)


def stream_current_state(changes: DataFrame, spec: CdcSpec, log: BatchLog | BucketLog, checkpoint: str,
                         after_batch: Callable[[SparkSession, int], None] | None = None,
                         trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Follow a change log. Each micro-batch stores its newest version per key; the newest of those is the
    newest overall, so the cost of a batch does not grow with the state and late rows lose by version."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        log.write(newest(batch, spec), batch_id)
        if after_batch is not None:
            after_batch(batch.sparkSession, batch_id)

    return (
        changes.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stored_state(spark: SparkSession, log: BatchLog | BucketLog, spec: CdcSpec) -> DataFrame:
    """Current state from the stored batches."""
    return current_state(log.read(spark), spec)


def compact_state(spark: SparkSession, log: BatchLog, spec: CdcSpec) -> None:
    """Keep one row per key for all batches so far (tombstones too, where they decide)."""
    log.compact(spark, lambda df: newest(df, spec))


def refresh_downstream(models: Mapping[str, Model], source: str, log: BatchLog, others: Mapping[str, DataFrame],
                       out: Warehouse) -> Callable[[SparkSession, int], None]:
    """Step for `after_batch`: rebuild only the models below `source`."""

    def refresh(spark: SparkSession, batch_id: int) -> None:
        sources = {**others, source: log.read(spark)}
        materialize(spark, models, sources, out, only=downstream_of(models, [source]))

    return refresh


@dataclass(frozen=True)
class GroupLog:
    """An aggregate that follows a change log by counting.

    The fact is held added up by group, join column and distinct-counted column: row counts, counts and sums, which
    are the reference counts of the distinct values too. A batch takes off the rows its keys had and adds those they
    have now. It reads the change log in the buckets of its keys, the sums in the buckets of the groups it touched,
    and nothing else; the groups it touched are finished again and stored.

    Sums of floating point columns are held with 12 decimals, exactly, so that taking a row off leaves no trace; values
    of 10^26 or more are an error. NaN and infinite values are counted apart.
    """

    path: str
    aggregate: AggregateModel
    buckets: int = 32

    @property
    def keys(self) -> list[str]:
        """A group is named by the aggregate's grouping columns that come from the fact."""
        return [g.alias for g in self.aggregate.groups if g.of == "fact"]

    def refresh(self, row: RowModel, log: BucketLog, dimension: DataFrame | None = None) -> Callable[[SparkSession, int], None]:
        """Step for `after_batch`."""

        def on_batch(spark: SparkSession, batch_id: int) -> None:
            batch = log.read_batch(spark, batch_id)
            changed = cut(batch.select(*row.spec.keys).distinct(), "changed-keys")
            held = cut(among(log.read(spark, batch_id, log.buckets_of(changed)), changed), "held-versions")
            before, after = row.build({row.source: held}), row.build({row.source: held.unionByName(batch)})
            sums = self._sums(after)
            sums.write(self._difference(before, after), batch_id)
            touched = cut(sums.read_batch(spark, batch_id).select(*self.keys).distinct(), "touched-groups")
            now = sums.reduce(among(sums.read(spark, batch_id + 1, sums.buckets_of(touched)), touched))
            tables = {self.aggregate.dimension: dimension} if dimension is not None else {}
            number = F.lit(batch_id).cast("bigint")
            rows = self.aggregate.finished(self._plain(now, after), tables)
            rows.withColumn("_batch", number).write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")
            touched.withColumn("_batch", number).write.mode("overwrite").parquet(f"{self.path}/touched/batch={batch_id}")

        return on_batch

    def read(self, spark: SparkSession) -> DataFrame:
        """The aggregate as of the last batch: of each group what the last batch that touched it wrote."""
        last = self._stored(spark, "touched").groupBy(*self.keys).agg(F.max("_batch").alias("_last"))
        named = last.withColumnsRenamed({k: f"_g_{k}" for k in self.keys})
        rows = self._stored(spark, "rows")
        same = F.col("_batch") == F.col("_last")
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
        return rows.join(named, same, "left_semi").drop("_batch")

    def _stored(self, spark: SparkSession, part: str) -> DataFrame:
        done = finished(spark, folders(spark, f"{self.path}/{part}", "batch"))
        return spark.read.parquet(*[done[n] for n in sorted(done)])

    def _sums(self, fact: DataFrame) -> BucketLog:
        """The log of what is added to and taken off the sums; its state is their total, without groups of no row."""
        schema = self._difference(fact, fact).schema
        named = [c for c in schema.names if c in self.keys or c.startswith("_k_")]

        def total(df: DataFrame) -> DataFrame:
            added = [F.sum(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name not in named]
            return df.groupBy(*named).agg(*added).filter("_rows <> 0").select(*schema.names)

        return BucketLog(f"{self.path}/sums", schema, tuple(self.keys), total, self.buckets)

    def _values(self) -> dict[str, Column]:
        """The added-up value of each measure, by the name its sum has in the aggregate."""
        return {f"_{m.alias}": reduce(Column.__mul__, map(F.col, m.columns)) for m in self.aggregate.measures if m.kind != "count_distinct"}

    def _difference(self, before: DataFrame, after: DataFrame) -> DataFrame:
        """What the rows after and before differ by, added up; groups that do not differ are left out."""
        signed = before.withColumn("_sign", F.lit(-1).cast("bigint")).unionByName(after.withColumn("_sign", F.lit(1).cast("bigint")))
        fact, keys = self.aggregate.keyed(signed)
        sign, sums = F.col("_sign"), [F.sum("_sign").alias("_rows")]

        def times(test: Column, name: str) -> Column:
            return F.sum(F.when(test, sign).otherwise(0)).alias(name)

        for m in self.aggregate.measures:
            if m.kind == "count_distinct":
                sums.append(times(F.col(m.columns[0]).isNotNull(), f"_{m.alias}"))
        for name, value in self._values().items():
            kind = fact.select(value.alias("v")).schema["v"].dataType
            sums.append(times(value.isNotNull(), f"{name}_n"))
            if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
                for odd, label in ((float("nan"), "nan"), (float("inf"), "up"), (float("-inf"), "down")):
                    sums.append(times(value == F.lit(odd), f"{name}_{label}"))
                value = F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)
            held = F.coalesce(value.cast(_sum_type(kind)), F.lit(0))
            sums.append(F.sum(F.when(sign < 0, -held).otherwise(held)).cast(_sum_type(kind)).alias(name))
        delta = fact.groupBy(*keys).agg(*sums)
        named = [c for c in delta.columns if c in self.keys or c.startswith("_k_")]
        return delta.filter(reduce(Column.__or__, [F.col(c) != 0 for c in delta.columns if c not in named]))

    def _plain(self, sums: DataFrame, fact: DataFrame) -> DataFrame:
        """The sums as the aggregate has them: NULL where no value is there, floating point where the column is."""
        wanted = self.aggregate.added_up(fact).schema
        shown = []
        for f in wanted:
            value = F.col(f.name)
            if f.name in self._values():
                value = value.cast(f.dataType)
                if f"{f.name}_nan" in sums.columns:
                    nan, up, down = (F.col(f"{f.name}_{x}") > 0 for x in ("nan", "up", "down"))
                    value = F.when(nan | (up & down), float("nan")).when(up, float("inf")).when(down, float("-inf")).otherwise(value)
                value = F.when(F.col(f"{f.name}_n") > 0, value)
            shown.append(value.alias(f.name))
        return sums.select(*shown)


def _sum_type(kind: T.DataType) -> str:
    """The type a sum is held in: whole numbers and decimals as such, floating point with 12 decimals."""
    if isinstance(kind, T.DecimalType):
        return f"decimal(38,{kind.scale})"
    return "decimal(38,12)" if isinstance(kind, T.FractionalType) else "decimal(38,0)"


def among(log: DataFrame, keys: DataFrame) -> DataFrame:
    """The versions of some keys; NULL keys are equal."""
    named = keys.withColumnsRenamed({k: f"_k_{k}" for k in keys.columns})
    same = F.lit(True)
    for k in keys.columns:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return log.join(named, same, "left_semi")


def stream_drift(seen: DataFrame, registry: Source, earlier: Source | None, log: KeyedLog, checkpoint: str,
                 latest: Callable[[DataFrame], DataFrame], seen_at: str = "seen_at", schema: str = "BRONZE",
                 trigger: Mapping[str, object] | None = None, name: str = "drift") -> StreamingQuery:
    """Check the columns seen in each micro-batch against the registry and store new events.

    `latest` reduces a batch to one row per column. Each batch meets the registry and the events as they are then: a
    change with an open event in `log`, or in `earlier` (events that are kept elsewhere), is not reported again, but it is
    once its event was resolved and the change is there anew. `registry` and `earlier` may be functions of the
    transaction, for tables of the same warehouse, or of anything that others move on. The detection time is the batch's newest `seen_at`,
    and a batch is stored once, under the stream's `name`.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen_columns = cut(latest(batch), "sightings")
        tables = cut(seen_columns.select(*TABLE).distinct(), "sighted-tables")
        now = batch.agg(F.max(seen_at)).scalar()
        wanted = [*CHANGE, "status"]

        def look(tx: Transaction) -> None:
            # Only what concerns the tables of this batch takes part.
            mine = log.within(tx)
            known = mine.newest(spark).select(*wanted)
            if earlier is not None:
                known = known.unionByName(_now(earlier, tx).select(*wanted))
            known = known.filter(F.col("status").isin(*LIVE_STATES)).join(tables, TABLE, "left_semi")
            held = _now(registry, tx).join(tables, TABLE, "left_semi")
            mine.append(spark, new_events(detect(seen_columns, held, known, schema), now, CHANGE), (name, batch_id), alone=True)

        log.warehouse.attempt(spark, look)

    return (
        seen.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _now(source: Source, tx: Transaction) -> DataFrame:
    return source if isinstance(source, DataFrame) else source(tx)
