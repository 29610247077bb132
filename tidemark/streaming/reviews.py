"""Reviews as a stream: change events meet the review states of their branches, in whatever order both arrive."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.events import awaiting_review, by_review_state, first_verdict, review_verdict
from ..sources.tables import numbered, put_once, read_file
from .log import BucketLog


def _first(rows: DataFrame) -> DataFrame:
    return rows.groupBy("event_id").agg(first_verdict(F.col("verdict")).alias("first")).select("event_id", "first.*")


def review_log(path: str, reviews: DataFrame, buckets: int = 32) -> BucketLog:
    """Per event the first verdict in list order that has reached it, NULL if its time has passed without one."""
    schema = T.StructType([
        T.StructField("event_id", T.StringType()),
        T.StructField("position", reviews.schema["position"].dataType),
        T.StructField("verdict", T.StringType()),
    ])
    return BucketLog(path, schema, ("event_id",), _first, buckets)


def _held_log(path: str, keep: Column, kept: str, buckets: int) -> BucketLog:
    """What waits, by branch; what `keep` is not true for goes when its bucket is folded, and so do repeated rows."""
    return BucketLog(path, T.StructType.fromDDL(kept), ("branch",), lambda rows: rows.filter(keep).distinct(), buckets)


def stream_reviews(events: DataFrame, reviews: DataFrame, log: BucketLog, checkpoint: str, within: str = "90 days",
                   late: str = "7 days", spread: int = 1, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Follow events and reviews, and store which verdict reaches which event.

    `events` are change events as they come into review, `reviews` rows (branch_name, position, merged_at, state, seen_at),
    one each time a review is seen. What may still meet is held: an event and a review of its branch that were detected
    and seen at most `within` apart, each up to `late` behind the newest of its stream (of the stream that is behind, as
    with Spark's watermarks). So what is held is bounded by time, and the verdict that is first in list order counts, in
    whatever order they arrive. An event that has met no verdict in its time is stored without one.

    A review that is seen again at the same time with the same verdict is held once. Open reviews say nothing and go no
    further; resolved events and those without a branch wait for none. Rows without a branch or a time take no part.
    Where a branch has many events, `spread` deals them over so many keys and copies its verdicts to each.

    What waits lies in two bucketed logs below `checkpoint`, not in the memory of state stores. A batch is joined in
    itself and with what waits in the buckets of its branches.
    """
    moment = "timestamp"
    waiting = events.filter(awaiting_review()).select("event_id", F.col("branch_name").alias("branch"), F.col("detected_at").cast(moment).alias("at"))
    verdicts = reviews.select(
        F.col("branch_name").alias("branch"), F.col("seen_at").cast(moment).alias("at"), "position", review_verdict().alias("verdict")
    ).filter("verdict IS NOT NULL")
    both = waiting.unionByName(verdicts, allowMissingColumns=True).filter("branch IS NOT NULL AND at IS NOT NULL")
    apart, wait = F.expr(f"INTERVAL {within}"), F.expr(f"INTERVAL {late}")
    held = f"{checkpoint}/held"
    place = reviews.schema["position"].dataType.simpleString()

    def newest_before(spark: SparkSession, batch_id: int) -> list[int | None]:
        """Newest times, in microseconds, of events and verdicts that came before a batch."""
        done = [n for n in numbered(spark, f"{held}/times") if n < batch_id]
        return json.loads(read_file(spark, f"{held}/times/{max(done):012d}")) if done else [None, None]

    def watermark(times: list[int | None]) -> Column | None:
        """Rows before it are late; it goes by the stream that is behind."""
        return None if None in times else F.timestamp_micros(F.lit(min(times))) - wait

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        left = left.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(spread)).cast("int")).withColumnRenamed("at", "detected_at")
        right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))).withColumnRenamed("at", "seen_at")
        near = (F.col("seen_at") >= F.col("detected_at") - apart) & (F.col("seen_at") <= F.col("detected_at") + apart)
        return left.join(right, ["branch", "part"]).filter(near).select("event_id", "position", "verdict")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = newest_before(spark, batch_id)
        limit = watermark(before)
        keep = F.lit(True) if limit is None else F.col("at") >= limit - apart
        events_log = _held_log(f"{held}/events", keep, "event_id string, branch string, at timestamp", log.buckets)
        verdicts_log = _held_log(f"{held}/verdicts", keep, f"branch string, at timestamp, position {place}, verdict string", log.buckets)
        fresh = batch if limit is None else batch.filter(F.col("at") >= limit)
        events_log.write(fresh.filter("verdict IS NULL"), batch_id)
        verdicts_log.write(fresh.filter("verdict IS NOT NULL"), batch_id)

        came, seen = events_log.read_batch(spark, batch_id), verdicts_log.read_batch(spark, batch_id)
        earlier = events_log.read(spark, batch_id, events_log.buckets_of(seen))
        known = verdicts_log.read(spark, batch_id, verdicts_log.buckets_of(came))
        met = meet(came, seen.unionByName(known)).unionByName(meet(earlier, seen))

        # The newest times are taken from the stored rows, so a batch that is run again finds the same.
        newest = [rows.agg(F.unix_micros(F.max("at"))).first()[0] for rows in (came, seen)]
        after = [max((t for t in pair if t is not None), default=None) for pair in zip(before, newest)]
        now = watermark(after)
        if now is not None:
            gone = events_log.read(spark, batch_id + 1).filter(keep & (F.col("at") < now - apart))
            nothing = met.schema
            met = met.unionByName(gone.select("event_id", *[F.lit(None).cast(nothing[c].dataType).alias(c) for c in ("position", "verdict")]))
        log.write(_first(met), batch_id)
        put_once(spark, f"{held}/times/{batch_id:012d}", json.dumps(after))

    return (
        both.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def reviewed(spark: SparkSession, events: DataFrame, log: BucketLog, now: Column) -> DataFrame:
    """The events, moved by the verdicts stored so far, as `reconcile_reviews` moves them."""
    states = _first(log.read(spark)).select("event_id", F.coalesce("verdict", F.lit("open")).alias("review_state"))
    return by_review_state(events, states, "event_id", now)
