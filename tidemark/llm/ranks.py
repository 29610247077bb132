"""Places of rows within classes, found by a range sort: no class lies in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut


def ranked(rows: DataFrame, of: str, order: list[str]) -> DataFrame:
    """`rows` with `at`, the place (from 0) of a row in its class by `order`, and `total`, the rows of its class. A null class is one too.

    The rows are sorted by class and order in ranges, so a large class lies in many of them, and stored with their
    place in the range. What is then summed is one row for each class and range. Rows that agree in all of `order`
    have some order among them, the same for every reader of the result. `rows` is read twice and should be stored.
    """
    keys = [F.col(of).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    dealt = cut(dealt, "ranks-sorted")
    part = F.shiftright("place", 33)
    runs = dealt.groupBy(F.col(of).alias("run_of"), part.alias("run_part")).agg(F.min("place").alias("run_first"), F.count("*").alias("run_rows"))
    earlier = Window.partitionBy("run_of").orderBy("run_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("run_start", F.coalesce(F.sum("run_rows").over(earlier), F.lit(0)) - F.col("run_first"))
    runs = cut(runs.withColumn("total", F.sum("run_rows").over(Window.partitionBy("run_of"))).drop("run_rows", "run_first"), "ranks-runs")
    return dealt.join(runs, F.col(of).eqNullSafe(F.col("run_of")) & (part == F.col("run_part"))).select(
        *[F.col(f"`{c}`") for c in rows.columns], (F.col("place") + F.col("run_start")).alias("at"), "total"
    )
