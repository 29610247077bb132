"""Joins with a hot key that adaptive execution cannot split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str, salt_from: list[str], spread: int | None = None
) -> DataFrame:
    """Join a `left` that may hold hot keys with a `right` that has one row per key.

    A key is hot if it has more than one part in `spread` (the session's shuffle partitions) of the left rows, so
    there are fewer than `spread` of them. Their left rows go to `spread` tasks by a hash of `salt_from`, and their
    right rows to each of these; so do left rows without a key. All other rows are joined plainly. Exact for inner,
    left, left_semi and left_anti joins.

    Meant for a join that is followed by a grouping on the key: the two share their shuffle, and adaptive execution
    then leaves a hot partition whole. It splits any other skewed join by itself, if `right` is a stored table.
    `left` is read twice more, so a derived one should be stored first.
    """
    spread = spread or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = left.agg(F.count(F.lit(1))).scalar() / F.lit(spread)
    counted = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(counted.filter(F.col("_n") > most).select(*on, F.lit(True).alias("_hot")))
    keyless = F.lit(False)
    for key in on:
        keyless = keyless | F.col(key).isNull()
    slice_ = F.pmod(F.xxhash64(*salt_from), F.lit(spread)).cast("int")
    salted = left.join(hot, on, "left").withColumn("_salt", F.when(F.col("_hot") | keyless, slice_).otherwise(0))
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    copies = right.join(hot, on, "left").withColumn("_salt", F.explode(every))
    return salted.drop("_hot").join(copies.drop("_hot"), [*on, "_salt"], how).drop("_salt")
