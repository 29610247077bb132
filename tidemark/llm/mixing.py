"""Mixing sources to target weights by hash thresholds.

Every document has a hash of 60 bits. Sizes are summed by source and the first 12 bits; the running sum over these
buckets shows in which one a source's budget ends. Only that bucket is divided by the next 12 bits, and so on, until
the threshold is known to the last bit. Documents below it are taken: a filter, no sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut

from .common import unused

LEVEL_BITS, LEVELS = 12, 5
HASH_BITS = LEVEL_BITS * LEVELS
#: A word, as in the registered queries.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | Column = "text") -> Column:
    """The number of words of a text; 0 for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(*columns: str | Column) -> Column:
    """The first 60 bits of the md5 of the columns as text, joined by colons; nulls are left out."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *texts)), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """`sizes` (`source`, `source_size`) with each source's `target`.

    Sources in the order of their code points, null last, have the `weights` in turn and share `share` times all
    sizes. No target is above `most` times its source's size; what is over goes to the others by weight, until none
    is above. Sources that stop are those with the least size for their weight, so one running sum finds them.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    by_size = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = by_size.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rated = (
        sizes.withColumn("weight", weight)
        .withColumn("size_before", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("rate", (F.lit(share) * F.col("all_size") - F.lit(most) * F.col("size_before")) / F.col("weight_left"))
        .withColumn("stops", F.lit(most) * F.col("source_size") <= F.col("rate") * F.col("weight"))
    )
    # The first source that does not stop has the rate of all that do not.
    rate = F.max(F.when(~F.col("stops"), F.struct("weight_left", "rate"))).over(everything)["rate"]
    aim = F.when(F.col("stops"), F.lit(most) * F.col("source_size")).otherwise(rate * F.col("weight"))
    return rated.select("source", "source_size", aim.alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """`budgets` (`source`, `budget`) with `below`: the documents of a source whose `hash` is below it come nearest to its budget.

    `rows` has `source`, `hash` and `size`. Each round sums only the bucket of each source in which its budget ends.
    Documents with one hash go together. Rows of sources without a budget do not matter.
    """
    open_ = cut(budgets.select("source", "budget", F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("taken")), "mix-open")
    rest, done = rows.select("source", "hash", "size"), []
    for level in range(1, LEVELS + 1):
        shift = HASH_BITS - LEVEL_BITS * level
        bucket = F.shiftleft(F.shiftright("hash", shift), shift)
        sums = rest.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
        running = Window.partitionBy("source").orderBy("bucket")
        summed = sums.withColumn("upto", F.sum("size").over(running)).withColumnRenamed("source", "of")
        crossing = (
            open_.join(summed, F.col("source").eqNullSafe(F.col("of")) & (F.col("taken") + F.col("upto") > F.col("budget")))
            .groupBy("source", "budget", "taken")
            .agg(F.min(F.struct("bucket", "size", "upto")).alias("at"))
            .select("source", "budget", F.col("at.bucket").alias("start"), (F.col("taken") + F.col("at.upto") - F.col("at.size")).alias("taken"), F.col("at.size").alias("size"))
        )
        crossing = cut(crossing, "mix-crossing")
        if level == LEVELS:
            nearer = F.col("taken") + F.col("size") - F.col("budget") < F.col("budget") - F.col("taken")
            done.append(crossing.select("source", (F.col("start") + nearer.cast("long")).alias("below")))
        else:
            open_ = crossing.drop("size")
            edge = crossing.select(F.col("source").alias("of"), "start")
            rest = cut(rest.join(edge, F.col("source").eqNullSafe(F.col("of")) & (bucket == F.col("start"))).select("source", "hash", "size"), "mix-rest")
    below = done[0].withColumnRenamed("source", "of")
    return budgets.join(below, F.col("source").eqNullSafe(F.col("of")), "left").select(budgets["*"], F.coalesce("below", F.lit(1 << HASH_BITS)).alias("below"))


def plan(rows: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source of `rows` (`source`, `hash`, `size`): `source_size`, `target`, whole `copies` of every document, and `below`, under which a hash takes one more.

    The thresholds of the passes are nested: who is taken twice is taken once. A source without a word gets nothing.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = targets(sizes, weights, share, most)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    aimed = cut(aimed.withColumn("copies", copies).withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size")), "mix-targets")
    edges = thresholds(rows, aimed.select("source", "budget")).select(F.col("source").alias("of"), F.when(F.col("budget") > 0, F.col("below")).otherwise(0).alias("below"))
    return cut(aimed.join(edges, F.col("source").eqNullSafe(F.col("of"))).select("source", "source_size", "target", "copies", "below"), "mix-plan")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """`doc_id`, `size`, `source_size`, `target` and `taken` words of every row of `docs`.

    Null and empty texts have size 0. A null source is a source of its own. Rows that repeat an id and a text have one
    hash and go together; an empty table gives no row; other columns do not matter.
    """
    rows = cut(docs.select("doc_id", "source", hash60("doc_id", "text").alias("hash"), words().alias("size")), "mix-rows")
    aims = plan(rows, weights, share, most).withColumnRenamed("source", "of")
    taken = F.col("size") * (F.col("copies") + (F.col("hash") < F.col("below")).cast("long"))
    return rows.join(aims, F.col("source").eqNullSafe(F.col("of"))).select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it, with their columns; those it does not take are gone.

    Null and empty texts have size 0: they are taken or left by their hash like others. A null source is a source of its own. Rows that
    repeat an id and a text go together. An empty table gives no row; columns with clashing names stay as they are.
    """
    size, hashed, own = unused(docs, "mix_size"), unused(docs, "mix_hash"), unused(docs, "mix_source")
    rows = cut(docs.select("source", hash60("doc_id", "text").alias("hash"), words().alias("size")), "mix-rows")
    aims = plan(rows, weights, share, most).select(F.col("source").alias(own), F.col("copies").alias(size), F.col("below").alias(hashed))
    joined = docs.join(aims, docs["source"].eqNullSafe(F.col(own)))
    times = F.col(size) + (hash60(docs["doc_id"], docs["text"]) < F.col(hashed)).cast("long")
    repeated = F.explode(F.array_repeat(F.lit(0), times.cast("int")))
    return joined.withColumn(unused(docs, "mix_copy"), repeated).select(*[docs[f"`{c}`"] for c in docs.columns])
