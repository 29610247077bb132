"""Table changes as functions from the old rows to the new rows.

Plain files take no MERGE, UPDATE or DELETE; each function returns the whole new table, to be written
as a new version (see `sources.tables`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_true, row_id
from .cdc import first_per_key


def with_defaults(rows: DataFrame, defaults: Mapping[str, Column], id_column: str | None = None,
                  id_from: Sequence[str] = ()) -> DataFrame:
    """Fill absent or NULL columns; `id_column` gets a stable id made from `id_from`."""
    filled = dict(defaults)
    if id_column:
        filled[id_column] = row_id(*id_from)
    return rows.withColumns(
        {c: F.coalesce(F.col(c), d) if c in rows.columns else d for c, d in filled.items()}
    )


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    return target.unionByName(rows, allowMissingColumns=True)


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Add the rows whose key the target does not hold; a NULL key never matches."""
    return target.unionByName(_fresh(target, incoming, keys).select(*target.columns))


def _fresh(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """The incoming rows whose key the target does not hold. A small side can be sent in a semi join only if it is the
    right one, so the target first gives its keys among the incoming, and these few meet the incoming rows."""
    held = target.select(*keys).join(incoming.select(*keys), keys, "left_semi")
    return incoming.join(held, keys, "left_anti")


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """As above, and a key repeated inside the batch keeps its first row in `order`."""
    return insert_if_absent(target, first_per_key(batch, keys, order), keys)


def upsert(target: DataFrame, change: DataFrame, keys: list[str], update: list[str] | None = None) -> DataFrame:
    """Matched keys take the change's values (`update` columns only, if given), new keys are added.

    `change` has one row per key. With a small change the keys are sent to the target, which then
    does not move.
    """
    if update is None:
        return target.join(change.select(*keys), keys, "left_anti").unionByName(change.select(*target.columns))
    marked = change.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in update], F.lit(True).alias("_hit"))
    kept = target.join(marked, keys, "left").select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
            for c in target.columns
        ]
    )
    return kept.unionByName(_fresh(target, change, keys).select(*target.columns))


def update_where(df: DataFrame, where: Column, values: Mapping[str, Column]) -> DataFrame:
    """New values where the test holds; NULL counts as not. All tests see the old row."""
    return df.select(
        *[F.when(is_true(where), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns]
    )


def delete_where(df: DataFrame, where: Column) -> DataFrame:
    return df.filter(~is_true(where))


def delete_keys(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(gone.select(*keys), keys, "left_anti")


def replace_slice(target: DataFrame, rows: DataFrame, in_slice: Column, active: bool = True,
                  keep_if_empty: bool = True) -> DataFrame:
    """Exchange one slice for `rows`.

    With `keep_if_empty` an empty `rows` leaves the slice alone; `active=False` (a run outside
    production) leaves the whole table alone.
    """
    if not active:
        return target
    keep = ~is_true(in_slice)
    if keep_if_empty:
        keep = keep | ~rows.limit(1).exists()
    return target.filter(keep).unionByName(rows.select(*target.columns))


def seed_if_empty(target: DataFrame, rows: DataFrame, in_block: Column) -> DataFrame:
    """Add `rows` only if the target has no row of the block yet."""
    seeds = rows.filter(~target.filter(in_block).limit(1).exists())
    return target.unionByName(seeds.select(*target.columns))


def lookup_settings(settings: DataFrame, wanted: DataFrame, default: str) -> DataFrame:
    """Largest value per wanted key, `default` where there is none."""
    values = settings.groupBy("key").agg(F.max("value").alias("value"))
    return wanted.select("key").distinct().join(values, "key", "left").select(
        "key", F.coalesce("value", F.lit(default)).alias("value")
    )
