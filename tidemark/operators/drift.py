"""Schema drift: the current columns against a registered baseline.

`columns` has (table_schema, table_name, column_name, data_type, ordinal_position), `registry` has
(table_schema, table_name, column_name, data_type), `events` has the change events so far. Either may
be as large as a catalogue of many tenants; all matching is by shuffle on the column's full name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import COLUMN_DROP, LIVE_STATES, NEW_COLUMN, NEW_TABLE, TYPE_CHANGE
from ..functions.columns import is_business_column, is_drop_marker, is_journal, without_drop_suffix
from ..session import cut

TABLE = ["table_schema", "table_name"]
COLUMN = [*TABLE, "column_name"]
# The same keys for joining: a sort compares the first eight bytes first, and those of the schema are all alike.
BY_TABLE = ["table_name", "table_schema"]
BY_COLUMN = ["table_name", "column_name", "table_schema"]
CHANGE = [*COLUMN, "change_type", "old_data_type", "new_data_type"]


def _change(kind: str, column: Column, old: Column, new: Column) -> list[Column]:
    return [
        *[F.col(c) for c in TABLE],
        column.cast("string").alias("column_name"),
        F.lit(kind).alias("change_type"),
        old.cast("string").alias("old_data_type"),
        new.cast("string").alias("new_data_type"),
    ]


def in_schema(df: DataFrame, schema: str) -> DataFrame:
    return df.filter(F.col("table_schema") == schema)


def known_tables(registry: DataFrame) -> DataFrame:
    return registry.select(*TABLE).distinct()


def live_events(events: DataFrame, kind: str) -> DataFrame:
    """Names that already have an open event of this kind."""
    return events.filter((F.col("change_type") == kind) & F.col("status").isin(*LIVE_STATES))


def _without_live(changes: DataFrame, events: DataFrame, kind: str, on: list[str]) -> DataFrame:
    return changes.join(live_events(events, kind).select(*on).distinct(), on, "left_anti").select(*CHANGE)


def new_columns(columns: DataFrame, registry: DataFrame, events: DataFrame, schema: str = "BRONZE") -> DataFrame:
    """Business columns of a known table that the registry does not hold."""
    name = F.col("column_name")
    candidates = in_schema(columns, schema).filter(
        ~is_journal(F.col("table_name")) & is_business_column(name, markers=False)
    )
    fresh = candidates.join(registry.select(*COLUMN), BY_COLUMN, "left_anti")
    of_known = fresh.join(cut(known_tables(registry), "tables"), BY_TABLE, "left_semi")
    found = of_known.select(*_change(NEW_COLUMN, name, F.lit(None), F.col("data_type")))
    return _without_live(found, events, NEW_COLUMN, BY_COLUMN)


def dropped_columns(columns: DataFrame, registry: DataFrame, events: DataFrame, schema: str = "BRONZE") -> DataFrame:
    """Registered columns that the connector renamed to a drop marker."""
    name = F.col("column_name")
    markers = in_schema(columns, schema).filter(is_drop_marker(name))
    stripped = markers.select(*TABLE, without_drop_suffix(name).alias("column_name"))
    found = stripped.join(registry.select(*COLUMN, "data_type"), BY_COLUMN).select(
        *_change(COLUMN_DROP, name, F.col("data_type"), F.lit(None))
    )
    return _without_live(found, events, COLUMN_DROP, BY_COLUMN)


def changed_types(columns: DataFrame, registry: DataFrame, events: DataFrame, schema: str = "BRONZE") -> DataFrame:
    """Registered columns whose type text differs."""
    before = registry.select(*COLUMN, F.col("data_type").alias("old_type"))
    found = (
        in_schema(columns, schema)
        .join(before, BY_COLUMN)
        .filter(F.col("data_type") != F.col("old_type"))
        .select(*_change(TYPE_CHANGE, F.col("column_name"), F.col("old_type"), F.col("data_type")))
    )
    return _without_live(found, events, TYPE_CHANGE, BY_COLUMN)


def new_tables(tables: DataFrame, registry: DataFrame, events: DataFrame, schema: str = "BRONZE") -> DataFrame:
    """Base tables without any registry row. `tables` has one row per table, or per column."""
    candidates = in_schema(tables, schema).filter(~is_journal(F.col("table_name")))
    if "table_type" in tables.columns:
        candidates = candidates.filter(F.col("table_type") == "BASE TABLE")
    unknown = candidates.select(*TABLE).distinct().join(known_tables(registry), BY_TABLE, "left_anti")
    none = F.lit(None)
    return _without_live(unknown.select(*_change(NEW_TABLE, none, none, none)), events, NEW_TABLE, BY_TABLE)


def column_changes(columns: DataFrame, registry: DataFrame, events: DataFrame, schema: str = "BRONZE") -> DataFrame:
    """The three column-level branches in one pass.

    Columns meet the registry and the open events once, on the column's full name, so the catalogue is
    shuffled once and not once per branch. A marker takes part twice: under its own name (type change)
    and under the stripped name (drop).
    """
    name = F.col("column_name")
    both = F.array(
        F.struct(name.alias("n"), F.lit(False).alias("m")),
        F.struct(without_drop_suffix(name).alias("n"), F.lit(True).alias("m")),
    )
    seen = in_schema(columns, schema).select(
        *TABLE, "data_type", F.explode(F.when(is_drop_marker(name), both).otherwise(F.slice(both, 1, 1))).alias("c")
    )
    seen = seen.select(*TABLE, F.col("c.n").alias("column_name"), "data_type", F.col("c.m").alias("marker"))
    before = registry.select(*COLUMN, F.col("data_type").alias("old_type"), F.lit(True).alias("known"))
    is_live = F.col("status").isin(*LIVE_STATES)
    live = events.filter(is_live).groupBy(*BY_COLUMN).agg(
        *[F.max(F.col("change_type") == kind).alias(f"live_{kind}") for kind in (NEW_COLUMN, COLUMN_DROP, TYPE_CHANGE)]
    )
    joined = seen.join(before, BY_COLUMN, "left").join(live, BY_COLUMN, "left")
    known = F.col("known").isNotNull()

    def unseen(kind: str) -> Column:
        return ~F.coalesce(F.col(f"live_{kind}"), F.lit(False))

    is_new = (
        ~F.col("marker") & ~known & ~is_journal(F.col("table_name"))
        & is_business_column(name, markers=False) & unseen(NEW_COLUMN)
    )
    dropped = F.col("marker") & known & unseen(COLUMN_DROP)
    retyped = ~F.col("marker") & known & (F.col("data_type") != F.col("old_type")) & unseen(TYPE_CHANGE)
    changed = joined.withColumn(
        "change_type",
        F.when(is_new, NEW_COLUMN).when(dropped, COLUMN_DROP).when(retyped, TYPE_CHANGE),
    ).filter(F.col("change_type").isNotNull())
    old = F.when(F.col("change_type") != NEW_COLUMN, F.col("old_type"))
    new = F.when(F.col("change_type") != COLUMN_DROP, F.col("data_type"))
    found = changed.select(*COLUMN, "change_type", old.alias("old_data_type"), new.alias("new_data_type"))
    # Stored, so that the join does not share its shuffle with a grouping and a table with many columns can be split.
    tables = cut(known_tables(registry), "tables").withColumn("table_known", F.lit(True))
    in_known_table = (F.col("change_type") != NEW_COLUMN) | F.col("table_known").isNotNull()
    return found.join(tables, BY_TABLE, "left").filter(in_known_table).select(*CHANGE)


def detect(columns: DataFrame, registry: DataFrame, events: DataFrame, schema: str = "BRONZE",
           tables: DataFrame | None = None) -> DataFrame:
    """All four kinds of change, without those that have an open event."""
    return column_changes(columns, registry, events, schema).unionByName(
        new_tables(columns if tables is None else tables, registry, events, schema)
    )


def snapshot_diff(baseline: DataFrame, current: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """Rows added, removed or changed between two snapshots, with old and new values.

    Both sides have one row per key. Values are compared with NULL equal to NULL.
    """
    old = baseline.select(*keys, *[F.col(c).alias(f"old_{c}") for c in compare], F.lit(True).alias("_old"))
    new = current.select(*keys, *[F.col(c).alias(f"new_{c}") for c in compare], F.lit(True).alias("_new"))
    both = old.join(new, keys, "full")
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    kind = F.when(F.col("_old").isNull(), "ADDED").when(F.col("_new").isNull(), "REMOVED").when(differs, "CHANGED")
    return (
        both.withColumn("change", kind)
        .filter(F.col("change").isNotNull())
        .select(*keys, "change", *[f"{side}_{c}" for c in compare for side in ("old", "new")])
    )
