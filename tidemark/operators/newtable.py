"""What a new table needs: its key, its column list, its documentation and source entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ADDED_COLUMN_NOTE, COLUMN_DROP, NEW_COLUMN, NEW_TABLE
from ..functions.columns import has_connector_prefix, is_business_column, looks_like_key
from ..session import cut
from .drift import TABLE
from .lineage import silver_model_path


def infer_primary_key(columns: DataFrame) -> DataFrame:
    """Per table the first column ending in `_id` (any case), else the first column; connector columns
    do not count."""
    name, place = F.col("column_name"), F.col("ordinal_position")
    own = columns.filter(is_business_column(name))
    found = own.groupBy(*TABLE).agg(
        F.min_by(name, F.when(looks_like_key(name) & ~has_connector_prefix(name), place)).alias("key_like"),
        F.min_by(name, place).alias("first"),
    )
    return found.select(*TABLE, F.coalesce("key_like", "first").alias("primary_key"))


def new_table_spec(columns: DataFrame) -> DataFrame:
    """Per own column of a table its position, name and type, with the table's model path and key."""
    head = cut(infer_primary_key(columns), "keys")
    own = columns.filter(is_business_column(F.col("column_name")))
    return own.join(head, TABLE).select(
        *TABLE, silver_model_path(F.col("table_name")).alias("silver_model_path"), "primary_key", "ordinal_position",
        "column_name", "data_type",
    )


def added_column_note(table: Column) -> Column:
    before, after = ADDED_COLUMN_NOTE
    return F.concat(F.lit(before), table, F.lit(after))


def sync_docs(docs: DataFrame, events: DataFrame) -> DataFrame:
    """Column documentation after the events, as if they came one by one. `docs` has (model, column_name,
    description, tests).

    A dropped column loses its entry and tests. A column added after its last drop, or one without an entry, gets a
    note in the silver model named like its table. Names match in any case; models without entries stay out.
    """
    place, kind = F.struct("detected_at", "event_id"), F.col("change_type")
    changes = (
        events.filter(kind.isin(NEW_COLUMN, COLUMN_DROP) & F.col("column_name").isNotNull())
        .groupBy(F.lower("table_name").alias("_model"), F.upper("column_name").alias("_column"))
        .agg(
            F.max(F.when(kind == COLUMN_DROP, place)).alias("dropped"),
            F.max(F.when(kind == NEW_COLUMN, F.struct("detected_at", "event_id", "table_name"))).alias("added"),
        )
    )
    changes = cut(changes, "doc-changes")
    keyed = docs.withColumns({"_model": F.lower("model"), "_column": F.upper("column_name")})
    gone = changes.filter(F.col("dropped").isNotNull()).select("_model", "_column")
    kept = keyed.join(gone, ["_model", "_column"], "left_anti")
    models = cut(docs.groupBy(F.lower("model").alias("_model")).agg(F.min("model").alias("model")), "doc-models")
    last = F.struct("added.detected_at", "added.event_id")
    added = changes.filter(F.col("added").isNotNull() & (F.col("dropped").isNull() | (last > F.col("dropped")))).join(
        kept.select("_model", "_column"), ["_model", "_column"], "left_anti"
    )
    entries = added.join(models, "_model").select(
        "model", F.col("_column").alias("column_name"), added_column_note(F.col("added.table_name")).alias("description"),
        F.array().cast("array<string>").alias("tests"),
    )
    return kept.select(*docs.columns).unionByName(entries.select(*docs.columns))


def undocumented(columns: DataFrame, docs: DataFrame) -> DataFrame:
    """Columns of documented models that have no entry; names match in any case."""
    seen = columns.select(F.lower("table_name").alias("model"), F.upper("column_name").alias("column_name"))
    models = cut(docs.select(F.lower("model").alias("model")).distinct(), "doc-models")
    named = docs.select(F.lower("model").alias("model"), F.upper("column_name").alias("column_name")).distinct()
    of_models = seen.join(models, "model", "left_semi")
    return of_models.join(named, ["model", "column_name"], "left_anti")


def declare_sources(sources: DataFrame, events: DataFrame) -> DataFrame:
    """Source list (source, table_name) after the new tables among the events; names match in any case."""
    new = (
        events.filter(F.col("change_type") == NEW_TABLE)
        .select(F.lower("table_name").alias("table_name"))
        .distinct()
        .withColumn("source", F.lit("bronze"))
    )
    declared = sources.filter(F.lower("source") == "bronze").select(F.lower("table_name").alias("table_name"))
    fresh = new.join(declared.distinct(), "table_name", "left_anti")
    return sources.unionByName(fresh.select(*sources.columns))


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Column documentation as schema metadata."""
    for column, comment in comments.items():
        df = df.withMetadata(column, {"comment": comment})
    return df
