"""Which columns a model reads, and what a change of one column reaches, from the models themselves."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, local_rows
from .models import Model, RowModel

COLUMN_EDGE_SCHEMA = "artifact_name string, output_column string, source_table string, source_column string, role string"


def attributes(model: Model) -> list[tuple[str | None, str, str, str]]:
    """What the model reads: (output column, source, column, role). Without an output column the whole row depends on it:
    which rows there are, or which version of them."""
    if isinstance(model, RowModel):
        spec = model.spec
        rows = [(c, model.source, c, "projection") for c in model.columns]
        rows += [(None, model.source, c, "key") for c in spec.keys]
        rows += [(None, model.source, c, "order") for c in (spec.version, *spec.tie_breakers)]
        return rows + ([(None, model.source, spec.deleted, "filter")] if spec.deleted else [])
    rows = [(g.alias, model.fact if g.of == "fact" else model.dimension, g.column, "group") for g in model.groups]
    rows += [(m.alias, model.fact, c, "measure") for m in model.measures for c in m.columns]
    rows.append((None, model.fact, model.fact_key, "key"))
    if model.dimension is not None:
        rows += [(None, model.fact, model.fact_join, "join"), (None, model.dimension, model.dimension_join, "join")]
    return rows


def source_columns(model: Model, source: str) -> list[str]:
    """The columns of one source that the model reads, in upper case."""
    return sorted({column.upper() for _, table, column, _ in attributes(model) if table == source})


def column_edges(spark: SparkSession, models: Mapping[str, Model]) -> DataFrame:
    """One row for each column that a model reads and what it reads it for; names of tables and columns in upper case."""
    rows = [
        (name, output and output.upper(), table.upper(), column.upper(), role)
        for name, model in models.items()
        for output, table, column, role in dict.fromkeys(attributes(model))
    ]
    return local_rows(spark, rows, COLUMN_EDGE_SCHEMA)


def column_links(edges: DataFrame) -> DataFrame:
    """From column to column (`source_table`, `source_column`, `artifact_name`, `output_column`): a column on which whole rows
    depend reaches every column of the artifact."""
    outputs = edges.filter(F.col("output_column").isNotNull()).select("artifact_name", "output_column").distinct()
    whole = edges.filter(F.col("output_column").isNull()).drop("output_column").join(outputs, "artifact_name")
    shown = ["source_table", "source_column", "artifact_name", "output_column"]
    return edges.filter(F.col("output_column").isNotNull()).select(*shown).unionByName(whole.select(*shown)).distinct()


def column_impact(events: DataFrame, edges: DataFrame, schema: str = "BRONZE") -> DataFrame:
    """Every column that a changed column reaches (`event_id`, `artifact_name`, `output_column`), with the smallest number of steps.

    Events without a column reach nothing here. The walk starts from the distinct changed columns, however many events
    there are; each level holds what no earlier one had, so cycles end.
    """
    links = cut(column_links(edges), "column-links")
    changes = events.filter(F.col("column_name").isNotNull()).select(
        "event_id", F.concat(F.lit(schema + "."), F.upper("table_name")).alias("origin_table"), F.upper("column_name").alias("origin_column")
    )
    origin = ["origin_table", "origin_column"]
    front = cut(changes.select(*origin).distinct(), "column-origins").select("*", F.col("origin_table").alias("source_table"), F.col("origin_column").alias("source_column"))
    reached, depth = None, 0
    found = [*origin, "artifact_name", "output_column"]
    while True:
        depth += 1
        level = front.join(links, ["source_table", "source_column"]).select(*found).distinct()
        level = level if reached is None else level.join(reached, found, "left_anti")
        level = cut(level.withColumn("depth", F.lit(depth)), "column-walk")
        reached = level if reached is None else reached.unionByName(level)
        if level.isEmpty():
            break
        front = level.select(*origin, F.upper("artifact_name").alias("source_table"), F.col("output_column").alias("source_column"))
    return changes.join(reached, origin).select("event_id", "artifact_name", "output_column", "depth")
