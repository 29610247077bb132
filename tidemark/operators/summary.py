"""Text summaries of a group of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def labels(df: DataFrame, group: list[str], place: str, label: Column) -> DataFrame:
    """One row per label with its group and its place there (unique in the group): a text of any length is these
    rows in the order of their places."""
    return df.select(*group, place, label.alias("label"))
