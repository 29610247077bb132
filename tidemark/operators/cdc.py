"""Current state of a change log: live rows, newest version per key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import DELETED_COLUMN, VERSION_COLUMN
from ..functions.columns import is_true


@dataclass(frozen=True)
class CdcSpec:
    """How a change log is keyed and ordered.

    `tie_breakers` decide between equal versions. By default the delete filter runs before the ranking,
    so an older live row comes back when the newest version is a tombstone; `tombstone_wins` ranks
    first.
    """

    keys: tuple[str, ...]
    version: str = VERSION_COLUMN
    deleted: str | None = DELETED_COLUMN
    tie_breakers: tuple[str, ...] = ()
    nulls_first: bool = True
    tombstone_wins: bool = False

    def alive(self) -> Column:
        return F.lit(True) if self.deleted is None else ~is_true(F.col(self.deleted))

    def newest_first(self) -> list[Column]:
        version = F.col(self.version)
        first = version.desc_nulls_first() if self.nulls_first else version.desc_nulls_last()
        return [first, *[F.col(c).desc_nulls_last() for c in self.tie_breakers]]


def first_per_key(df: DataFrame, keys: list[str] | tuple[str, ...], order: list[Column]) -> DataFrame:
    """One row per key. The rank limit also runs before the shuffle, so a hot key sends at most one row
    per map task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def newest(log: DataFrame, spec: CdcSpec) -> DataFrame:
    """Newest version per key, tombstones taken out before or after the ranking."""
    if spec.tombstone_wins:
        return first_per_key(log, spec.keys, spec.newest_first())
    return first_per_key(log.filter(spec.alive()), spec.keys, spec.newest_first())


def current_state(log: DataFrame, spec: CdcSpec) -> DataFrame:
    return newest(log, spec).filter(spec.alive()) if spec.tombstone_wins else newest(log, spec)
