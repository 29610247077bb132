"""Models as data: which columns, keys and measures a table is made of."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import COLUMN_DROP, INSERTED_COLUMN, NEW_COLUMN, TYPE_CHANGE, VERSION_COLUMN
from ..functions.columns import day
from ..operators.cdc import CdcSpec, current_state


class BreakingChange(ValueError):
    """The change takes away a column the model cannot do without."""


@dataclass(frozen=True)
class Change:
    """One column-level change of a source table."""

    kind: str
    table: str
    column: str
    new_type: str | None = None


@dataclass(frozen=True)
class RowModel:
    """Current state of one change log with a fixed column list. With `lenient` a value that does not fit its
    new type becomes NULL; by default it is an error."""

    name: str
    source: str
    spec: CdcSpec
    columns: tuple[str, ...]
    casts: tuple[tuple[str, str], ...] = ()
    lenient: bool = False
    layer: str = "silver"

    @property
    def inputs(self) -> tuple[str, ...]:
        return (self.source,)

    def build(self, inputs: Mapping[str, DataFrame]) -> DataFrame:
        casts = dict(self.casts)
        state = current_state(inputs[self.source], self.spec)

        def shown(column: str) -> Column:
            value = F.col(column)
            if column not in casts:
                return value
            return (value.try_cast(casts[column]) if self.lenient else value.cast(casts[column])).alias(column)

        return state.select(*[shown(c) for c in self.columns])

    def sql(self) -> str:
        """The same rows as Spark SQL."""
        casts = dict(self.casts)
        cast = "TRY_CAST" if self.lenient else "CAST"
        shown = [f"{cast}({c} AS {casts[c]}) AS {c}" if c in casts else c for c in self.columns]
        alive = "TRUE" if self.spec.deleted is None else f"NOT coalesce({self.spec.deleted}, false)"
        nulls = "FIRST" if self.spec.nulls_first else "LAST"
        order = [f"{self.spec.version} DESC NULLS {nulls}", *[f"{c} DESC NULLS LAST" for c in self.spec.tie_breakers]]
        before, after = ("TRUE", f" AND {alive}") if self.spec.tombstone_wins else (alive, "")
        return (
            f"SELECT {', '.join(shown)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(self.spec.keys)} "
            f"ORDER BY {', '.join(order)}) AS _rn FROM {self.source} WHERE {before}) WHERE _rn = 1{after}"
        )

    def evolve(self, change: Change) -> RowModel:
        """The model after a change of its source: a new column goes after the last source column."""
        column = change.column.lower()
        if change.kind == NEW_COLUMN:
            if column in self.columns:
                return self
            own = [i for i, c in enumerate(self.columns) if c not in (INSERTED_COLUMN, VERSION_COLUMN)]
            at = own[-1] + 1 if own else 0
            return replace(self, columns=(*self.columns[:at], column, *self.columns[at:]))
        if column not in self.columns and column not in self.spec.keys:
            return self
        if change.kind == COLUMN_DROP:
            if column in self.spec.keys or column == self.spec.version:
                raise BreakingChange(f"{self.name} is keyed by {column}")
            return replace(
                self,
                columns=tuple(c for c in self.columns if c != column),
                casts=tuple(p for p in self.casts if p[0] != column),
                spec=replace(self.spec, tie_breakers=tuple(c for c in self.spec.tie_breakers if c != column)),
            )
        if change.kind == TYPE_CHANGE and change.new_type:
            kept = tuple(p for p in self.casts if p[0] != column)
            return replace(self, casts=(*kept, (column, change.new_type)))
        return self


@dataclass(frozen=True)
class Group:
    """A grouping column, from the fact or the dimension; `by_day` truncates it."""

    alias: str
    column: str
    of: str = "fact"
    by_day: bool = False


@dataclass(frozen=True)
class Measure:
    """`kind` is count_distinct, sum, avg or sum_product."""

    alias: str
    kind: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class AggregateModel:
    """Groups and measures over a fact that is unique by `fact_key`, with an optional dimension that is
    unique by its join column.

    The fact is added up per group, join column and distinct-counted column before it meets the
    dimension. The first shuffle therefore spreads a hot group or hot join key, the join sees few rows per
    key, and distinct counts need no row expansion: `fact_key` counts are plain counts.
    """

    name: str
    fact: str
    fact_key: str
    groups: tuple[Group, ...]
    measures: tuple[Measure, ...]
    dimension: str | None = None
    fact_join: str = ""
    dimension_join: str = ""
    casts: tuple[tuple[str, str], ...] = ()
    layer: str = "gold"

    @property
    def inputs(self) -> tuple[str, ...]:
        return (self.fact,) if self.dimension is None else (self.fact, self.dimension)

    def build(self, inputs: Mapping[str, DataFrame]) -> DataFrame:
        return self.finished(self.added_up(inputs[self.fact]), inputs)

    def added_up(self, fact: DataFrame) -> DataFrame:
        """The fact per group, join column and distinct-counted column: what `finished` needs of it."""
        fact, keys = self.keyed(fact)
        partial = [p for m in self.measures for p in self._partials(m)]
        return fact.groupBy(*keys).agg(*(partial or [F.count(F.lit(1)).alias("_rows")]))

    def finished(self, rows: DataFrame, inputs: Mapping[str, DataFrame]) -> DataFrame:
        """The aggregate from rows that are added up."""
        if self.dimension is not None:
            dim = self._cast(inputs[self.dimension], "dimension")
            columns = [self.group_column(g, dim) for g in self.groups if g.of == "dimension"]
            keyed = dim.select(F.col(self.dimension_join).alias(f"_k_{self.fact_join}"), *columns)
            rows = rows.join(keyed, f"_k_{self.fact_join}")
        single = len(self._counted) == 1
        return rows.groupBy(*[g.alias for g in self.groups]).agg(*[self._final(m, single) for m in self.measures])

    def keyed(self, fact: DataFrame) -> tuple[DataFrame, list[Column]]:
        """The rows of the fact that count, and the columns they are added up by."""
        fact = self._cast(fact, "fact")
        first_keys = [self.group_column(g, fact) for g in self.groups if g.of == "fact"]
        if self.dimension is not None:
            fact = fact.filter(F.col(self.fact_join).isNotNull())
        return fact, [*first_keys, *[F.col(c).alias(f"_k_{c}") for c in self._counted]]

    @property
    def _counted(self) -> list[str]:
        """Columns besides the groups that the fact is added up by: those counted distinct and the join column."""
        counted = [m.columns[0] for m in self.measures if m.kind == "count_distinct" and m.columns[0] != self._unique_key]
        return list(dict.fromkeys([*counted, *([self.fact_join] if self.dimension is not None else [])]))

    @property
    def _unique_key(self) -> str | None:
        """The fact's key, unless a cast may have made equal values of different ones."""
        return None if self.fact_key in dict(self.casts) else self.fact_key

    def _cast(self, df: DataFrame, side: str) -> DataFrame:
        wanted = {c: t for c, t in self.casts if c in self._columns_of(side)}
        return df.withColumns({c: F.col(c).cast(t) for c, t in wanted.items() if c in df.columns})

    def _columns_of(self, side: str) -> set[str]:
        own = {g.column for g in self.groups if g.of == side}
        if side == "fact":
            own |= {c for m in self.measures for c in m.columns}
        return own

    @staticmethod
    def group_column(group: Group, df: DataFrame) -> Column:
        """A grouping column over the fact or the dimension."""
        column = F.col(group.column)
        if group.by_day:
            column = day(column, df.schema[group.column].dataType.simpleString())
        return column.alias(group.alias)

    def _partials(self, m: Measure) -> list[Column]:
        value = F.col(m.columns[0])
        if m.kind == "count_distinct":
            return [F.count(value).alias(f"_{m.alias}")] if m.columns[0] == self._unique_key else []
        if m.kind == "sum":
            return [F.sum(value).alias(f"_{m.alias}")]
        if m.kind == "sum_product":
            return [F.sum(value * F.col(m.columns[1])).alias(f"_{m.alias}")]
        return [F.sum(value).alias(f"_{m.alias}"), F.count(value).alias(f"_{m.alias}_n")]

    def _final(self, m: Measure, single: bool) -> Column:
        if m.kind == "count_distinct":
            if m.columns[0] == self._unique_key:
                return F.sum(f"_{m.alias}").alias(m.alias)
            key = f"_k_{m.columns[0]}"
            # With one extra key the rows are unique per group and value already.
            return (F.count(key) if single else F.count_distinct(key)).alias(m.alias)
        if m.kind == "avg":
            total = F.sum(f"_{m.alias}").cast("double")
            return F.try_divide(total, F.sum(f"_{m.alias}_n")).alias(m.alias)
        return F.sum(f"_{m.alias}").alias(m.alias)

    def sql(self) -> str:
        """The same rows as Spark SQL, with plain distinct counts and days as timestamps."""
        casts = dict(self.casts)

        def source(column: str, side: str) -> str:
            name = f"{'f' if side == 'fact' else 'd'}.{column}"
            return f"CAST({name} AS {casts[column]})" if column in casts and column in self._columns_of(side) else name

        keys = [f"date_trunc('DAY', {source(g.column, g.of)})" if g.by_day else source(g.column, g.of) for g in self.groups]
        shown = [f"{key} AS {g.alias}" for key, g in zip(keys, self.groups)]
        for m in self.measures:
            first = source(m.columns[0], "fact")
            shown.append(
                {
                    "count_distinct": f"count(DISTINCT {first})",
                    "sum": f"sum({first})",
                    "avg": f"avg({first})",
                    "sum_product": f"sum({' * '.join(source(c, 'fact') for c in m.columns)})",
                }[m.kind]
                + f" AS {m.alias}"
            )
        joined = f" JOIN {self.dimension} d ON f.{self.fact_join} = d.{self.dimension_join}" if self.dimension else ""
        return f"SELECT {', '.join(shown)} FROM {self.fact} f{joined} GROUP BY {', '.join(keys)}"

    def evolve(self, change: Change) -> AggregateModel:
        """New columns do not extend an aggregate. A dropped column takes its groups and measures along,
        which changes the grain; a dropped key or join column breaks the model."""
        column = change.column.lower()
        name = change.table.lower()
        side = "fact" if self.fact.endswith("." + name) else "dimension"
        if side == "dimension" and not (self.dimension or "").endswith("." + name):
            return self
        if change.kind == COLUMN_DROP:
            needed = {self.fact_key, self.fact_join} if side == "fact" else {self.dimension_join}
            if column in needed:
                raise BreakingChange(f"{self.name} needs {column}")
            return replace(
                self,
                groups=tuple(g for g in self.groups if not (g.of == side and g.column == column)),
                measures=tuple(m for m in self.measures if not (side == "fact" and column in m.columns)),
            )
        if change.kind == TYPE_CHANGE and change.new_type and column in self._columns_of(side):
            kept = tuple(p for p in self.casts if p[0] != column)
            return replace(self, casts=(*kept, (column, change.new_type)))
        return self


Model = RowModel | AggregateModel


def evolve(models: Mapping[str, Model], changes: list[Change]) -> dict[str, Model]:
    """All models after the changes, each applied along the row from its source table down."""
    result = dict(models)
    for change in changes:
        for name, model in result.items():
            if isinstance(model, RowModel) and not model.source.endswith("." + change.table.lower()):
                continue
            result[name] = model.evolve(change)
    return result


def silver_from_columns(table: str, columns: list[str], key: str) -> RowModel:
    """Model of a new table: all its own columns, keyed by the inferred key."""
    return RowModel(
        f"silver.{table.lower()}", f"bronze.{table.lower()}", CdcSpec((key.lower(),)), tuple(c.lower() for c in columns)
    )
