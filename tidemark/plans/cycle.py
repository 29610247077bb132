"""One round of keeping tables in step with their sources: check, prepare, review, merge.

The control tables live in the warehouse's CONFIG layer, and nothing is kept in memory: events are a log of their
states, accepted changes a journal from which the present models follow. Only single rows (the head of the queue, one
event), the journal and the names of models come to the driver. Every step is one transaction of the warehouse.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..constants import CI_FAILED, CI_PASSED, GENERATED, GENERATING, NEW_TABLE, PENDING, PR_OPEN, RESOLVED
from ..functions.columns import branch_of
from ..operators.drift import COLUMN, detect
from ..operators.events import (
    EVENT_SCHEMA,
    event_by_id,
    new_events,
    next_pending,
    reconcile_reviews,
    resolved,
    review_states,
    unresolved_of_branch,
)
from ..operators.lineage import impact
from ..operators.mutate import append, replace_slice, update_where, with_defaults
from ..operators.newtable import declare_sources, infer_primary_key, sync_docs
from ..operators.registry import advance_registry, business_columns, seed_registry
from ..session import local_rows, scratch_dir
from ..sources.tables import KeyedLog, Transaction, Warehouse, schema_columns
from ..streaming.jobs import stream_drift
from .models import BreakingChange, Change, Model, evolve, silver_from_columns
from .run import ARTIFACT_SCHEMA, column_docs, downstream_of, materialize, model_edges, refresh_lineage, sandbox_run

REGISTRY, EVENTS, ARTIFACTS, CODE, DOCS, SOURCES, CHANGES = (
    "config.schema_registry", "config.schema_change_events", "config.artifact_registry", "config.generated_code",
    "config.column_docs", "config.sources", "config.model_changes",
)
REGISTRY_SCHEMA = "table_schema string, table_name string, column_name string, data_type string, registered_at timestamp_ntz"
ARTIFACTS_SCHEMA = ARTIFACT_SCHEMA + ", artifact_id string, updated_at timestamp_ntz"
CODE_SCHEMA = (
    "event_id string, artifact_name string, file_path string, action string, generated_sql string, "
    "test_status string, test_error string, generated_at timestamp_ntz"
)
DOCS_SCHEMA = "model string, column_name string, description string, tests array<string>"
SOURCES_SCHEMA = "source string, table_name string"
CHANGES_SCHEMA = (
    "place int, change_type string, table_name string, column_name string, new_data_type string, "
    "columns array<string>, primary_key string"
)


@dataclass
class Cycle:
    """A warehouse, the models it started with, and their documentation. Bronze tables are given by `bronze.<name>`."""

    spark: SparkSession
    warehouse: Warehouse | Transaction
    models: dict[str, Model]
    database: str
    docs: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def table(self, name: str, schema: str) -> DataFrame:
        if self.warehouse.exists(self.spark, name):
            return self.warehouse.read(self.spark, name)
        return local_rows(self.spark, [], schema)

    def save(self, name: str, df: DataFrame) -> None:
        self.warehouse.write(self.spark, name, df)

    def events(self) -> DataFrame:
        """Every event in its newest state."""
        return self.event_log.newest(self.spark)

    def columns(self, bronze: Mapping[str, DataFrame]) -> DataFrame:
        return schema_columns(self.spark, {name.split(".", 1)[1]: df for name, df in bronze.items()})

    def current(self) -> dict[str, Model]:
        """The models with all accepted changes."""
        models = dict(self.models)
        for change in self.table(CHANGES, CHANGES_SCHEMA).orderBy("place").collect():
            models = _changed(models, change)
        return models

    def set_up(self, bronze: Mapping[str, DataFrame], now: Column | None = None) -> DataFrame:
        """Register the present schema, write lineage, documentation and sources, and run all models; one commit."""
        now = F.current_timestamp() if now is None else now
        return self.warehouse.attempt(self.spark, lambda tx: self.within(tx)._set_up(bronze, now))

    def _set_up(self, bronze: Mapping[str, DataFrame], now: Column) -> DataFrame:
        models = self.current()
        self._register(seed_registry(self.table(REGISTRY, REGISTRY_SCHEMA), self.columns(bronze)), now)
        if not self.warehouse.exists(self.spark, DOCS):
            self.save(DOCS, column_docs(self.spark, self.docs))
        landed = [("bronze", name.split(".", 1)[1]) for name in bronze]
        if not self.warehouse.exists(self.spark, SOURCES):
            self.save(SOURCES, local_rows(self.spark, landed, SOURCES_SCHEMA))
        self._write_lineage(models, now)
        return materialize(self.spark, models, bronze, self.warehouse)

    def check(self, bronze: Mapping[str, DataFrame], now: Column) -> DataFrame:
        """Look for drift and queue what is new. Two checks at a time queue a finding once."""

        def look(tx: Transaction) -> None:
            mine = self.within(tx)
            found = detect(mine.columns(bronze), mine.table(REGISTRY, REGISTRY_SCHEMA), mine.events())
            mine._record(new_events(found, now, [*COLUMN, "change_type", "old_data_type", "new_data_type"]), alone=True)

        self.warehouse.attempt(self.spark, look)
        return self.events()

    def follow(self, seen: DataFrame, checkpoint: str, latest: Callable[[DataFrame], DataFrame], **options: object) -> StreamingQuery:
        """Check columns as they are seen, each batch against the baseline and the events of that moment; see `stream_drift`."""

        def registered(tx: Transaction) -> DataFrame:
            return self.within(tx).table(REGISTRY, REGISTRY_SCHEMA)

        return stream_drift(seen, registered, None, self.event_log, checkpoint, latest, **options)

    def prepare_next(self, bronze: Mapping[str, DataFrame], now: Column) -> str | None:
        """Take the oldest pending event: change the models, run them in a sandbox, record code and result.
        Returns the event's id, or None if nothing is pending. Of two workers that take one event the second has a `Conflict`."""
        head = next_pending(self.events()).collect()
        if not head:
            return None
        event, current = head[0], self.current()
        self._move(event.event_id, {"pipeline_status": F.lit(GENERATING)})
        try:
            models = _changed(current, self._change(event, bronze))
        except BreakingChange as error:
            self._move(event.event_id, {"pipeline_status": F.lit(CI_FAILED), "test_output": F.lit(str(error))})
            return event.event_id
        touched = self._touched(event, models)
        code = self._code_rows(event, current, models, touched, now)
        self._write_code(event.event_id, lambda _: code, keep_if_empty=False)
        listed = F.array(
            *[
                F.struct(
                    F.lit(name).alias("artifact_name"), F.lit(_path(name)).alias("file_path"),
                    F.lit(_action(name, current)).alias("action"),
                )
                for name in touched
            ]
        ).cast("array<struct<artifact_name: string, file_path: string, action: string>>")
        self._move(event.event_id, {"pipeline_status": F.lit(GENERATED), "generated_changes": listed})
        self._move(
            event.event_id,
            {"pipeline_status": F.lit(PR_OPEN), "branch_name": branch_of(F.col("event_id"))},
        )
        sandbox = Warehouse(scratch_dir(self.spark, "sandbox"), env="DEV")
        verdicts = sandbox_run(
            self.spark, models, bronze, sandbox, changed=[f"bronze.{event.table_name.lower()}"], production=self.warehouse,
        )
        results = verdicts.select(F.col("model").alias("artifact_name"), "test_status", "test_error")
        self._write_code(
            event.event_id, lambda mine: mine.drop("test_status", "test_error").join(results, "artifact_name", "left").select(*mine.columns)
        )
        failed = not verdicts.filter(F.col("test_status") == "FAIL").isEmpty()
        self._move(event.event_id, {"pipeline_status": F.lit(CI_FAILED if failed else CI_PASSED), "status": F.lit(PENDING)})
        return event.event_id

    def merge(self, event_id: str, bronze: Mapping[str, DataFrame], now: Column) -> DataFrame | None:
        """Accept an event: the present models change for good, the tables below the source are rebuilt, the baseline
        moves on and the event is closed.

        All of it is one commit. An error at any step (a change that breaks a model, a rebuild that fails, a lost
        driver) leaves every table as it was, and the merge can be run again; so can one that meets the merge of
        another event, which it then sees. An unknown or resolved id changes nothing.
        """
        return self.warehouse.attempt(self.spark, lambda tx: self.within(tx)._merge(event_id, bronze, now))

    def _merge(self, event_id: str, bronze: Mapping[str, DataFrame], now: Column) -> DataFrame | None:
        chosen = event_by_id(self.events(), event_id).filter(F.col("pipeline_status") != RESOLVED)
        rows = chosen.collect()
        if not rows:
            return None
        change = self._change(rows[0], bronze)
        journal = self.table(CHANGES, CHANGES_SCHEMA)
        models = _changed(self.current(), change)
        below = downstream_of(models, [f"bronze.{rows[0].table_name.lower()}"])
        counts = materialize(self.spark, models, bronze, self.warehouse, only=below) if below else None
        columns = self.columns(bronze)
        self._register(advance_registry(self.table(REGISTRY, REGISTRY_SCHEMA), chosen, columns), now)
        self.save(DOCS, sync_docs(self.table(DOCS, DOCS_SCHEMA), chosen))
        self.save(SOURCES, declare_sources(self.table(SOURCES, SOURCES_SCHEMA), chosen))
        place = journal.count() + 1
        self.save(CHANGES, append(journal, local_rows(self.spark, [(place, *change[1:])], CHANGES_SCHEMA)))
        self._write_lineage(models, now)
        self._record(resolved(chosen, F.lit(True), now))
        return counts

    def merge_branch(self, branch: str, bronze: Mapping[str, DataFrame], now: Column) -> list[str]:
        """Accept every unresolved event of a branch, oldest first; returns their ids."""
        chosen = self.events().filter(unresolved_of_branch(branch)).orderBy("detected_at", "event_id")
        ids = [r["event_id"] for r in chosen.select("event_id").collect()]
        for event_id in ids:
            self.merge(event_id, bronze, now)
        return ids

    def poll(self, reviews: DataFrame, bronze: Mapping[str, DataFrame], now: Column) -> list[str]:
        """Follow the reviews: a merged one accepts all its branch's events, a closed one sends them back to the
        queue. Returns the ids of the accepted ones."""
        states = review_states(reviews)
        self.warehouse.attempt(self.spark, lambda tx: self.within(tx)._send_back(states, reviews, now))
        waiting = self._in_review()
        of_merged = waiting.join(states.filter("review_state = 'merged'"), "branch_name", "left_semi")
        branches = [r["branch_name"] for r in of_merged.groupBy("branch_name").agg(F.min("detected_at").alias("at")).orderBy("at", "branch_name").collect()]
        return [event_id for branch in branches for event_id in self.merge_branch(branch, bronze, now)]

    def _in_review(self) -> DataFrame:
        return self.events().filter((F.col("pipeline_status") != RESOLVED) & F.col("branch_name").isNotNull())

    def _send_back(self, states: DataFrame, reviews: DataFrame, now: Column) -> None:
        """Events whose review was closed return to the queue."""
        waiting = self._in_review()
        of_closed = waiting.join(states.filter("review_state = 'closed'"), "branch_name", "left_semi")
        self._record(reconcile_reviews(of_closed.select(*waiting.columns), reviews, now))

    @property
    def event_log(self) -> KeyedLog:
        return KeyedLog(self.warehouse, EVENTS, T.StructType.fromDDL(EVENT_SCHEMA), "event_id")

    def within(self, tx: Transaction) -> Cycle:
        """The same cycle inside a transaction."""
        return replace(self, warehouse=tx)

    def _record(self, changed: DataFrame, alone: bool = False) -> None:
        """Append new states of events; what is already there is not written again."""
        self.event_log.append(self.spark, changed, alone=alone)

    def _write_code(self, event_id: str, rows: Callable[[DataFrame], DataFrame], keep_if_empty: bool = True) -> None:
        """Put an event's code rows in the place of those it had; other events' rows may change meanwhile."""
        slice_ = F.col("event_id") == event_id

        def put(tx: Transaction) -> None:
            held = self.within(tx).table(CODE, CODE_SCHEMA)
            tx.write(self.spark, CODE, replace_slice(held, rows(held.filter(slice_)), slice_, keep_if_empty=keep_if_empty))

        self.warehouse.attempt(self.spark, put)

    def _move(self, event_id: str, values: Mapping[str, Column]) -> None:
        self._record(update_where(event_by_id(self.events(), event_id), F.lit(True), values))

    def _register(self, baseline: DataFrame, now: Column) -> None:
        """Store the baseline; a column keeps the time of its registration."""
        before = self.table(REGISTRY, REGISTRY_SCHEMA).select(*COLUMN, "registered_at")
        dated = baseline.select(*COLUMN, "data_type").join(before, COLUMN, "left")
        self.save(REGISTRY, with_defaults(dated, {"registered_at": now.cast("timestamp_ntz")}))

    def _write_lineage(self, models: Mapping[str, Model], now: Column) -> None:
        edges = with_defaults(
            model_edges(self.spark, models, self.database), {"updated_at": now.cast("timestamp_ntz")}, "artifact_id",
            ["artifact_name", "source_table"],
        )
        production = self.warehouse.env.upper() == "PROD"
        self.save(ARTIFACTS, refresh_lineage(self.table(ARTIFACTS, ARTIFACTS_SCHEMA), edges, production))

    def _change(self, event: Row, bronze: Mapping[str, DataFrame]) -> Row:
        """The event as a row of the journal; a new table's own columns and key are part of it."""
        names, key = None, None
        if event.change_type == NEW_TABLE:
            own = self.columns(bronze).filter(F.col("table_name") == event.table_name)
            key = infer_primary_key(own).first()["primary_key"]
            listed = {r["column_name"] for r in business_columns(own).select("column_name").collect()}
            names = [c for c in bronze[f"bronze.{event.table_name.lower()}"].columns if c.upper() in listed]
        fields = [f.name for f in T.StructType.fromDDL(CHANGES_SCHEMA)]
        return Row(*fields)(0, event.change_type, event.table_name, event.column_name, event.new_data_type, names, key)

    def _touched(self, event: Row, models: Mapping[str, Model]) -> list[str]:
        if event.change_type == NEW_TABLE:
            return [f"silver.{event.table_name.lower()}"]
        edges = self.table(ARTIFACTS, ARTIFACTS_SCHEMA)
        found = impact(event_by_id(self.events(), event.event_id), edges, self.database)
        mine = found.filter(F.col("artifact_name").isin(*models)).select("artifact_name").distinct()
        names = {r["artifact_name"] for r in mine.collect()}
        return [name for name in models if name in names]

    def _code_rows(self, event: Row, current: Mapping[str, Model], models: Mapping[str, Model], touched: list[str], now: Column) -> DataFrame:
        rows = [(event.event_id, name, _path(name), _action(name, current), models[name].sql(), PENDING) for name in touched]
        schema = "event_id string, artifact_name string, file_path string, action string, generated_sql string, test_status string"
        return local_rows(self.spark, rows, schema).select(
            "*", F.lit(None).cast("string").alias("test_error"), now.cast("timestamp_ntz").alias("generated_at")
        )


def _changed(models: Mapping[str, Model], change: Row) -> dict[str, Model]:
    """The models after one row of the journal."""
    if change.change_type != NEW_TABLE:
        return evolve(models, [Change(change.change_type, change.table_name, change.column_name, change.new_data_type)])
    model = silver_from_columns(change.table_name, change.columns, change.primary_key)
    return {**models, model.name: model}


def _action(name: str, current: Mapping[str, Model]) -> str:
    return "UPDATE" if name in current else "CREATE"


def _path(name: str) -> str:
    return f"models/{name.replace('.', '/')}.sql"
