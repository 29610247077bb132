"""Running models: order, full refresh, sandbox, lineage rewrite."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MODEL_ARTIFACT
from ..operators.mutate import replace_slice
from ..operators.quality import row_counts, validate
from ..session import local_rows
from ..sources.tables import Transaction, Warehouse
from .columns import source_columns
from .models import Model

ARTIFACT_SCHEMA = (
    "artifact_name string, artifact_type string, source_table string, source_columns array<string>, "
    "artifact_sql string, file_path string, output_fqn string"
)


def run_order(models: Mapping[str, Model]) -> list[str]:
    """Names with every model after its inputs."""
    done: list[str] = []

    def visit(name: str, trail: tuple[str, ...]) -> None:
        if name in done or name not in models:
            return
        if name in trail:
            raise ValueError(f"models depend on each other: {' -> '.join((*trail, name))}")
        for upstream in models[name].inputs:
            visit(upstream, (*trail, name))
        done.append(name)

    for name in models:
        visit(name, ())
    return done


def downstream_of(models: Mapping[str, Model], sources: Iterable[str]) -> list[str]:
    """Models fed by any of the source tables, in run order."""
    fed = set(sources)
    chosen = []
    for name in run_order(models):
        if fed & set(models[name].inputs):
            fed.add(name)
            chosen.append(name)
    return chosen


def build_all(models: Mapping[str, Model], sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All models as plans over the sources, nothing written."""
    tables = dict(sources)
    for name in run_order(models):
        tables[name] = models[name].build(tables)
    return tables


def materialize(spark: SparkSession, models: Mapping[str, Model], sources: Mapping[str, DataFrame], out: Warehouse | Transaction,
                only: Iterable[str] | None = None) -> DataFrame:
    """Full refresh into `out`: each model reads its inputs as written. Returns rows per model. All models change
    together, by one commit; if one fails, nothing has changed. In a transaction its commit decides."""
    chosen = run_order(models) if only is None else [n for n in run_order(models) if n in set(only)]
    tables = dict(sources)
    tx = out.begin(spark)
    for name in run_order(models):
        if name in chosen:
            tables[name] = spark.read.parquet(tx.write(spark, name, models[name].build(tables)))
        elif tx.exists(spark, name):
            tables[name] = tx.read(spark, name)
    if tx is not out:
        tx.commit(spark)
    return row_counts({n: tables[n] for n in chosen})


def sandbox_run(spark: SparkSession, models: Mapping[str, Model], sources: Mapping[str, DataFrame],
                sandbox: Warehouse, changed: Iterable[str] | None = None,
                production: Warehouse | None = None) -> DataFrame:
    """Run the models (those below the `changed` sources, if given) into a sandbox and give each a verdict.
    Models left out are read from production, if they are there; production is never written."""
    chosen = run_order(models) if changed is None else downstream_of(models, changed)
    tables = dict(sources)
    for name in run_order(models):
        if name in chosen:
            continue
        if production is not None and production.exists(spark, name):
            tables[name] = production.read(spark, name)
        else:
            tables[name] = models[name].build(tables)

    def attempt(name: str):
        def build() -> DataFrame:
            sandbox.write(spark, name, models[name].build(tables))
            tables[name] = sandbox.read(spark, name)
            return tables[name]

        return build

    return validate(spark, {name: _missing_input_is_failure(attempt(name), models[name], tables) for name in chosen})


def _missing_input_is_failure(build, model: Model, tables: Mapping[str, DataFrame]):
    def checked() -> DataFrame:
        missing = [i for i in model.inputs if i not in tables]
        if missing:
            raise ValueError(f"inputs not built: {', '.join(missing)}")
        return build()

    return checked


def column_docs(spark: SparkSession, docs: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Column documentation as rows (model without its layer, column, description, tests)."""
    rows = [(m.split(".")[-1], c.upper(), text, []) for m, columns in docs.items() for c, text in columns.items()]
    return local_rows(spark, rows, "model string, column_name string, description string, tests array<string>")


def model_edges(spark: SparkSession, models: Mapping[str, Model], database: str) -> DataFrame:
    """Lineage edges of the models with the columns that each reads of its source, and the text of each model."""
    rows = [
        (
            name, MODEL_ARTIFACT, source.upper(), source_columns(model, source), model.sql(), f"models/{name.replace('.', '/')}.sql",
            f"{database}.{name.upper()}",
        )
        for name, model in models.items()
        for source in model.inputs
    ]
    return local_rows(spark, rows, ARTIFACT_SCHEMA)


def refresh_lineage(registry: DataFrame, edges: DataFrame, production: bool) -> DataFrame:
    """The artifact registry with the models' edges rewritten; unchanged outside production or when there is
    nothing to write."""
    return replace_slice(registry, edges, F.col("artifact_type") == MODEL_ARTIFACT, active=production)
