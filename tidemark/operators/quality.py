"""Data tests, candidate checks and run logs."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CLEAN_RUN_MARK, FAIL_MARKS, MODEL_LAYERS, PASS_MARKS, PENDING
from ..functions.columns import any_of, is_true, strip
from ..functions.text import compile_model
from ..session import cut, local_rows, scratch_dir
from ..sources.tables import folders


@dataclass(frozen=True)
class Relationship:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class ModelTests:
    """Declared tests of one model; a `unique` entry may name several columns."""

    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    relationships: tuple[Relationship, ...] = field(default=())


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys (no NULL in them) that occur more than once."""
    filled = df
    for key in keys:
        filled = filled.filter(F.col(key).isNotNull())
    return filled.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row, one scan: NULLs per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def orphan_counts(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values of a foreign key that the parent lacks, with the number of child rows. The child is counted per
    value first, so a hot value is one row when it meets the parent."""
    values = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("child_rows")
    )
    return values.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def test_report(tables: Mapping[str, DataFrame], tests: Mapping[str, ModelTests]) -> DataFrame:
    """All declared tests as rows (model, column_name, test, failures)."""
    parts: list[DataFrame] = []

    def row(df: DataFrame, model: str, column: str, test: str, failures: Column) -> DataFrame:
        return df.agg(failures.cast("bigint").alias("failures")).select(
            F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test"), "failures"
        )

    for model, declared in tests.items():
        df = tables[model]
        for keys in declared.unique:
            parts.append(row(duplicate_keys(df, list(keys)), model, ",".join(keys), "unique", F.count(F.lit(1))))
        if declared.not_null:
            wide = null_counts(df, list(declared.not_null))
            pairs = ", ".join(f"'{c}', `{c}`" for c in declared.not_null)
            tall = wide.selectExpr(f"stack({len(declared.not_null)}, {pairs}) AS (column_name, failures)")
            parts.append(
                tall.select(F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test"), "failures")
            )
        for r in declared.relationships:
            orphans = orphan_counts(df, r.column, tables[r.parent], r.parent_column)
            parts.append(
                row(orphans, model, r.column, "relationships", F.coalesce(F.sum("child_rows"), F.lit(0)))
            )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("model"), "row_count")
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


VERDICT_SCHEMA = "model string, test_status string, row_count long, test_error string"


def validate(spark: SparkSession, candidates: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """PASS with the row count, or FAIL with the whole error, for each candidate; one that fails in any way does not
    stop the others."""
    return local_rows(spark, [verdict(name, build) for name, build in candidates.items()], VERDICT_SCHEMA)


def verdict(name: str, build: Callable[[], DataFrame]) -> tuple[str, str, int | None, str | None]:
    try:
        return name, "PASS", build().count(), None
    except Exception as error:  # whatever a candidate raises is its verdict
        return name, "FAIL", None, str(error)


def validate_sql(spark: SparkSession, texts: Mapping[str, str]) -> DataFrame:
    """The same for queries given as text."""
    return validate(spark, {name: (lambda t=text: spark.sql(t)) for name, text in texts.items()})


def _contains_any(text: Column, marks: tuple[str, ...]) -> Column:
    return any_of([text.contains(m) for m in marks])


def _told() -> Column:
    """A log line without its frame."""
    return strip(F.ltrim(strip(F.col("line")), F.lit("|")))


def run_log_results(log: DataFrame) -> DataFrame:
    """Model results from log lines (line_no, line): the last line that names a model decides."""
    status = F.when(_contains_any(F.col("detail"), PASS_MARKS), "PASS").when(
        _contains_any(F.col("detail"), FAIL_MARKS), "FAIL"
    )

    def named(layer: str) -> Column:
        """The word behind the last `LAYER.`"""
        rest = F.substring_index(F.col("upper"), layer + ".", -1)
        word = F.nullif(F.regexp_extract(rest, r"^\s*(\S+)", 1), F.lit(""))
        return F.when(F.col("upper").contains(layer + "."), F.concat(F.lit(layer.lower() + "."), F.lower(word)))

    told = log.select("line_no", _told().alias("detail")).select("line_no", "detail", F.upper("detail").alias("upper"))
    return (
        told.select(
            "line_no", "detail", status.alias("status"),
            F.explode(F.array_compact(F.array(*[named(layer) for layer in MODEL_LAYERS]))).alias("model"),
        )
        .filter(F.col("status").isNotNull())
        .groupBy("model")
        .agg(F.max_by(F.struct("status", "detail"), "line_no").alias("last"))
        .select("model", F.col("last.status").alias("status"), F.col("last.detail").alias("detail"))
    )


def run_verdict(log: DataFrame, exit_code: int) -> DataFrame:
    """One row: did the whole run pass?"""
    clean = F.coalesce(F.max(F.col("line").contains(CLEAN_RUN_MARK)), F.lit(False))
    return log.agg((clean & F.lit(exit_code == 0)).alias("passed"))


def model_status(artifacts: DataFrame, log: DataFrame, exit_code: int) -> DataFrame:
    """Per artifact (column `model`) its own result, else the result of the whole run with the last failing line of its
    log, if it failed."""
    passed = run_verdict(log, exit_code).scalar()
    failing = log.filter(_contains_any(F.col("line"), FAIL_MARKS))
    last = F.when(~passed, failing.agg(F.max_by(_told(), "line_no")).scalar())
    own = F.col("status").isNotNull()
    return artifacts.join(run_log_results(log), "model", "left").select(
        "model", F.coalesce("status", F.when(passed, "PASS").otherwise("FAIL")).alias("test_status"),
        F.coalesce(F.when(own, F.col("detail")).otherwise(last), F.lit("")).alias("test_error"),
    )


#: Distinct candidate texts whose verdicts the driver holds at a time, and how many of them run at a time.
PAGE, AT_A_TIME = 256, 4


def check_candidates(spark: SparkSession, code: DataFrame, tables: Mapping[str, DataFrame], database: str, page: int = PAGE) -> DataFrame:
    """Stored candidates (event_id, artifact_name, generated_sql, test_status, test_error, ...) after a check of those
    that are PENDING: compiled, run over `tables` (by `layer.name`), and given a verdict and the whole error.

    Equal texts have one verdict. The distinct texts are stored in pages by their hash; the driver takes a page (about
    `page` texts), runs them, some at a time, and stores the verdicts, so it never holds more. An empty text fails. A
    candidate that has a verdict keeps it.
    """
    names = {f"{database}.{name.upper()}": f"candidate_{uuid.uuid4().hex}" for name in tables}
    for df, view in zip(tables.values(), names.values()):
        df.createOrReplaceTempView(view)
    pending = F.col("test_status") == PENDING
    text = F.coalesce(compile_model(F.col("generated_sql"), database), F.lit(""))
    texts = cut(code.filter(pending).select(text.alias("_text")).distinct(), "candidate-texts")
    pages = max(1, -(-texts.count() // page))
    folder = scratch_dir(spark, "candidate-pages")
    number = F.pmod(F.xxhash64("_text"), F.lit(pages)).alias("page")
    texts.select("_text", number).repartition("page").write.partitionBy("page").parquet(folder)

    def runs(text: str) -> Callable[[], DataFrame]:
        for name in sorted(names, key=len, reverse=True):
            text = re.sub(rf"(?<![\w.]){re.escape(name)}(?!\w)", names[name], text)
        return lambda: spark.sql(text)

    verdicts = scratch_dir(spark, "candidate-verdicts")
    kinds = "_text string, _status string, _error string"
    try:
        with ThreadPoolExecutor(AT_A_TIME) as pool:
            for at, path in sorted(folders(spark, folder, "page").items()):
                own = [r["_text"] for r in spark.read.schema("_text string").parquet(path).collect()]
                found = pool.map(inheritable_thread_target(spark)(lambda t: verdict(t, runs(t))), own)
                local_rows(spark, [(t, status, error) for t, status, _, error in found], kinds).write.parquet(f"{verdicts}/page={at}")
    finally:
        for view in names.values():
            spark.catalog.dropTempView(view)
    done = folders(spark, verdicts, "page")
    told = spark.read.schema(kinds).parquet(*done.values()) if done else local_rows(spark, [], kinds)
    # Only candidates that wait travel to the join; many of one text are split there.
    joined = code.filter(is_true(pending)).withColumn("_own", text).join(told, F.col("_own") == F.col("_text"), "left")
    new = {"test_status": F.col("_status"), "test_error": F.col("_error")}
    checked = joined.select(*[new.get(c, F.col(c)).alias(c) for c in code.columns])
    return code.filter(~is_true(pending)).unionByName(checked)

