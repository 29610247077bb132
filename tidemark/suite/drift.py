"""Drift detection, the baseline, and what a new table needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift, newtable, registry
from ..plans.models import silver_from_columns
from ..session import cut
from ..sources.tables import schema_columns
from . import roles
from .base import query, table
from .roles import BUSINESS_SQL, CATALOG, CATALOG_EVENTS, EARLY_CATALOG, REGISTRY

# The driver's tables with the types Spark gives their columns.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _schema_sql() -> str:
    rows = [
        f"SELECT '{name.upper()}' AS table_name, '{column.upper()}' AS column_name, '{kind}' AS data_type, "
        f"{place} AS ordinal_position, count({column}) AS filled_rows FROM {name}"
        for name, columns in DRIVER_SCHEMAS.items()
        for place, (column, kind) in enumerate((c.split(" ") for c in columns.split(", ")), start=1)
    ]
    return "SELECT 'BRONZE' AS table_schema, * FROM (" + " UNION ALL ".join(rows) + ")"


@query("schema_columns", _schema_sql())
def schema_columns_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of all given tables, and how many rows fill each."""
    tables = {name: table(spark, sf, name) for name in DRIVER_SCHEMAS}
    counts = None
    for name, df in tables.items():
        wide = df.agg(*[F.count(c).alias(c) for c in df.columns])
        pairs = ", ".join(f"'{c.upper()}', `{c}`" for c in df.columns)
        tall = wide.selectExpr(f"'{name.upper()}' AS table_name",
                               f"stack({len(df.columns)}, {pairs}) AS (column_name, filled_rows)")
        counts = tall if counts is None else counts.unionByName(tall)
    return schema_columns(spark, tables).join(counts, ["table_name", "column_name"])


_NAME = "table_schema, table_name, column_name"
_SAME = "{a}.table_schema = {b}.table_schema AND {a}.table_name = {b}.table_name"
_SAME_COLUMN = _SAME + " AND {a}.column_name = {b}.column_name"


def _no_live(kind: str, column: str | None) -> str:
    same_column = f"AND e.column_name = {column}" if column else ""
    return f"""NOT EXISTS (SELECT 1 FROM {CATALOG_EVENTS} e WHERE {_SAME.format(a='e', b='c')} {same_column}
        AND e.change_type = '{kind}' AND e.status IN ('PENDING', 'IN_PROGRESS'))"""


_NEW_COLUMN_SQL = f"""SELECT c.table_schema, c.table_name, c.column_name, 'NEW_COLUMN' AS change_type,
        CAST(NULL AS VARCHAR) AS old_data_type, c.data_type AS new_data_type
    FROM {CATALOG} c LEFT JOIN {REGISTRY} r ON {_SAME_COLUMN.format(a='c', b='r')}
    WHERE c.table_schema = 'BRONZE' AND NOT contains(c.table_name, '_JOURNAL_') AND r.column_name IS NULL
        AND {BUSINESS_SQL.replace('column_name', 'c.column_name')}
        AND NOT ends_with(c.column_name, '__SNOWFLAKE_DELETED')
        AND EXISTS (SELECT 1 FROM {REGISTRY} t WHERE {_SAME.format(a='t', b='c')})
        AND {_no_live('NEW_COLUMN', 'c.column_name')}"""
_STRIPPED = "replace(c.column_name, '__SNOWFLAKE_DELETED', '')"
_DROP_SQL = f"""SELECT c.table_schema, c.table_name, {_STRIPPED} AS column_name, 'COLUMN_DROP' AS change_type,
        r.data_type AS old_data_type, CAST(NULL AS VARCHAR) AS new_data_type
    FROM {CATALOG} c JOIN {REGISTRY} r ON {_SAME.format(a='c', b='r')} AND r.column_name = {_STRIPPED}
    WHERE c.table_schema = 'BRONZE' AND ends_with(c.column_name, '__SNOWFLAKE_DELETED')
        AND {_no_live('COLUMN_DROP', _STRIPPED)}"""
_TYPE_SQL = f"""SELECT c.table_schema, c.table_name, c.column_name, 'TYPE_CHANGE' AS change_type,
        r.data_type AS old_data_type, c.data_type AS new_data_type
    FROM {CATALOG} c JOIN {REGISTRY} r ON {_SAME_COLUMN.format(a='c', b='r')}
    WHERE c.table_schema = 'BRONZE' AND c.data_type <> r.data_type AND {_no_live('TYPE_CHANGE', 'c.column_name')}"""
_TABLE_SQL = f"""SELECT c.table_schema, c.table_name, CAST(NULL AS VARCHAR) AS column_name, 'NEW_TABLE' AS change_type,
        CAST(NULL AS VARCHAR) AS old_data_type, CAST(NULL AS VARCHAR) AS new_data_type
    FROM (SELECT DISTINCT table_schema, table_name FROM {CATALOG}) c
    WHERE c.table_schema = 'BRONZE' AND NOT contains(c.table_name, '_JOURNAL_')
        AND NOT EXISTS (SELECT 1 FROM {REGISTRY} r WHERE {_SAME.format(a='r', b='c')})
        AND {_no_live('NEW_TABLE', None)}"""
DETECT_SQL = f"{_NEW_COLUMN_SQL} UNION ALL {_DROP_SQL} UNION ALL {_TYPE_SQL} UNION ALL {_TABLE_SQL}"


def _inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return roles.catalog(spark, sf), roles.registry(spark, sf), roles.catalog_events(spark, sf)


@query("drift_new_column", _NEW_COLUMN_SQL)
def drift_new_column(spark: SparkSession, sf: str) -> DataFrame:
    return drift.new_columns(*_inputs(spark, sf))


@query("drift_column_drop", _DROP_SQL)
def drift_column_drop(spark: SparkSession, sf: str) -> DataFrame:
    return drift.dropped_columns(*_inputs(spark, sf))


@query("drift_type_change", _TYPE_SQL)
def drift_type_change(spark: SparkSession, sf: str) -> DataFrame:
    return drift.changed_types(*_inputs(spark, sf))


@query("drift_new_table", _TABLE_SQL)
def drift_new_table(spark: SparkSession, sf: str) -> DataFrame:
    return drift.new_tables(*_inputs(spark, sf))


@query("drift_all", DETECT_SQL)
def drift_all(spark: SparkSession, sf: str) -> DataFrame:
    """The catalogue and the registry are derived here, so they are stored before their several uses."""
    columns, known, events = _inputs(spark, sf)
    return drift.detect(cut(columns, "catalog"), cut(known, "registry"), events)


@query(
    "seed_registry",
    f"""
    SELECT {_NAME}, data_type FROM {REGISTRY}
    UNION ALL
    SELECT {_NAME}, data_type FROM {CATALOG} c WHERE table_schema = 'BRONZE' AND {BUSINESS_SQL}
        AND NOT EXISTS (SELECT 1 FROM {REGISTRY} r WHERE {_SAME_COLUMN.format(a='r', b='c')})
    """,
)
def seed_registry(spark: SparkSession, sf: str) -> DataFrame:
    return registry.seed_registry(roles.registry(spark, sf), roles.catalog(spark, sf))


@query("registry_col_counts", f"SELECT table_name, count(*) AS col_count FROM {REGISTRY} GROUP BY table_name")
def registry_col_counts(spark: SparkSession, sf: str) -> DataFrame:
    return registry.column_counts(roles.registry(spark, sf))


_BASELINED = """NOT (starts_with(column_name, '_SNOWFLAKE_') OR starts_with(column_name, 'PAYLOAD__')
    OR starts_with(column_name, 'PRIMARY_KEY__'))"""
_APPLIED_EVENTS = roles.CATALOG_EVENTS
ADVANCE_SQL = f"""
    WITH ev AS MATERIALIZED (SELECT * FROM {_APPLIED_EVENTS}),
    steps AS (
        SELECT {_NAME}, change_type, new_data_type AS data_type, detected_at, event_id FROM ev WHERE change_type <> 'NEW_TABLE'
        UNION ALL
        SELECT c.table_schema, c.table_name, c.column_name, 'NEW_COLUMN', c.data_type, e.detected_at, e.event_id
        FROM ev e JOIN {CATALOG} c ON {_SAME.format(a='e', b='c')}
        WHERE e.change_type = 'NEW_TABLE' AND {_BASELINED.replace('column_name', 'c.column_name')}),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY {_NAME} ORDER BY detected_at, event_id) AS n FROM steps),
    marked AS (SELECT *, COALESCE(max(CASE WHEN change_type = 'COLUMN_DROP' THEN n END) OVER (PARTITION BY {_NAME}), 0)
        AS dropped FROM numbered),
    facts AS (SELECT {_NAME}, max(dropped) AS dropped,
        min(CASE WHEN change_type = 'NEW_COLUMN' AND n > dropped THEN n END) AS added,
        arg_min(data_type, n) FILTER (change_type = 'NEW_COLUMN' AND n > dropped) AS added_type,
        max(CASE WHEN change_type = 'TYPE_CHANGE' AND n > dropped THEN n END) AS retyped_at,
        arg_max(data_type, n) FILTER (change_type = 'TYPE_CHANGE' AND n > dropped) AS retyped
        FROM marked GROUP BY {_NAME}),
    joined AS (SELECT COALESCE(r.table_schema, f.table_schema) AS table_schema,
        COALESCE(r.table_name, f.table_name) AS table_name, COALESCE(r.column_name, f.column_name) AS column_name,
        (r.column_name IS NOT NULL AND COALESCE(f.dropped, 0) = 0) AS held, r.data_type AS held_type, f.added,
        f.added_type, f.retyped_at, f.retyped
        FROM {REGISTRY} r FULL JOIN facts f ON {_SAME_COLUMN.format(a='r', b='f')})
    SELECT {_NAME}, CASE WHEN retyped_at IS NOT NULL AND (held OR retyped_at > added) THEN retyped
        WHEN held THEN held_type ELSE added_type END AS data_type
    FROM joined WHERE held OR added IS NOT NULL
    """


@query("advance_registry", ADVANCE_SQL)
def advance_registry(spark: SparkSession, sf: str) -> DataFrame:
    """The baseline after every sighting and every table was resolved as an event."""
    return registry.advance_registry(roles.registry(spark, sf), roles.catalog_events(spark, sf), roles.catalog(spark, sf))


KEY_SQL = f"""SELECT table_schema, table_name, COALESCE(
        arg_min(column_name, ordinal_position) FILTER (ends_with(lower(column_name), '_id')),
        arg_min(column_name, ordinal_position)) AS primary_key
    FROM {CATALOG} WHERE {BUSINESS_SQL} GROUP BY table_schema, table_name"""


@query("infer_primary_key", KEY_SQL)
def infer_primary_key(spark: SparkSession, sf: str) -> DataFrame:
    return newtable.infer_primary_key(roles.catalog(spark, sf))


SPEC_SQL = f"""SELECT c.table_schema, c.table_name, 'models/silver/' || lower(c.table_name) || '.sql' AS silver_model_path,
        k.primary_key, c.ordinal_position, c.column_name, c.data_type
    FROM {CATALOG} c JOIN ({KEY_SQL}) k ON {_SAME.format(a='c', b='k')}
    WHERE {BUSINESS_SQL.replace('column_name', 'c.column_name')}"""


@query("new_table_spec", SPEC_SQL)
def new_table_spec(spark: SparkSession, sf: str) -> DataFrame:
    return newtable.new_table_spec(roles.catalog(spark, sf))


@query(
    "new_table_silver",
    """
    SELECT conv_id, role, text FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS FIRST) AS rn
        FROM conversations WHERE role <> 'system')
    WHERE rn = 1
    """,
)
def new_table_silver(spark: SparkSession, sf: str) -> DataFrame:
    """A table nobody declared: key and columns come from its schema."""
    landed = table(spark, sf, "conversations").select(
        "conv_id", "role", "text", F.col("turn").alias("_snowflake_updated_at"),
        (F.col("role") == "system").alias("_snowflake_deleted"),
    )
    columns = schema_columns(spark, {"conversations": landed})
    key = newtable.infer_primary_key(columns).first()["primary_key"]
    own = [r["column_name"] for r in registry.business_columns(columns).select("column_name").collect()]
    ordered = [c for c in landed.columns if c.upper() in own]
    return silver_from_columns("conversations", ordered, key).build({"bronze.conversations": landed})


_DOCS = f"""(SELECT lower(table_name) AS model, column_name, 'Column ' || column_name AS description, ['not_null'] AS tests
    FROM {REGISTRY})"""


@query(
    "docs_sync",
    f"""
    WITH last AS (SELECT lower(table_name) AS m, upper(column_name) AS k,
            arg_max(change_type, row(detected_at, event_id)) AS change_type,
            arg_max(table_name, row(detected_at, event_id)) AS table_name,
            bool_or(change_type = 'COLUMN_DROP') AS was_dropped
        FROM {roles.COLUMN_EVENTS} WHERE change_type IN ('NEW_COLUMN', 'COLUMN_DROP') GROUP BY 1, 2),
    docs AS (SELECT * FROM {_DOCS})
    SELECT model, column_name, description, array_to_string(tests, ',') AS tests FROM docs d
    WHERE NOT EXISTS (SELECT 1 FROM last WHERE m = lower(d.model) AND k = upper(d.column_name) AND was_dropped)
    UNION ALL
    SELECT m, k, 'Column added to ' || table_name || ' by schema drift; review/extend tests as needed.', ''
    FROM last WHERE change_type = 'NEW_COLUMN' AND m IN (SELECT lower(model) FROM docs)
        AND (was_dropped OR NOT EXISTS (SELECT 1 FROM docs d WHERE lower(d.model) = m AND upper(d.column_name) = k))
    """,
)
def docs_sync(spark: SparkSession, sf: str) -> DataFrame:
    docs = roles.registry(spark, sf).select(
        F.lower("table_name").alias("model"),
        "column_name",
        F.concat(F.lit("Column "), F.col("column_name")).alias("description"),
        F.array(F.lit("not_null")).alias("tests"),
    )
    synced = newtable.sync_docs(docs, roles.column_events(spark, sf))
    return synced.withColumn("tests", F.array_join("tests", ","))


@query(
    "docs_missing",
    f"""
    WITH docs AS (SELECT lower(table_name) AS model, upper(column_name) AS column_name FROM {REGISTRY})
    SELECT lower(table_name) AS model, upper(column_name) AS column_name FROM {CATALOG} c
    WHERE lower(table_name) IN (SELECT model FROM docs) AND NOT EXISTS (SELECT 1 FROM docs d
        WHERE d.model = lower(c.table_name) AND d.column_name = upper(c.column_name))
    """,
)
def docs_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Present columns without documentation, where the baseline is what was documented."""
    docs = roles.registry(spark, sf).select(F.col("table_name").alias("model"), "column_name")
    return newtable.undocumented(roles.catalog(spark, sf), docs)


@query(
    "declare_source",
    f"""
    WITH declared AS (SELECT DISTINCT 'bronze' AS source, table_name FROM {REGISTRY})
    SELECT source, table_name FROM declared
    UNION ALL
    SELECT 'bronze', t FROM (SELECT DISTINCT lower(table_name) AS t FROM {roles.TABLE_EVENTS})
    WHERE t NOT IN (SELECT lower(table_name) FROM declared)
    """,
)
def declare_source(spark: SparkSession, sf: str) -> DataFrame:
    declared = (
        drift.known_tables(roles.registry(spark, sf)).select(F.lit("bronze").alias("source"), "table_name").distinct()
    )
    return newtable.declare_sources(declared, roles.table_events(spark, sf))


@query(
    "registry_as_of",
    f"SELECT {_NAME}, data_type FROM {EARLY_CATALOG} WHERE table_schema = 'BRONZE' AND {BUSINESS_SQL}",
)
def registry_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """What a seed on BASELINE_DAY would have registered, markers included."""
    return registry.business_columns(roles.early_catalog(spark, sf))
