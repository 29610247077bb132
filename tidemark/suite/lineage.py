"""Dependency edges, impact, downstream order, reachability."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lineage, newtable
from ..plans import columns
from ..session import cut
from . import roles
from .base import query, table
from .drift import KEY_SQL, SPEC_SQL
from .roles import DATABASE, EDGES, LINE_EDGES, QUEUE, REGION_EVENTS

_MODEL_EDGE = """SELECT '{layer}.{item}_' || {key} AS artifact_name, 'dbt_model' AS artifact_type,
    {source} AS source_table, CAST(NULL AS VARCHAR[]) AS source_columns,
    'SELECT ' || {key} || ' AS id' || chr(10) || 'FROM {item}' AS artifact_sql,
    'models/{layer}/{item}_' || {key} || '.sql' AS file_path, 'SHOP.{upper}.{item_upper}_' || {key} AS output_fqn
    FROM {table}"""


def _model_edge(layer: str, item: str, key: str, source: str, from_table: str) -> str:
    return _MODEL_EDGE.format(layer=layer, item=item, key=key, source=source, table=from_table, upper=layer.upper(),
                              item_upper=item.upper())


def _manifest_line(df: DataFrame, layer: str, item: str, key: str, deps: list) -> DataFrame:
    name = F.concat(F.lit(item + "_"), F.col(key).cast("string"))
    model = F.struct(
        F.concat(F.lit("model.shop."), name).alias("unique_id"),
        name.alias("name"),
        F.struct(F.lit(layer).alias("schema")).alias("config"),
        F.concat(F.lit(f"models/{layer}/"), name, F.lit(".sql")).alias("original_file_path"),
        F.concat(F.lit("SELECT "), F.col(key).cast("string"), F.lit(f" AS id\nFROM {item}")).alias("raw_code"),
        F.struct(F.array(*deps).alias("nodes")).alias("depends_on"),
    )
    return df.select(F.concat(F.lit("\t "), F.to_json(model)).alias("line"))


def manifest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The project listing as text: a JSON line per model, between lines that are not models."""
    def numbered(text: str, column: str):
        return F.concat(F.lit(text), F.col(column).cast("string"))

    noise = table(spark, sf, "supplier").select(
        F.when(F.col("s_nationkey") < 12, F.col("s_name")).otherwise(F.concat(F.lit("{not json "), "s_name")).alias("line")
    )
    parts = [
        _manifest_line(table(spark, sf, "nation"), "silver", "nation", "n_nationkey",
                       [numbered("source.shop.bronze.region_", "n_regionkey"), F.lit("macro.shop.helper")]),
        _manifest_line(table(spark, sf, "customer"), "gold", "customer", "c_custkey",
                       [numbered("model.shop.nation_", "c_nationkey"), F.lit("model.shop.unknown")]),
        _manifest_line(table(spark, sf, "orders"), "mart", "order", "o_orderkey",
                       [numbered("model.shop.customer_", "o_custkey"), F.lit("source.shop.bronze.orders")]),
    ]
    for part in parts:
        noise = noise.unionByName(part)
    return noise


@query(
    "lineage_edges",
    " UNION ALL ".join(
        [
            _model_edge("silver", "nation", "n_nationkey", "'BRONZE.REGION_' || n_regionkey", "nation"),
            _model_edge("gold", "customer", "c_custkey", "'SILVER.NATION_' || c_nationkey", "customer"),
            _model_edge("mart", "order", "o_orderkey", "'GOLD.CUSTOMER_' || o_custkey",
                        "orders WHERE o_custkey IN (SELECT c_custkey FROM customer)"),
            _model_edge("mart", "order", "o_orderkey", "'BRONZE.ORDERS'", "orders"),
        ]
    ),
)
def lineage_edges(spark: SparkSession, sf: str) -> DataFrame:
    """The listing is parsed once and stored; edges look at the models three times."""
    models = cut(lineage.parse_manifest(manifest_lines(spark, sf)), "models")
    return lineage.edges_from_models(models, DATABASE)


_WALK_SQL = f"""
    RECURSIVE e AS MATERIALIZED (SELECT * FROM {EDGES}),
    walk AS (
        SELECT 'BRONZE.' || t.table_name AS origin, e.artifact_name, e.output_fqn, e.file_path, 1 AS depth,
            'BRONZE.' || t.table_name || ' → ' || e.output_fqn AS path
        FROM {REGION_EVENTS} t JOIN e ON e.source_table = 'BRONZE.' || t.table_name
        UNION ALL
        SELECT w.origin, e.artifact_name, e.output_fqn, e.file_path, w.depth + 1, w.path || ' → ' || e.output_fqn
        FROM walk w JOIN e ON e.source_table = replace(w.output_fqn, 'SHOP.', ''))"""
_IMPACT_SQL = f"""
    WITH {_WALK_SQL}
    SELECT t.event_id, w.artifact_name, 'dbt_model' AS artifact_type, w.file_path, w.output_fqn,
        min(depth) AS depth, min(path) AS impact_path,
        any_value(t.change_type IN ('COLUMN_DROP', 'TYPE_CHANGE')) AS is_breaking
    FROM walk w JOIN {REGION_EVENTS} t ON w.origin = 'BRONZE.' || t.table_name
    GROUP BY t.event_id, w.artifact_name, w.file_path, w.output_fqn
    """


def _stored_edges(spark: SparkSession, sf: str) -> DataFrame:
    """The edges are derived here and read once per level."""
    return cut(roles.edges(spark, sf), "edges")


@query("impact_analysis", _IMPACT_SQL)
def impact_analysis(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.impact(roles.region_events(spark, sf), _stored_edges(spark, sf), DATABASE)


@query(
    "impact_with_code",
    f"""
    WITH {_WALK_SQL}, texts AS (SELECT artifact_name, min(artifact_sql) AS artifact_sql FROM e GROUP BY 1)
    SELECT DISTINCT w.artifact_name, x.artifact_sql
    FROM walk w JOIN {REGION_EVENTS} t ON w.origin = 'BRONZE.' || t.table_name JOIN texts x USING (artifact_name)
    """,
)
def impact_with_code(spark: SparkSession, sf: str) -> DataFrame:
    edges = _stored_edges(spark, sf)
    impacted = lineage.impact(roles.region_events(spark, sf), edges, DATABASE)
    return lineage.with_current_sql(impacted, edges)


@query(
    "downstream_models",
    f"WITH {_WALK_SQL} SELECT artifact_name, output_fqn, max(depth) AS run_order FROM walk GROUP BY ALL",
)
def downstream_models(spark: SparkSession, sf: str) -> DataFrame:
    origins = roles.region_events(spark, sf).select(F.concat(F.lit("BRONZE."), "table_name").alias("origin"))
    return lineage.downstream(origins, _stored_edges(spark, sf), DATABASE)


@query(
    "impact_by_column",
    f"""
    SELECT q.event_id, q.column_name, e.artifact_name FROM {QUEUE} q JOIN {LINE_EDGES} e
        ON e.source_table = 'BRONZE.' || q.table_name
    WHERE e.source_columns IS NULL OR list_contains(e.source_columns, q.column_name)
    """,
)
def impact_by_column(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.impact_by_column(roles.queue(spark, sf), roles.line_edges(spark, sf))


_COLUMN_EVENT = """'{"event":{"event_id":"' || event_id || '","table_name":"' || table_name || '","column_name":"'
    || COALESCE(column_name, '') || '","change_type":"' || change_type || '","old_type":"' || COALESCE(old_data_type, '')
    || '","new_type":"' || COALESCE(new_data_type, '') || '","is_breaking":'
    || CASE WHEN change_type IN ('COLUMN_DROP', 'TYPE_CHANGE') THEN 'true' ELSE 'false' END || '}}'"""
_ITEM = """'{"artifact_name":"' || e.artifact_name || '","artifact_type":"dbt_model","file_path":"' || e.file_path
    || '","output_fqn":"' || e.output_fqn || '","depth":1,"impact_path":"BRONZE.' || q.table_name || ' → '
    || e.output_fqn || '"}'"""


@query(
    "impact_json",
    f"""
    WITH q AS MATERIALIZED (SELECT * FROM {QUEUE})
    SELECT event_id, 'event' AS part, 0 AS place, '' AS name, {_COLUMN_EVENT} AS report
    FROM q WHERE change_type IN ('COLUMN_DROP', 'TYPE_CHANGE', 'NEW_COLUMN')
    UNION ALL
    SELECT q.event_id, 'impacted', 1, e.artifact_name, {_ITEM}
    FROM q JOIN {LINE_EDGES} e ON e.source_table = 'BRONZE.' || q.table_name
    WHERE change_type IN ('COLUMN_DROP', 'TYPE_CHANGE', 'NEW_COLUMN')
    UNION ALL
    SELECT event_id, 'event', 0, '', '{{"error":"Unknown change_type: RENAME"}}' FROM q WHERE change_type = 'RENAME'
    UNION ALL
    SELECT event_id, 'event', 0, '', '{{"event":{{"event_id":"' || event_id || '","table_name":"' || q.table_name
        || '","column_name":"","change_type":"NEW_TABLE","is_breaking":false}},"generate":'
        || '{{"action":"CREATE","silver_model_path":"models/silver/' || lower(q.table_name)
        || '.sql","sources_yml_path":"models/sources.yml","primary_key":'
        || COALESCE('"' || k.primary_key || '"', 'null') || '}}}}'
    FROM q LEFT JOIN ({KEY_SQL}) k ON k.table_name = q.table_name AND k.table_schema = 'BRONZE'
    WHERE change_type = 'NEW_TABLE'
    UNION ALL
    SELECT event_id, 'column', ordinal_position, s.column_name, '{{"name":"' || s.column_name || '","type":"' || s.data_type || '"}}'
    FROM q JOIN ({SPEC_SQL}) s ON s.table_name = q.table_name AND s.table_schema = 'BRONZE' WHERE change_type = 'NEW_TABLE'
    """,
)
def impact_json(spark: SparkSession, sf: str) -> DataFrame:
    """The newest lines are found once and stored; edges and specs are both made from them."""
    shown = [*roles.LINE_KEYS, "l_returnflag", "l_linestatus", "l_quantity"]
    lines = cut(roles.newest_lines(spark, sf).select(*shown), "newest-lines")
    events, edges = roles.queue(spark, sf), roles.as_line_edges(lines)
    specs = cut(newtable.new_table_spec(roles.as_catalog(lines)).filter("table_schema = 'BRONZE'"), "specs")
    return lineage.impact_report(events, lineage.impact(events, edges, DATABASE), specs)


@query(
    "fk_reachability",
    """
    WITH RECURSIVE links AS MATERIALIZED (
        SELECT 'region:' || n_regionkey AS src, 'nation:' || n_nationkey AS dst FROM nation
        UNION ALL SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey FROM customer
        UNION ALL SELECT 'customer:' || o_custkey, 'order:' || o_orderkey FROM orders
        UNION ALL SELECT DISTINCT 'order:' || l_orderkey, 'part:' || l_partkey FROM lineitem
        UNION ALL SELECT 'nation:' || s_nationkey, 'supplier:' || s_suppkey FROM supplier),
    walk AS (SELECT DISTINCT src AS node, 0 AS depth FROM links WHERE starts_with(src, 'region:')
        UNION SELECT dst, depth + 1 FROM walk JOIN links ON src = node)
    SELECT node, min(depth) AS depth FROM walk GROUP BY node
    """,
)
def fk_reachability(spark: SparkSession, sf: str) -> DataFrame:
    """What can be reached from the regions by following foreign keys, and in how many steps."""
    def link(name: str, source: str, source_key: str, target: str, target_key: str) -> DataFrame:
        return table(spark, sf, name).select(
            F.concat(F.lit(source + ":"), F.col(source_key).cast("string")).alias("src"),
            F.concat(F.lit(target + ":"), F.col(target_key).cast("string")).alias("dst"),
        )

    links = (
        link("nation", "region", "n_regionkey", "nation", "n_nationkey")
        .unionByName(link("customer", "nation", "c_nationkey", "customer", "c_custkey"))
        .unionByName(link("orders", "customer", "o_custkey", "order", "o_orderkey"))
        .unionByName(link("lineitem", "order", "l_orderkey", "part", "l_partkey"))
        .unionByName(link("supplier", "nation", "s_nationkey", "supplier", "s_suppkey"))
    )
    starts = table(spark, sf, "region").select(
        F.concat(F.lit("region:"), F.col("r_regionkey").cast("string")).alias("node")
    )
    return lineage.reach(starts, cut(links, "links"))


# The columns of the retail models, written out.
_CUSTOMER_COLUMNS = """['CUSTOMER_ID','FIRST_NAME','LAST_NAME','EMAIL','PHONE','COUNTRY','SEGMENT','CREATED_AT','UPDATED_AT',
    '_SNOWFLAKE_INSERTED_AT','_SNOWFLAKE_UPDATED_AT','LOYALTY_TIER','PREFERRED_CONTACT','PREFERRED_LANGUAGE']"""
_ORDER_COLUMNS = """['ORDER_ID','CUSTOMER_ID','ORDER_DATE','STATUS','TOTAL_AMOUNT','CURRENCY','CHANNEL','CREATED_AT','UPDATED_AT',
    '_SNOWFLAKE_INSERTED_AT','_SNOWFLAKE_UPDATED_AT']"""
_ITEM_COLUMNS = """['ITEM_ID','ORDER_ID','PRODUCT_ID','PRODUCT_NAME','QUANTITY','UNIT_PRICE','CREATED_AT','_SNOWFLAKE_INSERTED_AT',
    '_SNOWFLAKE_UPDATED_AT']"""
_COLUMN_LINKS = f"""
    silver(item, own) AS (VALUES ('CUSTOMERS', {_CUSTOMER_COLUMNS}), ('ORDERS', {_ORDER_COLUMNS}), ('ORDER_ITEMS', {_ITEM_COLUMNS})),
    gold(model, output, source, input) AS (VALUES
        ('orders_daily', 'ORDER_DATE', 'ORDERS', 'ORDER_DATE'), ('orders_daily', 'CHANNEL', 'ORDERS', 'CHANNEL'),
        ('orders_daily', 'STATUS', 'ORDERS', 'STATUS'), ('orders_daily', 'COUNTRY', 'CUSTOMERS', 'COUNTRY'),
        ('orders_daily', 'SEGMENT', 'CUSTOMERS', 'SEGMENT'), ('orders_daily', 'LOYALTY_TIER', 'CUSTOMERS', 'LOYALTY_TIER'),
        ('orders_daily', 'PREFERRED_CONTACT', 'CUSTOMERS', 'PREFERRED_CONTACT'),
        ('orders_daily', 'PREFERRED_LANGUAGE', 'CUSTOMERS', 'PREFERRED_LANGUAGE'),
        ('orders_daily', 'ORDER_COUNT', 'ORDERS', 'ORDER_ID'), ('orders_daily', 'CUSTOMER_COUNT', 'ORDERS', 'CUSTOMER_ID'),
        ('orders_daily', 'TOTAL_REVENUE', 'ORDERS', 'TOTAL_AMOUNT'), ('orders_daily', 'AVG_ORDER_VALUE', 'ORDERS', 'TOTAL_AMOUNT'),
        ('category_summary', 'PRODUCT_NAME', 'ORDER_ITEMS', 'PRODUCT_NAME'), ('category_summary', 'ITEMS_SOLD', 'ORDER_ITEMS', 'ITEM_ID'),
        ('category_summary', 'TOTAL_UNITS', 'ORDER_ITEMS', 'QUANTITY'), ('category_summary', 'TOTAL_REVENUE', 'ORDER_ITEMS', 'QUANTITY'),
        ('category_summary', 'TOTAL_REVENUE', 'ORDER_ITEMS', 'UNIT_PRICE'), ('category_summary', 'AVG_UNIT_PRICE', 'ORDER_ITEMS', 'UNIT_PRICE'),
        ('category_summary', 'ORDER_COUNT', 'ORDER_ITEMS', 'ORDER_ID')),
    whole(model, source, input) AS (VALUES ('orders_daily', 'ORDERS', 'ORDER_ID'), ('orders_daily', 'ORDERS', 'CUSTOMER_ID'),
        ('orders_daily', 'CUSTOMERS', 'CUSTOMER_ID'), ('category_summary', 'ORDER_ITEMS', 'ITEM_ID')),
    rows_of(item, input) AS (SELECT item, unnest(['_SNOWFLAKE_UPDATED_AT', '_SNOWFLAKE_DELETED', own[1]]) FROM silver
        UNION ALL SELECT 'ORDER_ITEMS', unnest(['PRODUCT_ID', 'SUPPLIER_ID', 'QUANTITY', 'UNIT_PRICE'])),
    links AS (
        SELECT 'BRONZE.' || item || '.' || c AS src, 'SILVER.' || item || '.' || c AS dst, 'silver.' || lower(item) AS model, c AS output
        FROM (SELECT item, unnest(own) AS c FROM silver)
        UNION SELECT 'BRONZE.' || item || '.' || input, 'SILVER.' || item || '.' || c, 'silver.' || lower(item), c
        FROM rows_of JOIN (SELECT item, unnest(own) AS c FROM silver) USING (item)
        UNION SELECT 'SILVER.' || source || '.' || input, 'GOLD.' || upper(model) || '.' || output, 'gold.' || model, output FROM gold
        UNION SELECT 'SILVER.' || w.source || '.' || w.input, 'GOLD.' || upper(model) || '.' || g.output, 'gold.' || model, g.output
        FROM whole w JOIN (SELECT DISTINCT model, output FROM gold) g USING (model))"""
_CHANGED = (("CUSTOMERS", "COUNTRY"), ("ORDERS", "TOTAL_AMOUNT"), ("ORDERS", "CUSTOMER_ID"), ("ORDER_ITEMS", "UNIT_PRICE"), ("ORDERS", "CURRENCY"), ("ORDERS", "NO_COLUMN"), ("ORDER_ITEMS", "_SNOWFLAKE_DELETED"))
_CHANGED_SQL = "[" + ", ".join(f"['{t}', '{c}']" for t, c in _CHANGED) + f"][user_id % {len(_CHANGED)} + 1]"


@query(
    "column_impact",
    f"""
    WITH RECURSIVE {_COLUMN_LINKS},
    q AS (SELECT event_id, 'BRONZE.' || {_CHANGED_SQL}[1] || '.' || {_CHANGED_SQL}[2] AS origin FROM events),
    walk AS (SELECT origin, origin AS node, '' AS model, '' AS output, 0 AS depth FROM (SELECT DISTINCT origin FROM q)
        UNION SELECT origin, dst, links.model, links.output, depth + 1 FROM walk JOIN links ON src = node)
    SELECT event_id, model AS artifact_name, output AS output_column, min(depth) AS depth
    FROM q JOIN walk USING (origin) WHERE depth > 0 GROUP BY ALL
    """,
)
def column_impact(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a change of one column of the retail tables: the columns of the models that it reaches."""
    pick = F.element_at(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(c).alias("c")) for t, c in _CHANGED]), (F.col("user_id") % len(_CHANGED) + 1).cast("int"))
    changes = table(spark, sf, "events").select("event_id", pick.alias("p")).select("event_id", F.col("p.t").alias("table_name"), F.col("p.c").alias("column_name"))
    return columns.column_impact(changes, columns.column_edges(spark, roles.DRIVER_MODELS))
