"""Data tests, candidate checks, run logs, full and sandbox runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality, summary
from ..plans.models import Change, evolve
from ..plans.retail import TESTS
from ..plans.run import build_all, materialize, run_order, sandbox_run
from ..session import cut, scratch_dir
from ..sources.tables import Warehouse
from ..streaming.checks import RelationshipTest, UniqueTest
from . import roles
from .base import ORACLES, query, table
from .cdc import DAILY_KEYS
from .roles import SILVER_CUSTOMERS, SILVER_ORDER_ITEMS, SILVER_ORDERS


@query(
    "dq_unique",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
    WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
)
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_not_null",
    """
    SELECT count(*) FILTER (deleted IS NULL) AS deleted, count(*) FILTER (user_id IS NULL) AS user_id,
        count(*) FILTER (ts IS NULL) AS ts, count(*) FILTER (value IS NULL) AS value FROM """ + roles.USER_LOG,
)
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_counts(roles.user_log(spark, sf), ["deleted", "user_id", "ts", "value"])


@query(
    "dq_relationships",
    f"""
    SELECT customer_id AS value, count(*) AS child_rows FROM {SILVER_ORDERS} o
    WHERE customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {SILVER_CUSTOMERS} c WHERE c.customer_id = o.customer_id)
    GROUP BY customer_id
    """,
)
def dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose customer is missing or deleted."""
    silver = build_all(roles.DRIVER_MODELS, roles.bronze(spark, sf))
    return quality.orphan_counts(silver["silver.orders"], "customer_id", silver["silver.customers"], "customer_id")


#: Changes in which a table arrives where its tests are followed.
CHANGES = 2


def _changes(rows: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """A table as changes that add all of its rows; the second one also takes a part away, which a third brings back."""
    rows = cut(rows, "followed")
    place = F.pmod(F.xxhash64(*rows.columns), F.lit(CHANGES))
    none, parts = rows.limit(0), [rows.filter(place == i) for i in range(CHANGES)]
    back = parts[0].filter(F.pmod(F.xxhash64(F.lit(1), *rows.columns), F.lit(5)) == 0)
    return [(none, parts[0]), (back, parts[1]), (none, back)]


@query("dq_unique_followed", ORACLES["dq_unique"])
def dq_unique_followed(spark: SparkSession, sf: str) -> DataFrame:
    """The same report, kept up change by change."""
    keys = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    test = UniqueTest(scratch_dir(spark, "unique"), keys.schema, 8)
    for batch, (removed, added) in enumerate(_changes(keys)):
        test.apply(removed, added, batch)
    return test.report(spark)


@query("dq_relationships_followed", ORACLES["dq_relationships"])
def dq_relationships_followed(spark: SparkSession, sf: str) -> DataFrame:
    """The same report, kept up while orders and customers change."""
    silver = build_all(roles.DRIVER_MODELS, roles.bronze(spark, sf))
    orders, customers = (silver[f"silver.{t}"].select("customer_id") for t in ("orders", "customers"))
    test = RelationshipTest(scratch_dir(spark, "relationship"), customers.schema["customer_id"].dataType, 8)
    for batch, (child, parent) in enumerate(zip(_changes(orders), _changes(customers))):
        test.apply(child, parent, "customer_id", "customer_id", batch)
    return test.report(spark)


def _unique_sql(model: str, column: str, rows: str) -> str:
    return f"""SELECT '{model}' AS model, '{column}' AS column_name, 'unique' AS test, count(*) AS failures FROM
        (SELECT {column} FROM {rows} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"""


def _not_null_sql(model: str, column: str, rows: str) -> str:
    return f"SELECT '{model}', '{column}', 'not_null', count(*) FROM {rows} WHERE {column} IS NULL"


def _parent_sql(model: str, column: str, rows: str, parent: str) -> str:
    return f"""SELECT '{model}', '{column}', 'relationships', count(*) FROM {rows}
        WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {parent})"""


@query(
    "dq_report",
    " UNION ALL ".join(
        [
            _unique_sql("silver.customers", "customer_id", SILVER_CUSTOMERS),
            _not_null_sql("silver.customers", "customer_id", SILVER_CUSTOMERS),
            _unique_sql("silver.orders", "order_id", SILVER_ORDERS),
            _not_null_sql("silver.orders", "order_id", SILVER_ORDERS),
            _not_null_sql("silver.orders", "customer_id", SILVER_ORDERS),
            _parent_sql("silver.orders", "customer_id", SILVER_ORDERS, SILVER_CUSTOMERS),
            _unique_sql("silver.order_items", "item_id", SILVER_ORDER_ITEMS),
            _not_null_sql("silver.order_items", "item_id", SILVER_ORDER_ITEMS),
            _not_null_sql("silver.order_items", "order_id", SILVER_ORDER_ITEMS),
            _parent_sql("silver.order_items", "order_id", SILVER_ORDER_ITEMS, SILVER_ORDERS),
        ]
    ),
)
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    """The declared tests over the three current-state tables, stored first with the columns under test."""
    silver = build_all(roles.DRIVER_MODELS, roles.bronze(spark, sf))
    tested = {
        "silver.customers": ["customer_id"],
        "silver.orders": ["order_id", "customer_id"],
        "silver.order_items": ["item_id", "order_id"],
    }
    stored = {model: cut(silver[model].select(*columns), "tested") for model, columns in tested.items()}
    return quality.test_report(stored, TESTS)


_DAILY_JOIN = f"{SILVER_ORDERS} o JOIN {SILVER_CUSTOMERS} c ON o.customer_id = c.customer_id"
_COUNTS = {
    "silver.customers": f"SELECT count(*) FROM {SILVER_CUSTOMERS}",
    "silver.orders": f"SELECT count(*) FROM {SILVER_ORDERS}",
    "silver.order_items": f"SELECT count(*) FROM {SILVER_ORDER_ITEMS}",
    "gold.orders_daily": f"SELECT count(*) FROM (SELECT DISTINCT {DAILY_KEYS.replace('order_date', 'CAST(order_date AS DATE)')} FROM {_DAILY_JOIN})",
    "gold.category_summary": f"SELECT count(DISTINCT product_name) FROM {SILVER_ORDER_ITEMS}",
}


def _counts_sql(extra: str = "", names: tuple[str, ...] = tuple(_COUNTS)) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS model, {extra}({_COUNTS[name]}) AS row_count" for name in names)


@query("model_row_counts", _counts_sql())
def model_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    built = build_all(roles.DRIVER_MODELS, roles.bronze(spark, sf))
    return quality.row_counts({name: built[name] for name in run_order(roles.DRIVER_MODELS)})


@query("materialize_models", _counts_sql())
def materialize_models(spark: SparkSession, sf: str) -> DataFrame:
    """Full refresh of all models into a fresh warehouse folder."""
    out = Warehouse(scratch_dir(spark, "warehouse"))
    return materialize(spark, roles.DRIVER_MODELS, roles.bronze(spark, sf), out)


@query("sandbox_run", _counts_sql("'PASS' AS test_status, ", ("silver.orders", "gold.orders_daily")))
def run_sandbox(spark: SparkSession, sf: str) -> DataFrame:
    """The models below the orders, run in a sandbox."""
    sandbox = Warehouse(scratch_dir(spark, "sandbox"), env="DEV")
    verdicts = sandbox_run(spark, roles.DRIVER_MODELS, roles.bronze(spark, sf), sandbox, changed=["bronze.orders"])
    return verdicts.select("model", "test_status", "row_count")


@query(
    "validate_models",
    _counts_sql("'PASS' AS test_status, ") + """
    UNION ALL SELECT 'silver.orders, column gone', 'FAIL', CAST(NULL AS BIGINT)
    UNION ALL SELECT 'silver.orders, key gone', 'FAIL', CAST(NULL AS BIGINT)
    """,
)
def validate_models(spark: SparkSession, sf: str) -> DataFrame:
    """A verdict per model, two of them broken: a column its source lost, and a change that takes its key."""
    bronze = roles.bronze(spark, sf)
    built = build_all(roles.DRIVER_MODELS, bronze)
    orders = roles.DRIVER_MODELS["silver.orders"]
    candidates = {name: (lambda n=name: built[n]) for name in run_order(roles.DRIVER_MODELS)}
    candidates["silver.orders, column gone"] = lambda: orders.build(
        {"bronze.orders": bronze["bronze.orders"].drop("currency")}
    )
    candidates["silver.orders, key gone"] = lambda: evolve(
        roles.DRIVER_MODELS, [Change("COLUMN_DROP", "ORDERS", "ORDER_ID")]
    )["silver.orders"].build(bronze)
    return quality.validate(spark, candidates).select("model", "test_status", "row_count")


_LOG_SQL = """(SELECT event_id AS line_no, CASE event_type
    WHEN 'view' THEN '  | OK created sql table model SILVER.User_' || user_id || ' ... [SUCCESS 1 in 2.3s]'
    WHEN 'purchase' THEN 'OK created sql table model GOLD.USER_' || user_id || ' ....'
    WHEN 'error' THEN 'ERROR creating sql table model SILVER.USER_' || user_id || ' ... [ERROR]'
    WHEN 'click' THEN '|| Database Error in model GOLD.USER_' || user_id || ' (models/gold/user.sql)'
    ELSE 'Done. PASS=3 ERROR=0 user ' || user_id END AS line FROM events)"""


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a log line of a run."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    line = (
        F.when(kind == "view", F.concat(F.lit("  | OK created sql table model SILVER.User_"), user,
                                        F.lit(" ... [SUCCESS 1 in 2.3s]")))
        .when(kind == "purchase", F.concat(F.lit("OK created sql table model GOLD.USER_"), user, F.lit(" ....")))
        .when(kind == "error", F.concat(F.lit("ERROR creating sql table model SILVER.USER_"), user,
                                        F.lit(" ... [ERROR]")))
        .when(kind == "click", F.concat(F.lit("|| Database Error in model GOLD.USER_"), user,
                                        F.lit(" (models/gold/user.sql)")))
        .otherwise(F.concat(F.lit("Done. PASS=3 ERROR=0 user "), user))
    )
    return table(spark, sf, "events").select(F.col("event_id").alias("line_no"), line.alias("line"))


_RESULTS_SQL = f"""(
    SELECT model, arg_max(status, line_no) AS status, arg_max(detail, line_no) AS detail FROM (
        SELECT line_no, trim(ltrim(trim(line), '|')) AS detail,
            CASE WHEN line LIKE '%OK created%' OR line LIKE '%SUCCESS%' THEN 'PASS' ELSE 'FAIL' END AS status,
            lower(regexp_extract(upper(line), '((SILVER|GOLD)\\.USER_\\S+)', 1)) AS model
        FROM {_LOG_SQL} WHERE line NOT LIKE 'Done.%')
    GROUP BY model)"""


@query("run_log_results", f"SELECT model, status, detail FROM {_RESULTS_SQL}")
def run_log_results(spark: SparkSession, sf: str) -> DataFrame:
    return quality.run_log_results(run_log(spark, sf))


@query(
    "model_status",
    f"""
    WITH names AS (SELECT unnest(['silver.user_', 'gold.user_']) || c_custkey AS model FROM customer),
    failing AS (SELECT arg_max(trim(ltrim(trim(line), '|')), line_no) AS line FROM {_LOG_SQL}
        WHERE contains(line, 'ERROR creating') OR contains(line, 'Database Error'))
    SELECT n.model, COALESCE(status, 'FAIL') AS test_status,
        CASE WHEN status IS NULL THEN COALESCE((SELECT line FROM failing), '') ELSE detail END AS test_error
    FROM names n LEFT JOIN {_RESULTS_SQL} r ON r.model = n.model
    """,
)
def model_status(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer as an artifact of either layer; the run as a whole ended with exit code 1."""
    layers = F.explode(F.array(F.lit("silver.user_"), F.lit("gold.user_")))
    artifacts = table(spark, sf, "customer").select(layers.alias("layer"), F.col("c_custkey").cast("string").alias("key"))
    artifacts = artifacts.select(F.concat("layer", "key").alias("model"))
    return quality.model_status(artifacts, run_log(spark, sf), exit_code=1)


@query(
    "artifact_summary",
    """
    SELECT conv_id, turn, '- `turn_' || turn || '` (' || role || ')' AS label FROM conversations
    """,
)
def artifact_summary(spark: SparkSession, sf: str) -> DataFrame:
    label = F.concat(F.lit("- `turn_"), F.col("turn").cast("string"), F.lit("` ("), F.col("role"), F.lit(")"))
    return summary.labels(table(spark, sf, "conversations"), ["conv_id"], "turn", label)


_CANDIDATE_ROWS = """SELECT 'C' || c_custkey AS event_id, 'silver.customer_' || c_custkey AS artifact_name, c_nationkey,
    CASE c_custkey % 3 WHEN 2 THEN 'PASS' ELSE 'PENDING' END AS test_status FROM customer"""


@query(
    "candidate_check",
    f"""
    SELECT event_id, artifact_name, CASE WHEN test_status = 'PASS' OR c_nationkey % 3 <> 1 THEN 'PASS'
        ELSE 'FAIL' END AS test_status, test_status = 'PENDING' AND c_nationkey % 3 = 1 AS has_error
    FROM ({_CANDIDATE_ROWS})
    """,
)
def candidate_check(spark: SparkSession, sf: str) -> DataFrame:
    """A stored candidate per customer: each reads the customers of its nation, in a third of the nations by a column that
    is not there; a third of the candidates was checked before."""
    nation, key = F.col("c_nationkey"), F.col("c_custkey")
    text = F.concat(
        F.lit("{{ config(schema='silver') }} SELECT "), F.when(nation % 3 == 1, "no_such_column").otherwise("c_custkey"),
        F.lit(" FROM {{ source('bronze', 'customer') }} WHERE c_nationkey = "), nation.cast("string"),
    )
    code = table(spark, sf, "customer").select(
        F.concat(F.lit("C"), key.cast("string")).alias("event_id"),
        F.concat(F.lit("silver.customer_"), key.cast("string")).alias("artifact_name"),
        text.alias("generated_sql"),
        F.when(key % 3 == 2, "PASS").otherwise("PENDING").alias("test_status"),
        F.lit(None).cast("string").alias("test_error"),
    )
    checked = quality.check_candidates(spark, code, {"bronze.customer": table(spark, sf, "customer")}, roles.DATABASE)
    return checked.select("event_id", "artifact_name", "test_status", F.col("test_error").isNotNull().alias("has_error"))
