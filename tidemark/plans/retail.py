"""The retail models: three current-state tables and two aggregates, with their declared tests."""

from __future__ import annotations

from ..constants import INSERTED_COLUMN, VERSION_COLUMN
from ..operators.cdc import CdcSpec
from ..operators.quality import ModelTests, Relationship
from .models import AggregateModel, Group, Measure, Model, RowModel

# Names of tables, columns, groups and measures.
_AUDIT = (INSERTED_COLUMN, VERSION_COLUMN)

CUSTOMERS = RowModel(
    "silver.customers",
    "bronze.customers",
    CdcSpec(("customer_id",)),
    (
        "customer_id", "first_name", "last_name", "email", "phone", "country", "segment", "created_at", "updated_at",
        *_AUDIT, "loyalty_tier", "preferred_contact", "preferred_language",
    ),
)
ORDERS = RowModel(
    "silver.orders",
    "bronze.orders",
    CdcSpec(("order_id",)),
    (
        "order_id", "customer_id", "order_date", "status", "total_amount", "currency", "channel", "created_at",
        "updated_at", *_AUDIT,
    ),
)
ORDER_ITEMS = RowModel(
    "silver.order_items",
    "bronze.order_items",
    CdcSpec(("item_id",)),
    ("item_id", "order_id", "product_id", "product_name", "quantity", "unit_price", "created_at", *_AUDIT),
)
ORDERS_DAILY = AggregateModel(
    "gold.orders_daily",
    fact="silver.orders",
    fact_key="order_id",
    dimension="silver.customers",
    fact_join="customer_id",
    dimension_join="customer_id",
    groups=(
        Group("order_date", "order_date", by_day=True),
        Group("country", "country", "dimension"),
        Group("segment", "segment", "dimension"),
        Group("channel", "channel"),
        Group("status", "status"),
        Group("loyalty_tier", "loyalty_tier", "dimension"),
        Group("preferred_contact", "preferred_contact", "dimension"),
        Group("preferred_language", "preferred_language", "dimension"),
    ),
    measures=(
        Measure("order_count", "count_distinct", ("order_id",)),
        Measure("customer_count", "count_distinct", ("customer_id",)),
        Measure("total_revenue", "sum", ("total_amount",)),
        Measure("avg_order_value", "avg", ("total_amount",)),
    ),
)
CATEGORY_SUMMARY = AggregateModel(
    "gold.category_summary",
    fact="silver.order_items",
    fact_key="item_id",
    groups=(Group("product_name", "product_name"),),
    measures=(
        Measure("items_sold", "count_distinct", ("item_id",)),
        Measure("total_units", "sum", ("quantity",)),
        Measure("total_revenue", "sum_product", ("quantity", "unit_price")),
        Measure("avg_unit_price", "avg", ("unit_price",)),
        Measure("order_count", "count_distinct", ("order_id",)),
    ),
)

MODELS: dict[str, Model] = {m.name: m for m in (CUSTOMERS, ORDERS, ORDER_ITEMS, ORDERS_DAILY, CATEGORY_SUMMARY)}

def _shown(model: Model) -> list[str]:
    if isinstance(model, RowModel):
        return [c for c in model.columns if c not in _AUDIT]
    return [x.alias for x in (*model.groups, *model.measures)]


# One entry for each column, the name in words; the audit columns have none.
COLUMN_DOCS: dict[str, dict[str, str]] = {
    name: {c: c.replace("_", " ").capitalize() + "." for c in _shown(model)} for name, model in MODELS.items()
}

TESTS: dict[str, ModelTests] = {
    "silver.customers": ModelTests(unique=(("customer_id",),), not_null=("customer_id",)),
    "silver.orders": ModelTests(
        unique=(("order_id",),),
        not_null=("order_id", "customer_id"),
        relationships=(Relationship("customer_id", "silver.customers", "customer_id"),),
    ),
    "silver.order_items": ModelTests(
        unique=(("item_id",),),
        not_null=("item_id", "order_id"),
        relationships=(Relationship("order_id", "silver.orders", "order_id"),),
    ),
}
