"""Declared input schemas and output column contracts."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, I, L, D, TS, DT, B = (T.StringType(), T.IntegerType(), T.LongType(),
                         T.DoubleType(), T.TimestampType(), T.DateType(),
                         T.BooleanType())

# Prepared transactions in the order the preparation step writes them
# (country before customer_id). CSV columns are bound by header name, so a
# file written in either order reads correctly.
TRANSACTIONS = _schema(
    ("invoice_no", S), ("product_id", S), ("description", S),
    ("quantity", I), ("invoice_date", TS), ("unit_price", D),
    ("country", S), ("customer_id", S), ("revenue", D),
)

# Catalog and inventory CSV: ids stay strings (no leading-zero loss),
# measures are read as double ("12.0" is a valid reorder level) and cast
# to int by the standardising operators.
CATALOG_CSV = _schema(
    ("product_id", S), ("product_name", S), ("category", S), ("selling_price", D),
)
INVENTORY_CSV = _schema(
    ("product_id", S), ("initial_stock", D), ("current_stock", D),
    ("reorder_level", D), ("lead_time_days", D),
)

# Raw ledger (before preparation): every field as text.
LEDGER_SOURCE_COLUMNS = {
    "invoiceno": "invoice_no",
    "stockcode": "product_id",
    "description": "description",
    "quantity": "quantity",
    "invoicedate": "invoice_date",
    "unitprice": "unit_price",
    "customerid": "customer_id",
    "country": "country",
}
LEDGER_REQUIRED = ["invoice_no", "product_id", "description", "quantity",
                   "invoice_date", "unit_price", "country"]

CLICK_EVENT = _schema(
    ("event_time", S), ("session_id", S), ("user_id", S), ("product_id", S),
    ("product_description", S), ("event_type", S), ("device", S), ("country", S),
)
COMPETITOR_EVENT = _schema(
    ("event_time", S), ("product_id", S), ("product_description", S),
    ("competitor", S), ("competitor_price", D), ("availability", B),
)

# Output contracts (column order of the written tables).
MASTER_SALES_COLUMNS = [
    "invoice_no", "product_id", "product_name", "category", "quantity",
    "invoice_date", "sale_date", "unit_price", "catalog_selling_price",
    "customer_id", "country", "revenue", "day", "day_of_week", "year", "month",
]
DEMAND_COLUMNS = [
    "product_id", "product_name", "category", "total_quantity_sold",
    "total_orders", "unique_customers", "total_revenue",
    "average_quantity_per_transaction", "average_selling_price",
    "first_sale_date", "last_sale_date", "active_days", "average_daily_demand",
    "demand_level",
]
INVENTORY_ANALYTICS_COLUMNS = [
    "product_id", "product_name", "category", "total_quantity_sold",
    "average_daily_demand", "demand_level", "initial_stock", "current_stock",
    "reorder_level", "lead_time_days", "stock_coverage_days", "stockout_risk",
    "recommended_reorder_quantity",
]
PRICING_COLUMNS = [
    "product_id", "product_name", "category", "average_selling_price",
    "recommended_price", "total_quantity_sold", "average_daily_demand",
    "demand_level", "current_stock", "reorder_level", "stockout_risk",
    "real_time_click_count", "real_time_demand_signal",
    "average_competitor_price", "pricing_action", "price_adjustment_percentage",
]
REPLENISHMENT_COLUMNS = [
    "product_id", "product_name", "category", "current_stock", "reorder_level",
    "lead_time_days", "stock_coverage_days", "stockout_risk",
    "average_daily_demand", "demand_level", "real_time_click_count",
    "real_time_demand_status", "inventory_action",
    "recommended_reorder_quantity", "final_reorder_quantity",
]
CLICKSTREAM_COLUMNS = [f.name for f in CLICK_EVENT.fields] + [
    "event_timestamp", "processed_at", "demand_signal"]
COMPETITOR_COLUMNS = [f.name for f in COMPETITOR_EVENT.fields] + [
    "event_timestamp", "processed_at"]
