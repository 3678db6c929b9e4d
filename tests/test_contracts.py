"""Output tables keep the column names and types of the table contracts
(SURVEY section 1.4, the external table DDL)."""

from conftest import SF_SMALL
from shelfwise.plans.queries import QUERIES

S, I, L, D, DT, TS = "string", "int", "bigint", "double", "date", "timestamp"

CONTRACTS = {
    "master_sales": [
        ("invoice_no", S), ("product_id", S), ("product_name", S), ("category", S),
        ("quantity", I), ("invoice_date", TS), ("sale_date", DT), ("unit_price", D),
        ("catalog_selling_price", D), ("customer_id", S), ("country", S), ("revenue", D),
        ("day", I), ("day_of_week", I), ("year", I), ("month", I)],
    "demand_analytics": [
        ("product_id", S), ("product_name", S), ("category", S), ("total_quantity_sold", L),
        ("total_orders", L), ("unique_customers", L), ("total_revenue", D),
        ("average_quantity_per_transaction", D), ("average_selling_price", D),
        ("first_sale_date", DT), ("last_sale_date", DT), ("active_days", I),
        ("average_daily_demand", D), ("demand_level", S)],
    "inventory_analytics": [
        ("product_id", S), ("product_name", S), ("category", S), ("total_quantity_sold", L),
        ("average_daily_demand", D), ("demand_level", S), ("initial_stock", I),
        ("current_stock", I), ("reorder_level", I), ("lead_time_days", I),
        ("stock_coverage_days", D), ("stockout_risk", S), ("recommended_reorder_quantity", I)],
    "dynamic_pricing": [
        ("product_id", S), ("product_name", S), ("category", S), ("average_selling_price", D),
        ("recommended_price", D), ("total_quantity_sold", L), ("average_daily_demand", D),
        ("demand_level", S), ("current_stock", I), ("reorder_level", I), ("stockout_risk", S),
        ("real_time_click_count", L), ("real_time_demand_signal", S),
        ("average_competitor_price", D), ("pricing_action", S),
        ("price_adjustment_percentage", D)],
    "inventory_optimization": [
        ("product_id", S), ("product_name", S), ("category", S), ("current_stock", I),
        ("reorder_level", I), ("lead_time_days", I), ("stock_coverage_days", D),
        ("stockout_risk", S), ("average_daily_demand", D), ("demand_level", S),
        ("real_time_click_count", L), ("real_time_demand_status", S), ("inventory_action", S),
        ("recommended_reorder_quantity", I), ("final_reorder_quantity", I)],
}


def test_contracts(spark):
    for name, want in CONTRACTS.items():
        got = QUERIES[name](spark, SF_SMALL).dtypes
        assert got == want, name
    # without signals the fallbacks keep the contract types
    assert QUERIES["pricing_without_signals"](spark, SF_SMALL).dtypes == \
        CONTRACTS["dynamic_pricing"]
