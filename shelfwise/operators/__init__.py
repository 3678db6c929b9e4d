"""DataFrame -> DataFrame operators, one module per stage of the chain."""

from shelfwise.operators.demand import demand_analytics, top_products
from shelfwise.operators.inventory import inventory_analytics, lowest_coverage
from shelfwise.operators.prepare import (
    build_catalog,
    coerce_types,
    dedupe_rows,
    drop_cancelled,
    drop_incomplete,
    dropped_rows,
    generate_inventory,
    historical_demand,
    normalize_columns,
    prepare,
    prepare_transactions,
    quality_report,
    rename_source,
    require_columns,
)
from shelfwise.operators.pricing import dynamic_pricing
from shelfwise.operators.quality import (
    assert_unique_key,
    missing_keys,
    profile,
    profile_columns,
    profile_table,
    repeated_keys,
    validation_report,
)
from shelfwise.operators.replenish import optimize_inventory
from shelfwise.operators.sales import (
    build_master_sales,
    clean_transactions,
    master_sales,
    observe_quality,
    partition_pruned,
    sales_quality,
    standardize_catalog,
    standardize_inventory,
)
from shelfwise.operators.signals import (
    attach_clicks,
    attach_competitor,
    click_counts,
    competitor_average,
)

__all__ = [
    "assert_unique_key", "attach_clicks", "attach_competitor", "build_catalog",
    "build_master_sales", "clean_transactions", "click_counts", "coerce_types",
    "competitor_average", "dedupe_rows", "demand_analytics", "drop_cancelled",
    "drop_incomplete", "dropped_rows", "dynamic_pricing", "generate_inventory", "historical_demand",
    "inventory_analytics", "lowest_coverage", "master_sales", "missing_keys",
    "normalize_columns", "observe_quality", "optimize_inventory", "partition_pruned", "prepare",
    "prepare_transactions", "profile", "profile_columns", "profile_table", "quality_report",
    "rename_source", "repeated_keys", "require_columns", "sales_quality", "standardize_catalog",
    "standardize_inventory", "top_products", "validation_report",
]
