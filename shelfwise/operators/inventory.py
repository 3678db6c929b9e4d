"""Inventory analytics (M4): demand left-joined to stock levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import rules
from shelfwise.operators.sales import standardize_inventory
from shelfwise.schemas import INVENTORY_ANALYTICS_COLUMNS


def inventory_analytics(demand: DataFrame, inventory: DataFrame,
                        standardize: bool = True) -> DataFrame:
    """J2 + R5-R8.

    ``inventory`` is the raw inventory table; it is typed (not
    de-duplicated, as in the source job) unless ``standardize=False``.
    Coverage is compared unrounded, then rounded to 2 with the daily demand.
    """
    inv = standardize_inventory(inventory, dedupe=False) if standardize else inventory
    d, i = demand.alias("d"), inv.alias("i")
    joined = d.join(i, F.col("d.product_id") == F.col("i.product_id"), "left").select(
        F.col("d.product_id"), F.col("d.product_name"), F.col("d.category"),
        F.col("d.total_quantity_sold"), F.col("d.average_daily_demand"),
        F.col("d.demand_level"), F.col("i.initial_stock"), F.col("i.current_stock"),
        F.col("i.reorder_level"), F.col("i.lead_time_days"),
    )
    coverage = rules.stock_coverage("current_stock", "average_daily_demand")
    step = joined.withColumn("stock_coverage_days", coverage)
    return step.select(
        "product_id", "product_name", "category", "total_quantity_sold",
        F.round("average_daily_demand", 2).alias("average_daily_demand"),
        "demand_level", "initial_stock", "current_stock", "reorder_level",
        "lead_time_days",
        F.round("stock_coverage_days", 2).alias("stock_coverage_days"),
        rules.stockout_risk("current_stock", "stock_coverage_days", "lead_time_days",
                            "reorder_level").alias("stockout_risk"),
        rules.reorder_quantity("current_stock", "reorder_level")
        .alias("recommended_reorder_quantity"),
    ).select(*INVENTORY_ANALYTICS_COLUMNS)


def lowest_coverage(inv: DataFrame, n: int = 20) -> DataFrame:
    """O2: n products with the lowest coverage, nulls first (ties by id)."""
    return inv.orderBy(F.asc_nulls_first("stock_coverage_days"),
                       F.asc("product_id"), F.asc("product_name"),
                       F.asc("category")).limit(n)
