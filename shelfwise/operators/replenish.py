"""Inventory optimisation / restock recommendations (M6)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfwise.functions import rules
from shelfwise.operators.signals import attach_clicks
from shelfwise.schemas import INVENTORY_ANALYTICS_COLUMNS, REPLENISHMENT_COLUMNS


def optimize_inventory(inventory_analytics: DataFrame, clicks: DataFrame | None = None,
                       click_count_table: DataFrame | None = None,
                       overstock: int = rules.OVERSTOCK_UNITS,
                       clicks_high: int = rules.CLICKS_HIGH,
                       clicks_medium: int = rules.CLICKS_MEDIUM,
                       stockout_is_urgent: bool = False) -> DataFrame:
    """J5, P24, R10, R14, R15, P23.

    By default a STOCKOUT product without a HIGH click status falls to
    NORMAL with nothing to order, as in the source job;
    ``stockout_is_urgent=True`` treats it as URGENT_RESTOCK.
    """
    df = attach_clicks(inventory_analytics.select(*INVENTORY_ANALYTICS_COLUMNS),
                       clicks=clicks, counts=click_count_table)
    df = df.withColumn("real_time_demand_status",
                       rules.click_signal("real_time_click_count", clicks_high,
                                          clicks_medium))
    df = df.withColumn("inventory_action", rules.inventory_action(
        "current_stock", "reorder_level", "real_time_demand_status", "stockout_risk",
        overstock=overstock, stockout_is_urgent=stockout_is_urgent))
    df = df.withColumn("final_reorder_quantity",
                       rules.final_reorder("inventory_action",
                                           "recommended_reorder_quantity"))
    return df.select(*REPLENISHMENT_COLUMNS)
