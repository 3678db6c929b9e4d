"""Dynamic pricing recommendations (M5)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfwise.functions import rules
from shelfwise.operators.signals import attach_clicks, attach_competitor
from shelfwise.schemas import PRICING_COLUMNS

DEMAND_FEATURES = ["product_id", "product_name", "category", "total_quantity_sold",
                   "total_orders", "unique_customers", "total_revenue",
                   "average_daily_demand", "average_selling_price", "demand_level"]
INVENTORY_FEATURES = ["product_id", "current_stock", "reorder_level", "lead_time_days",
                      "stock_coverage_days", "stockout_risk",
                      "recommended_reorder_quantity"]


def demand_features(demand: DataFrame) -> DataFrame:
    """P10: columns the pricing rules read from demand analytics."""
    return demand.select(*DEMAND_FEATURES)


def inventory_features(inv: DataFrame) -> DataFrame:
    """P10: columns the pricing rules read from inventory analytics."""
    return inv.select(*INVENTORY_FEATURES)


def dynamic_pricing(demand: DataFrame, inventory_analytics: DataFrame,
                    clicks: DataFrame | None = None, quotes: DataFrame | None = None,
                    click_count_table: DataFrame | None = None,
                    competitor_table: DataFrame | None = None,
                    labels: str = "legacy", overstock: int = rules.OVERSTOCK_UNITS,
                    clicks_high: int = rules.CLICKS_HIGH,
                    clicks_medium: int = rules.CLICKS_MEDIUM,
                    available_only: bool = False) -> DataFrame:
    """One pricing row per demand row.

    The inventory join is USING product_id, as in the source job: a
    product present under several names in both inputs fans out; use
    ``quality.assert_unique_key`` upstream to rule that out.
    ``labels="legacy"`` compares demand levels with High/Medium/Low (the
    source behaviour: two INCREASE/DECREASE branches never fire);
    ``labels="normalized"`` compares with the labels actually written.
    """
    df = demand_features(demand).join(inventory_features(inventory_analytics),
                                      on="product_id", how="left")
    df = attach_clicks(df, clicks=clicks, counts=click_count_table)
    df = attach_competitor(df, quotes=quotes, averages=competitor_table,
                           available_only=available_only)
    df = df.withColumns({
        "demand_score": rules.demand_score("demand_level", labels=labels),
        "real_time_demand_signal": rules.click_signal("real_time_click_count",
                                                      clicks_high, clicks_medium),
    })
    df = df.withColumn("pricing_action", rules.pricing_action(
        "demand_level", "stockout_risk", "real_time_demand_signal", "current_stock",
        "reorder_level", "average_competitor_price", "average_selling_price",
        labels=labels, overstock=overstock))
    df = df.withColumn("price_adjustment_percentage",
                       rules.price_adjustment("pricing_action"))
    df = df.withColumn("recommended_price",
                       rules.recommended_price("average_selling_price",
                                               "price_adjustment_percentage"))
    return df.select(*PRICING_COLUMNS)
