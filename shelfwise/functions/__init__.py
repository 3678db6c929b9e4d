"""Column-level building blocks: decision rules, calendar and money helpers."""

from shelfwise.functions.calendar import add_calendar, sale_date
from shelfwise.functions.money import amount, count_mean, money_mean, money_sum
from shelfwise.functions.rules import (
    CATEGORY_RULES,
    EVENT_WEIGHTS,
    active_days,
    average_daily_demand,
    classify_product,
    click_signal,
    demand_level,
    demand_score,
    elapsed_days,
    event_weight,
    final_reorder,
    inventory_action,
    lead_time,
    price_adjustment,
    pricing_action,
    realtime_action,
    recommended_price,
    reorder_quantity,
    stock_coverage,
    stockout_risk,
)

__all__ = [
    "amount",
    "CATEGORY_RULES", "EVENT_WEIGHTS", "active_days", "add_calendar",
    "average_daily_demand", "classify_product", "click_signal", "count_mean",
    "demand_level", "demand_score", "elapsed_days", "event_weight",
    "final_reorder", "inventory_action", "lead_time", "money_mean", "money_sum",
    "price_adjustment", "pricing_action", "realtime_action", "recommended_price",
    "reorder_quantity", "sale_date", "stock_coverage", "stockout_risk",
]
