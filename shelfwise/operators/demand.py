"""Demand analytics per product (M3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import rules
from shelfwise.functions.money import count_mean, money_mean, money_sum
from shelfwise.schemas import DEMAND_COLUMNS

GRAIN = ["product_id", "product_name", "category"]


def _marked(sales: DataFrame, marks: dict[str, str]) -> DataFrame:
    """``sales`` with a flag per column: true on one line of each (product,
    value of the column), never where the value is missing.

    Sales that come from a sort-merge join by product are marked where they
    are, without a shuffle. Where AQE has cut a hot product between tasks
    (``forceOptimizeSkewedJoin``), or the sales are not dealt out by product,
    they are dealt out by (product, value), so no task gets a whole hot
    product. Groups are sorted with spill.
    """
    for column, mark in marks.items():
        same = Window.partitionBy(*GRAIN, column).orderBy(column)
        sales = sales.withColumn(mark, F.col(column).isNotNull() & (F.row_number().over(same) == 1))
    return sales


def demand_analytics(sales: DataFrame, high: float = rules.DEMAND_HIGH,
                     medium: float = rules.DEMAND_MEDIUM,
                     approx_distinct: bool = False) -> DataFrame:
    """A1-A7, R1, R3, R4 over master sales.

    For the two exact distinct counts the first line of each (product,
    value) is marked, see :func:`_marked`, so every line stays one row and
    one aggregate gives all figures. ``approx_distinct`` swaps in
    HyperLogLog++ and drops the marking. Money is summed exactly (see
    ``functions.money``), so results do not depend on partitioning.
    """
    if approx_distinct:
        orders, customers = F.approx_count_distinct("invoice_no"), F.approx_count_distinct("customer_id")
    else:
        sales = _marked(sales, {"invoice_no": "_order", "customer_id": "_customer"})
        orders, customers = F.count_if("_order"), F.count_if("_customer")
    agg = sales.groupBy(*GRAIN).agg(
        F.sum("quantity").alias("total_quantity_sold"),
        orders.alias("total_orders"),
        customers.alias("unique_customers"),
        money_sum("revenue").alias("_revenue"),
        count_mean("quantity").alias("_avg_qty"),
        money_mean("unit_price").alias("_avg_price"),
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
    )
    return with_rules(agg, high, medium)


def with_rules(agg: DataFrame, high: float = rules.DEMAND_HIGH, medium: float = rules.DEMAND_MEDIUM) -> DataFrame:
    """Roundings, days and demand level over the aggregate of a product."""
    days = rules.active_days("first_sale_date", "last_sale_date")
    out = agg.select(
        *GRAIN, "total_quantity_sold", "total_orders", "unique_customers",
        F.round("_revenue", 2).alias("total_revenue"),
        F.round("_avg_qty", 2).alias("average_quantity_per_transaction"),
        F.round("_avg_price", 2).alias("average_selling_price"),
        "first_sale_date", "last_sale_date", days.alias("active_days"),
    )
    daily = rules.average_daily_demand("total_quantity_sold", "active_days")
    out = out.withColumn("average_daily_demand", daily)
    return out.withColumn(
        "demand_level", rules.demand_level("average_daily_demand", high, medium)
    ).select(*DEMAND_COLUMNS)


def top_products(demand: DataFrame, n: int = 10) -> DataFrame:
    """O1: top-n by quantity sold (ties by the grain). Plans as
    TakeOrderedAndProject: each task keeps n rows, the driver merges."""
    return demand.orderBy(F.desc("total_quantity_sold"), *[F.asc(c) for c in GRAIN]).limit(n)
