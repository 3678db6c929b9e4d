"""Invariants of the decision chain at sf0.001."""

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from shelfwise.operators import (
    build_master_sales,
    clean_transactions,
    demand_analytics,
    standardize_catalog,
)
from shelfwise.plans.queries import QUERIES
from shelfwise.sources import testviews as tv


def test_left_joins_keep_rows(spark):
    demand = QUERIES["demand_levels"](spark, SF_SMALL)
    n = demand.count()
    assert QUERIES["inventory_analytics"](spark, SF_SMALL).count() == n
    # joined on the product alone, as in the source job: k names give k * k rows
    names = demand.groupBy("product_id").count()
    assert QUERIES["dynamic_pricing"](spark, SF_SMALL).count() == names.agg(F.sum(F.col("count") ** 2)).first()[0]
    assert QUERIES["inventory_optimization"](spark, SF_SMALL).count() == n


def test_vocabularies_and_bounds(spark):
    p = QUERIES["dynamic_pricing_normalized"](spark, SF_SMALL)
    assert {r[0] for r in p.select("pricing_action").distinct().collect()} <= {
        "INCREASE_PRICE", "DECREASE_PRICE", "MATCH_COMPETITOR", "KEEP_PRICE"}
    assert p.filter(F.col("pricing_action").isNull() | F.col("real_time_demand_signal").isNull()
                    | F.col("real_time_click_count").isNull()).count() == 0
    r = QUERIES["inventory_optimization"](spark, SF_SMALL)
    assert r.filter(F.col("final_reorder_quantity") < 0).count() == 0
    assert r.filter(F.col("inventory_action").isNull()).count() == 0


def test_quantity_conserved(spark):
    tx = clean_transactions(tv.transactions(spark, SF_SMALL))
    demand = QUERIES["demand_analytics"](spark, SF_SMALL)
    assert (demand.agg(F.sum("total_quantity_sold")).first()[0]
            == tx.agg(F.sum("quantity")).first()[0])


def test_independent_of_partitioning(spark):
    sales = build_master_sales(clean_transactions(tv.transactions(spark, SF_MID)),
                               standardize_catalog(tv.product_catalog(spark, SF_MID)))
    one = demand_analytics(sales.repartition(1))
    seven = demand_analytics(sales.repartition(7, "invoice_no"))
    a = sorted(map(repr, one.collect()))
    b = sorted(map(repr, seven.collect()))
    assert a == b and len(a) > 2000
