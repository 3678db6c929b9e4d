"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the whole test tables.

The decision chain uses scaled demand thresholds (HIGH >= 0.30, MEDIUM >=
0.20): at the test scale the busiest part sells under one unit a day, so
the default thresholds (10 and 3) would label every product LOW and leave
most rule branches unexercised. ``demand_analytics`` itself runs with the
defaults.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import rules
from shelfwise.functions.calendar import add_calendar
from shelfwise.operators import (
    build_catalog,
    build_master_sales,
    clean_transactions,
    click_counts,
    competitor_average,
    dedupe_rows,
    demand_analytics,
    drop_cancelled,
    dropped_rows,
    dynamic_pricing,
    generate_inventory,
    historical_demand,
    inventory_analytics,
    lowest_coverage,
    missing_keys,
    normalize_columns,
    optimize_inventory,
    partition_pruned,
    profile_columns,
    profile_table,
    quality_report,
    rename_source,
    require_columns,
    sales_quality,
    standardize_catalog,
    standardize_inventory,
    top_products,
    validation_report,
)
from shelfwise.operators.signals import attach_clicks, attach_competitor
from shelfwise.session import checkpoint_root, materialize
from shelfwise.sources import testviews as tv
from shelfwise.sources.files import read_table, write_partitioned
from shelfwise.streaming import events as ev

SCALED_HIGH = 0.30
SCALED_MEDIUM = 0.20
PRUNE_YEAR = 1997
NEAR_GAP = "6 hours"

Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------------------
# Shared building blocks
# --------------------------------------------------------------------------

def _tx(spark, d):
    return tv.transactions(spark, d)


def _sales(spark, d):
    return build_master_sales(clean_transactions(_tx(spark, d)),
                              standardize_catalog(tv.product_catalog(spark, d)))


def _demand(spark, d, scaled=True):
    if scaled:
        return demand_analytics(_sales(spark, d), high=SCALED_HIGH, medium=SCALED_MEDIUM)
    return demand_analytics(_sales(spark, d))


def _stock(spark, d):
    return standardize_inventory(tv.inventory(spark, d))


def _inventory_analytics(spark, d):
    return inventory_analytics(_demand(spark, d), _stock(spark, d))


def _parsed_clicks(spark, d):
    return ev.parse_clicks(tv.click_json(spark, d))


def _parsed_quotes(spark, d):
    return ev.parse_quotes(tv.quote_json(spark, d))


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------

def q_clean_transactions(spark, d):
    return clean_transactions(tv.transactions_feed(spark, d))


def q_standardize_catalog(spark, d):
    return standardize_catalog(tv.product_catalog(spark, d))


def q_standardize_inventory(spark, d):
    return standardize_inventory(tv.inventory(spark, d))


def q_master_sales(spark, d):
    return _sales(spark, d)


def q_sales_calendar(spark, d):
    tx = _tx(spark, d).select("invoice_no", "product_id", "invoice_date", "quantity")
    return add_calendar(tx)


def q_master_sales_partition_pruned(spark, d):
    """Write the fact partitioned by (year, month) into the shared
    checkpoint folder, read it back filtered by year: the scan lists only
    that year's folders (PartitionFilters in the plan)."""
    key = "".join(ch if ch.isalnum() else "_" for ch in d)
    # one folder per call: concurrent calls never overwrite each other's files
    path = f"{checkpoint_root(spark)}/tables/master_sales_{key}_{uuid.uuid4().hex[:12]}"
    write_partitioned(_sales(spark, d), path)
    return partition_pruned(read_table(spark, path), year=PRUNE_YEAR)


def q_demand_analytics(spark, d):
    return _demand(spark, d, scaled=False)


def q_demand_levels(spark, d):
    return _demand(spark, d).select("product_id", "product_name", "category",
                                    "average_daily_demand", "demand_level")


def q_top_products(spark, d):
    return top_products(_demand(spark, d, scaled=False), 10)


def q_inventory_analytics(spark, d):
    return _inventory_analytics(spark, d)


def q_stockout_risk(spark, d):
    return _inventory_analytics(spark, d).select(
        "product_id", "product_name", "category", "current_stock", "reorder_level",
        "lead_time_days", "stock_coverage_days", "stockout_risk")


def q_reorder_quantity(spark, d):
    return _inventory_analytics(spark, d).select(
        "product_id", "product_name", "category", "current_stock", "reorder_level",
        "recommended_reorder_quantity")


def q_lowest_coverage(spark, d):
    return lowest_coverage(_inventory_analytics(spark, d), 20)


def q_click_counts(spark, d):
    return click_counts(tv.clicks(spark, d))


def q_click_signal(spark, d):
    return click_counts(tv.clicks(spark, d)).withColumn(
        "real_time_demand_signal", rules.click_signal("real_time_click_count"))


def q_click_counts_attached(spark, d):
    base = _demand(spark, d).select("product_id", "product_name", "category")
    return attach_clicks(base, clicks=tv.clicks(spark, d))


def q_competitor_average(spark, d):
    return competitor_average(tv.competitor_quotes(spark, d))


def q_competitor_attached(spark, d):
    base = _demand(spark, d).select("product_id", "product_name", "category",
                                    "average_selling_price")
    return attach_competitor(base, quotes=tv.competitor_quotes(spark, d))


def q_demand_score(spark, d):
    return _demand(spark, d).select(
        "product_id", "product_name", "category", "demand_level",
        rules.demand_score("demand_level", "legacy").alias("demand_score"),
        rules.demand_score("demand_level", "normalized").alias("demand_score_normalized"))


def _pricing(spark, d, labels, signals=True):
    # One demand frame feeds both inputs, so the chain below it is planned
    # once and its shuffle stages are reused.
    demand = _demand(spark, d)
    return dynamic_pricing(
        demand, inventory_analytics(demand, _stock(spark, d)),
        clicks=tv.clicks(spark, d) if signals else None,
        quotes=tv.competitor_quotes(spark, d) if signals else None,
        labels=labels)


def q_dynamic_pricing(spark, d):
    return _pricing(spark, d, "legacy")


def q_dynamic_pricing_normalized(spark, d):
    return _pricing(spark, d, "normalized")


def q_pricing_without_signals(spark, d):
    return _pricing(spark, d, "legacy", signals=False)


def q_inventory_optimization(spark, d):
    return optimize_inventory(_inventory_analytics(spark, d), clicks=tv.clicks(spark, d))


def q_prepare_transactions(spark, d):
    return _tx(spark, d)


def q_drop_cancelled(spark, d):
    return drop_cancelled(tv.ledger(spark, d))


def q_dedupe_rows(spark, d):
    """The raw ledger, some of whose lines stand twice."""
    return dedupe_rows(tv.ledger(spark, d))


def q_ledger_headers(spark, d):
    """Workbook headers brought to the canonical names."""
    return require_columns(rename_source(normalize_columns(tv.source_ledger(spark, d))))


def q_dropped_rows(spark, d):
    return dropped_rows(tv.ledger(spark, d))


def q_validation_report_prepared(spark, d):
    """The checks over the tables that preparation itself derives. Catalog
    and inventory are derived from written transactions, prepared once."""
    tx = _tx(spark, d)
    lines = materialize(tx.select("product_id", "invoice_no", "invoice_date", "description", "quantity", "unit_price"),
                        "transactions")
    return validation_report(tx, build_catalog(lines, written=True), generate_inventory(historical_demand(lines)))


def q_build_catalog(spark, d):
    return build_catalog(_tx(spark, d))


def q_classify_product(spark, d):
    part = tv.table(spark, d, "part").withColumn("product_name", tv._named(F.col("p_partkey"), F.col("p_name")))
    return part.select(F.col("p_partkey").cast("string").alias("product_id"), "product_name",
                       rules.classify_product("product_name").alias("category"))


def q_lead_time(spark, d):
    ids = _tx(spark, d).select("product_id").distinct()
    return ids.select("product_id", rules.lead_time("product_id").alias("lead_time_days"))


def q_historical_demand(spark, d):
    return historical_demand(_tx(spark, d))


def q_generate_inventory(spark, d):
    return generate_inventory(historical_demand(_tx(spark, d)))


def q_quality_report(spark, d):
    return quality_report(tv.ledger(spark, d), _tx(spark, d))


def q_validation_report(spark, d):
    return validation_report(_tx(spark, d), tv.product_catalog(spark, d),
                             tv.inventory(spark, d))


def q_missing_from_catalog(spark, d):
    return missing_keys(_tx(spark, d), tv.product_catalog(spark, d))


def q_missing_from_inventory(spark, d):
    return missing_keys(_tx(spark, d), tv.inventory(spark, d))


def q_sales_quality(spark, d):
    return sales_quality(_sales(spark, d))


def q_profile_columns(spark, d):
    return profile_columns(tv.ledger(spark, d))


def q_profile_table(spark, d):
    return profile_table(tv.ledger(spark, d))


def q_parse_clickstream(spark, d):
    return _parsed_clicks(spark, d)


def q_parse_competitor(spark, d):
    return _parsed_quotes(spark, d)


def q_clean_clickstream(spark, d):
    return ev.clean_clickstream(_parsed_clicks(spark, d), processed_at=False)


def q_clean_competitor(spark, d):
    return ev.clean_competitor(_parsed_quotes(spark, d), processed_at=False)


def q_event_weight(spark, d):
    return tv.clicks(spark, d).select(
        "event_time", "session_id", "product_id", "event_type",
        rules.event_weight("event_type").alias("demand_signal"))


def q_realtime_pricing(spark, d):
    return ev.realtime_pricing(_parsed_clicks(spark, d), _parsed_quotes(spark, d))


def q_realtime_pricing_near(spark, d):
    """Pairs of a click and a quote at most NEAR_GAP apart, over quotes of
    the clicks' month."""
    return ev.realtime_pricing(_parsed_clicks(spark, d), ev.parse_quotes(tv.quote_json(spark, d, recent=True)),
                               max_gap=NEAR_GAP, clicked_only=True)


def q_events_to_json(spark, d):
    return ev.encode_events(tv.clicks(spark, d))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
