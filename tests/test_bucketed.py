"""Decisions over bucketed tables: no shuffle on either side of a join."""

import io
from contextlib import redirect_stdout

from conftest import SF_SMALL
from shelfwise.operators import click_counts, competitor_average
from shelfwise.plans.queries import _demand, _inventory_analytics, _stock
from shelfwise.plans.tables import decisions_from_buckets, register_bucketed
from shelfwise.sources import testviews as tv


def _all(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_co_located_joins(spark, tmp_dir):
    from shelfwise.operators import dynamic_pricing, inventory_analytics, optimize_inventory
    parts = {"processed/demand_analytics": _demand(spark, SF_SMALL), "raw/inventory": _stock(spark, SF_SMALL),
             "processed/inventory_analytics": _inventory_analytics(spark, SF_SMALL),
             "processed/click_counts": click_counts(tv.clicks(spark, SF_SMALL)),
             "processed/quote_means": competitor_average(tv.competitor_quotes(spark, SF_SMALL))}
    for rel, df in parts.items():
        df.write.parquet(f"{tmp_dir}/{rel}")
    read = {rel: spark.read.parquet(f"{tmp_dir}/{rel}") for rel in parts}
    demand, stock, analytics, counts, means = read.values()
    want = {"inventory_analytics": inventory_analytics(demand, stock),
            "pricing_recommendations": dynamic_pricing(demand, analytics, click_count_table=counts, competitor_table=means),
            "inventory_recommendations": optimize_inventory(analytics, click_count_table=counts)}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from shelfwise.plans.tables import BUCKETED
        names = register_bucketed(spark, tmp_dir, "retail_buckets", buckets=4, tables={
            **BUCKETED, "clicks_by_product": "processed/click_counts", "means_by_product": "processed/quote_means"})
        assert len(names) == 5
        got = decisions_from_buckets(spark, "retail_buckets", "clicks_by_product", "means_by_product")
        for name, df in got.items():
            with redirect_stdout(io.StringIO()) as text:
                df.explain("formatted")
            assert "SortMergeJoin" in text.getvalue() and "Exchange" not in text.getvalue(), name
            assert _all(df) == _all(want[name])
        # from the plain files the same joins shuffle
        with redirect_stdout(io.StringIO()) as text:
            want["pricing_recommendations"].explain("formatted")
        assert "Exchange" in text.getvalue()
        # registering again replaces the tables
        register_bucketed(spark, tmp_dir, "retail_buckets", buckets=2)
        assert _all(decisions_from_buckets(spark, "retail_buckets")["inventory_analytics"]) == _all(want["inventory_analytics"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP DATABASE IF EXISTS retail_buckets CASCADE")
