"""Correctness when one product holds a third of all rows (hot key):
grouped results against a pandas brute force on the same rows."""

import datetime as dt
import itertools

import pandas as pd
from pyspark.sql import functions as F

from shelfwise.operators import build_master_sales, demand_analytics, standardize_catalog
from shelfwise.streaming.events import realtime_pricing


def _sales_rows(n=6000):
    rows = []
    for i in range(n):
        pid = "HOT" if i % 3 == 0 else f"P{i % 97}"
        rows.append((f"{i // 4}", pid, f"desc {pid}", 1 + i % 5,
                     dt.datetime(2024, 1, 1 + i % 28, i % 24), round(0.5 + (i % 13) * 0.25, 2),
                     "UK", f"c{i % 50}", 0.0))
    return [r[:8] + (round(r[3] * r[5], 2),) for r in rows]


def test_demand_with_hot_product(spark):
    rows = _sales_rows()
    schema = ("invoice_no string, product_id string, description string, quantity int, "
              "invoice_date timestamp, unit_price double, country string, "
              "customer_id string, revenue double")
    tx = spark.createDataFrame(rows, schema).repartition(7)
    cat = spark.createDataFrame([("HOT", "Hot item", "MUG", 1.0)],
                                "product_id string, product_name string, category string, "
                                "selling_price double")
    got = {r.product_id: r for r in demand_analytics(
        build_master_sales(tx, standardize_catalog(cat))).collect()}
    pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    hot = pdf[pdf.product_id == "HOT"]
    g = got["HOT"]
    assert g.total_quantity_sold == hot.quantity.sum()
    assert g.total_orders == hot.invoice_no.nunique()
    assert g.unique_customers == hot.customer_id.nunique()
    assert abs(g.total_revenue - round(hot.revenue.sum(), 2)) < 1e-6
    assert abs(g.average_selling_price - round(hot.unit_price.mean(), 2)) < 1e-9
    assert len(got) == pdf.product_id.nunique()


def test_realtime_pairs_with_hot_product(spark):
    clicks = [(("HOT" if i % 3 == 0 else f"P{i % 11}"),
               ["purchase", "view", "add_to_cart", "search"][i % 4]) for i in range(3000)]
    quotes = [(("HOT" if i % 3 == 0 else f"P{i % 11}"), f"C{i % 4}", float(5 + i % 7),
               i % 5 != 0) for i in range(2000)]
    c = spark.createDataFrame(clicks, "product_id string, event_type string")
    q = spark.createDataFrame(quotes, "product_id string, competitor string, "
                                      "competitor_price double, availability boolean")
    out = realtime_pricing(c, q)
    total = out.agg(F.sum("pair_count")).first()[0]
    brute = sum(1 for a, b in itertools.product(clicks, quotes) if a[0] == b[0])
    assert total == brute
    # output rows are bounded by 5 weights x distinct quotes, not by pairs
    assert out.count() <= 5 * q.distinct().count() < brute


def test_near_pairs_of_a_hot_product_are_counted_not_listed(spark):
    """8,000 clicks and 8,000 quotes of one product within minutes: 64
    million pairs, from rows that grow with the events."""
    import datetime as dt
    import io
    from contextlib import redirect_stdout
    start = dt.datetime(2024, 1, 1)
    n = 8000
    at = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 1200), "yyyy-MM-dd'T'HH:mm:ss")
    c = spark.range(n).select(at.alias("event_time"), F.lit("HOT").alias("product_id"),
                              F.when(F.col("id") % 2 == 0, "purchase").otherwise("view").alias("event_type"))
    q = spark.range(n).select(at.alias("event_time"), F.lit("HOT").alias("product_id"), F.lit("S").alias("competitor"),
                              F.lit(2.0).alias("competitor_price"), F.lit(True).alias("availability"))
    out = realtime_pricing(c, q, max_gap="30 minutes")
    rows = out.collect()
    assert len(rows) == 2 and sum(r["pair_count"] for r in rows) == n * n
    assert {r["window_start"] for r in rows} == {start}
    with redirect_stdout(io.StringIO()) as text:
        out.explain("formatted")
    assert "Join" not in text.getvalue()


def test_hot_product_join_is_split_by_aqe(spark):
    """Without broadcasts, the sales join must let AQE split the hot
    product's partition (thresholds scaled down to the test size)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        tx = spark.range(n).select(
            F.col("id").cast("string").alias("invoice_no"),
            F.when(F.col("id") % 3 == 0, F.lit("HOT"))
             .otherwise((F.col("id") % 500).cast("string")).alias("product_id"),
            F.lit("d").alias("description"), F.lit(1).alias("quantity"),
            F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("invoice_date"),
            F.lit(2.0).alias("unit_price"), F.lit("UK").alias("country"),
            F.lit("c").alias("customer_id"), F.lit(2.0).alias("revenue"))
        cat = spark.range(500).select(
            F.col("id").cast("string").alias("product_id"), F.lit("n").alias("product_name"),
            F.lit("OTHER").alias("category"), F.lit(1.0).alias("selling_price"))
        cat = cat.union(spark.createDataFrame([("HOT", "hot", "MUG", 1.0)], cat.schema))
        out = build_master_sales(tx, standardize_catalog(cat))
        rows = out.collect()
        assert len(rows) == n
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final and "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _without_broadcasts(spark, more=()):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", **dict(more)}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _odd_sales(spark, n=60000):
    tx = spark.range(n).select(
        F.when(F.col("id") % 7 != 0, (F.col("id") % 20000).cast("string")).alias("invoice_no"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 500).cast("string")).alias("product_id"),
        F.when(F.col("id") % 4 != 0, F.lit("d")).alias("description"), F.lit(1).alias("quantity"),
        F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("invoice_date"),
        F.lit(2.0).alias("unit_price"), F.lit("UK").alias("country"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 11).cast("string")).alias("customer_id"), F.lit(2.0).alias("revenue"))
    cat = spark.range(250).select(F.col("id").cast("string").alias("product_id"), F.lit("n").alias("product_name"),
                                  F.lit("OTHER").alias("category"), F.lit(1.0).alias("selling_price"))
    return build_master_sales(tx, standardize_catalog(cat))


def _counted_plainly(sales):
    return {(r.product_id, r.product_name, r.category): (r.o, r.c) for r in sales.groupBy(
        "product_id", "product_name", "category").agg(
        F.count_distinct("invoice_no").alias("o"), F.count_distinct("customer_id").alias("c")).collect()}


def test_demand_counts_distinct_values_where_the_join_left_the_lines(spark):
    """After a sort-merge join by product no line is shuffled again, and none
    is doubled for the two distinct counts. Null ids count as none."""
    old = _without_broadcasts(spark)
    try:
        sales = _odd_sales(spark)
        out = demand_analytics(sales)
        plan = out._jdf.queryExecution().executedPlan().toString()
        above = plan[:plan.index("SortMergeJoin")]
        assert "Expand" not in plan and "Exchange" not in above
        got = {(r.product_id, r.product_name, r.category): (r.total_orders, r.unique_customers) for r in out.collect()}
        assert got == _counted_plainly(sales)
    finally:
        _restore(spark, old)


def test_demand_of_a_split_hot_product(spark):
    """A hot product that AQE cuts between tasks is counted by (product,
    value), and right."""
    old = _without_broadcasts(spark, {
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}.items())
    try:
        sales = _odd_sales(spark)
        out = demand_analytics(sales)
        got = {(r.product_id, r.product_name, r.category): (r.total_orders, r.unique_customers) for r in out.collect()}
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final
        assert got == _counted_plainly(sales)
    finally:
        _restore(spark, old)


def test_near_pairs_drop_quotes_of_products_without_clicks(spark):
    """The same pairs, and the other quotes go before their times are parsed."""
    clicks = spark.createDataFrame(
        [("2024-01-01T00:00:00", "A", "purchase"), ("2024-01-01T01:00:00", "A", "view"), ("2024-01-01T00:00:00", None, "view"),
         ("soon", "B", "view")], "event_time string, product_id string, event_type string")
    quotes = spark.createDataFrame(
        [("2024-01-01T00:30:00", p, "S", 2.0, True) for p in ("A", "A", "B", "C", None)],
        "event_time string, product_id string, competitor string, competitor_price double, availability boolean")
    all_rows = realtime_pricing(clicks, quotes, max_gap="1 hour")
    some = realtime_pricing(clicks, quotes, max_gap="1 hour", clicked_only=True)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, all_rows.collect())) != []
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join LeftSemi")
    assert "try_to_timestamp" not in plan[join:].split("LocalRelation")[0].lower()
    from conftest import SF_SMALL

    from shelfwise.plans.queries import QUERIES
    assert "LeftSemi" in QUERIES["realtime_pricing_near"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
