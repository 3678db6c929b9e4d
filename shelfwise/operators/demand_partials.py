"""Demand analytics kept up by month (M3; A1 to A7).

Sums, extremes and money parts add up over months; distinct invoices and
customers do not. Their ids are numbered densely in a dictionary that only
grows, and a product's ids of a month become bitmaps: one per 32,768 numbers
that occur. A refresh reads the months it is told of, replaces their partials
in one commit, and derives the full result from the partials of all months,
with exact distinct counts (bits set in the union of the bitmaps).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions import rules
from shelfwise.functions.money import money_parts, money_total
from shelfwise.operators.demand import GRAIN, with_rules
from shelfwise.session import materialize
from shelfwise.sources.files import read_optional, restate_partitions

IDS = {"invoices": "invoice_no", "customers": "customer_id"}


def _numbered(values: DataFrame, start: int) -> DataFrame:
    """(value, id): distinct values numbered from ``start`` on without gaps.
    Ranges of values are numbered in parallel; one row per range gives their
    offsets."""
    ranged = materialize(values.repartitionByRange("value").withColumn("_p", F.spark_partition_id()), "new-ids")
    offsets = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n")).select("_p", F.coalesce(
        F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy("value"))
    return ranged.join(offsets, "_p").select("value", (F.lit(start - 1) + F.col("_before") + inside).cast("long").alias("id"))


def _dictionary(spark: SparkSession, path: str, values: DataFrame) -> DataFrame:
    """The numbers of all values, after new ones were appended."""
    have = read_optional(spark, path)
    values = values.where("value is not null").distinct()
    start = 0
    if have is not None:
        start = (have.agg(F.max("id")).first()[0] or -1) + 1
        values = values.join(have, "value", "left_anti")
    _numbered(values, start).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def refresh_demand(spark: SparkSession, sales: DataFrame, store: str, months: list[tuple[int, int]],
                   high: float = rules.DEMAND_HIGH, medium: float = rules.DEMAND_MEDIUM) -> DataFrame:
    """Take up some (year, month) of ``sales`` (the fact, partitioned by
    them) again and return the analytics of all months taken up so far, equal
    to ``demand_analytics`` of these months. Other months are not read; a
    named month without rows keeps its old partials."""
    store = store.rstrip("/")
    wanted = F.lit(False)
    for y, m in months:
        wanted = wanted | ((F.col("year") == y) & (F.col("month") == m))
    new = sales.where(wanted)
    rows = new
    for kind, col in IDS.items():
        ids = _dictionary(spark, f"{store}/ids/{kind}", new.select(F.col(col).alias("value")))
        rows = rows.join(ids.select(F.col("value").alias(col), F.col("id").alias(f"_{kind}")), col, "left")
    by = ["year", "month", *GRAIN]
    measures = new.groupBy(*by).agg(
        F.sum("quantity").alias("quantity"), F.count("quantity").alias("lines"),
        F.struct(*money_parts("revenue")).alias("revenue"), F.struct(*money_parts("unit_price")).alias("price"),
        F.min("sale_date").alias("first"), F.max("sale_date").alias("last"))
    parts = measures
    for kind in IDS:
        number = F.col(f"_{kind}")
        parts = parts.unionByName(
            rows.where(number.isNotNull()).groupBy(*by, F.bitmap_bucket_number(number).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")).withColumn("kind", F.lit(kind)),
            allowMissingColumns=True)
    restate_partitions(parts, f"{store}/partials")
    return demand_from_partials(spark, store, high, medium)


def demand_from_partials(spark: SparkSession, store: str, high: float = rules.DEMAND_HIGH,
                         medium: float = rules.DEMAND_MEDIUM) -> DataFrame:
    """The analytics over the partials of all months."""
    parts = spark.read.parquet(f"{store.rstrip('/')}/partials")
    bits = parts.where("kind is not null").groupBy(*GRAIN, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = bits.groupBy(*GRAIN).agg(*[F.sum(F.when(F.col("kind") == k, F.bitmap_count("bits"))).alias(f"n_{k}") for k in IDS])
    # Both sides have few rows a product; a null name or category stays a key.
    both = parts.where("kind is null").select(*GRAIN, "quantity", "lines", "revenue", "price", "first", "last").unionByName(
        counts, allowMissingColumns=True)
    revenue, _ = money_total("revenue")
    price, prices = money_total("price")
    lines = F.sum("lines")
    return with_rules(both.groupBy(*GRAIN).agg(
        F.sum("quantity").alias("total_quantity_sold"),
        F.coalesce(F.sum("n_invoices"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.sum("n_customers"), F.lit(0)).alias("unique_customers"),
        revenue.alias("_revenue"), F.when(lines > 0, F.sum("quantity").cast("double") / lines).alias("_avg_qty"),
        F.when(prices > 0, price / prices).alias("_avg_price"),
        F.min("first").alias("first_sale_date"), F.max("last").alias("last_sale_date")), high, medium)
