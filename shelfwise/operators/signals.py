"""Market signals: click counts and competitor price means (A8, A9, J4-J6,
P24, P25)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.money import money_mean


def click_counts(clicks: DataFrame, since=None, event_types=None) -> DataFrame:
    """Events per product (every type, all time by default).

    A hash aggregate with a map-side partial count: a product holding a
    third of all events still sends one row per map task.
    """
    df = clicks
    if since is not None:
        df = df.filter(F.col("event_timestamp") >= F.lit(since))
    if event_types is not None:
        df = df.filter(F.col("event_type").isin(list(event_types)))
    return df.groupBy("product_id").agg(F.count(F.lit(1)).alias("real_time_click_count"))


def competitor_average(quotes: DataFrame, available_only: bool = False) -> DataFrame:
    """Mean competitor price per product (nulls skipped; by default
    unavailable offers count too, as in the source job)."""
    df = quotes.filter(F.col("availability")) if available_only else quotes
    return df.groupBy("product_id").agg(
        money_mean("competitor_price").alias("average_competitor_price"))


def _has(df: DataFrame | None, *cols: str) -> bool:
    return df is not None and all(c in df.columns for c in cols)


def attach_clicks(df: DataFrame, clicks: DataFrame | None = None,
                  counts: DataFrame | None = None) -> DataFrame:
    """J4/J5 + P24/P25: left-join click counts; missing means 0 (bigint).

    Pass ``counts`` (from :func:`click_counts`) to reuse one aggregation
    across jobs; otherwise ``clicks`` is aggregated here. A missing input,
    or one without ``product_id``, yields 0 for every product.
    """
    if counts is None and _has(clicks, "product_id"):
        counts = click_counts(clicks)
    if counts is None:
        return df.withColumn("real_time_click_count", F.lit(0).cast("bigint"))
    return df.join(counts, on="product_id", how="left").withColumn(
        "real_time_click_count",
        F.coalesce(F.col("real_time_click_count"), F.lit(0).cast("bigint")))


def attach_competitor(df: DataFrame, quotes: DataFrame | None = None,
                      averages: DataFrame | None = None,
                      available_only: bool = False) -> DataFrame:
    """J6 + P25: left-join the competitor mean; missing means null."""
    if averages is None and _has(quotes, "product_id", "competitor_price"):
        averages = competitor_average(quotes, available_only=available_only)
    if averages is None:
        return df.withColumn("average_competitor_price", F.lit(None).cast("double"))
    return df.join(averages, on="product_id", how="left")
