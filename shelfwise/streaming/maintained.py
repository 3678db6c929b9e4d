"""Maintained signals (A8, A9): click counts and competitor means as a table
of partial sums that grows with the landed files instead of being recomputed
from all of them.

A run reads, as a stream that ends (available-now trigger), the landed files
its checkpoint does not know, reduces them to one row per product and writes
these under ``parts/batch_id=N``. Totals are sums over the parts. A run that
dies before its checkpoint is committed repeats the same files under the same
batch id and writes over what it left, so every file counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.money import money_parts, money_total
from shelfwise.sources.files import read_optional


def _click_parts(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))


def _click_totals(parts: DataFrame) -> DataFrame:
    return parts.groupBy("product_id").agg(F.sum("n").alias("real_time_click_count"))


def _quote_parts(quotes: DataFrame) -> DataFrame:
    return quotes.groupBy("product_id").agg(*money_parts("competitor_price"))


def _quote_totals(parts: DataFrame) -> DataFrame:
    total, n = money_total()
    return parts.groupBy("product_id").agg(F.when(n > 0, total / n).alias("average_competitor_price"))


#: kind -> columns read, schema of the parts, reduction, merge
KINDS: dict[str, tuple[str, str, Callable, Callable]] = {
    "clicks": ("product_id string", "product_id string, n long, batch_id long", _click_parts, _click_totals),
    "quotes": ("product_id string, competitor_price double",
               "product_id string, exact decimal(38,18), plain double, usual long, outer double, n long, batch_id long",
               _quote_parts, _quote_totals),
}


def totals(spark: SparkSession, store: str, kind: str) -> DataFrame:
    """The totals over everything covered so far, in the form of
    ``signals.click_counts`` or ``signals.competitor_average``."""
    _, schema, _, merge = KINDS[kind]
    parts = read_optional(spark, f"{store.rstrip('/')}/parts")
    return merge(parts if parts is not None else spark.createDataFrame([], schema))


def refresh(spark: SparkSession, landed: str, store: str, kind: str, max_files: int | None = None) -> DataFrame:
    """Cover the files landed since the last run and return the totals.

    ``landed`` is a Parquet folder that is only added to (the landing jobs'),
    ``store`` belongs to this function. ``max_files`` bounds a micro-batch.
    """
    columns, schema, reduce, _ = KINDS[kind]
    store = store.rstrip("/")
    reader = spark.readStream.schema(columns)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def add(rows: DataFrame, batch_id: int) -> None:
        (reduce(rows).withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{store}/parts"))

    (reader.parquet(landed).writeStream.foreachBatch(add).option("checkpointLocation", f"{store}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return totals(spark, store, kind)
