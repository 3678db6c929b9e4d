"""Compaction of landed events (K3, M7, M8).

A landing job writes a set of small files every few seconds. Compaction copies
what landed since its last run into few large files by event date, beside the
landing; it deletes nothing, so readers that run meanwhile are not disturbed.
What is covered is told by the micro-batch time (``processed_at``): batches
follow one another, so when the latest committed one is of time t, no row of
that time or before will still arrive. The finished runs are listed in a small
table of cuts, written last; a run that died leaves files that no cut names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sources.files import read_optional
from shelfwise.streaming.jobs import by_date

_CUT = "unix_micros(processed_at)"


def _cuts(spark: SparkSession, target: str) -> list[int]:
    """Cuts of the finished runs, in order (one per run)."""
    done = read_optional(spark, f"{target.rstrip('/')}/cuts")
    return sorted(r["cut"] for r in done.select("cut").distinct().collect()) if done is not None else []


def _dated(df: DataFrame) -> DataFrame:
    return df if "event_date" in df.columns else by_date(df)


def compact(spark: SparkSession, landed: str, target: str, max_records: int = 5_000_000) -> int:
    """Copy the rows landed since the last run to ``target`` and return how
    many they are. A date gets one file a run, or several of ``max_records``
    rows (and such as AQE's partition size asks for); a repeated run over the
    same rows writes over what it left."""
    target = target.rstrip("/")
    source = _dated(spark.read.parquet(landed))
    cuts = _cuts(spark, target)
    new = source.where(f"{_CUT} > {cuts[-1]}") if cuts else source
    head = new.agg(F.max(F.expr(_CUT)).alias("cut"), F.count("processed_at").alias("n")).first()
    if head["cut"] is None:
        return 0
    rows = new.where(f"{_CUT} <= {head['cut']}").withColumn("cut", F.lit(head["cut"]).cast("long"))
    (rows.hint("rebalance", "event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records).partitionBy("cut", "event_date").parquet(f"{target}/events"))
    # The cut makes the run count; it is one row, so one file that is there or not.
    spark.range(1).select(F.lit(head["cut"]).cast("long").alias("cut"), F.lit(head["n"]).alias("rows")).coalesce(1) \
        .write.mode("append").parquet(f"{target}/cuts")
    return head["n"]


def read_landed(spark: SparkSession, landed: str, target: str) -> DataFrame:
    """All landed rows: the compacted ones, and from the landing only those
    after the last cut. Filters on ``event_date`` prune the compacted folders;
    what was landed later is found by the row group statistics of its time."""
    source = _dated(spark.read.parquet(landed))
    cuts = _cuts(spark, target)
    if not cuts:
        return source
    done = spark.read.parquet(f"{target.rstrip('/')}/events").where(F.col("cut").isin(cuts))
    return done.select(*source.columns).unionByName(source.where(f"{_CUT} > {cuts[-1]}"))
