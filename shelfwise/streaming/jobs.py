"""Stream sources, sinks and the three landing jobs (M7, M8, M9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise import schemas
from shelfwise.sources.files import read_optional
from shelfwise.streaming import events as ev

DEFAULT_TRIGGER = "10 seconds"


def read_topic(spark: SparkSession, topic: str | None = None, fmt: str = "kafka",
               path: str | None = None, bootstrap: str = "localhost:9092",
               starting_offsets: str = "latest", **options) -> DataFrame:
    """A stream of raw event values.

    ``fmt="kafka"`` subscribes to ``topic`` (latest offsets on first
    start, then the checkpoint; lost offsets tolerated). ``fmt="text"``
    reads newline-delimited JSON files from ``path`` (column ``value``),
    the form used in tests; it keeps at most ``maxFilesPerTrigger`` files
    per micro-batch when given.
    """
    if fmt == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap)
                  .option("subscribe", topic)
                  .option("startingOffsets", starting_offsets)
                  .option("failOnDataLoss", "false"))
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.load()
    reader = spark.readStream.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def peek_topic(spark: SparkSession, topic: str | None, schema, bootstrap: str = "localhost:9092",
               n: int = 20, fmt: str = "kafka", path: str | None = None) -> DataFrame:
    """Bounded batch read from the earliest offset, with partition,
    offset and the parsed fields (a debugging view of a topic). ``fmt="text"``
    reads newline-delimited JSON from ``path``; each file is a partition and
    the offset numbers its lines' order in the scan."""
    if fmt == "kafka":
        raw = (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap)
               .option("subscribe", topic).option("startingOffsets", "earliest").load())
    else:
        raw = spark.read.format(fmt).load(path).select(
            F.spark_partition_id().alias("partition"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("offset"), "value")
    parsed = raw.select("partition", "offset",
                        F.from_json(F.col("value").cast("string"), schema).alias("data"))
    return parsed.select("partition", "offset", "data.*").limit(n)


def write_stream(df: DataFrame, path: str, checkpoint: str, trigger: str = DEFAULT_TRIGGER,
                 available_now: bool = False, query_name: str | None = None,
                 partition_by: list[str] | None = None) -> StreamingQuery:
    """Append to Parquet with a checkpoint (exactly-once file
    sink); fixed-interval trigger, or ``available_now`` for tests and
    catch-up runs."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def _checkpoint(path: str, checkpoint: str | None) -> str:
    """The given checkpoint, else the one that belongs to the output: beside
    it, so that output and offsets are never taken from different runs."""
    return checkpoint or f"{path.rstrip('/')}.checkpoint"


def by_date(df: DataFrame) -> DataFrame:
    """Adds the partition column of dated landings: the event's date (UTC
    session), null for an event without a readable time."""
    return df.withColumn("event_date", F.to_date("event_timestamp"))


def _land(raw: DataFrame, path: str, checkpoint: str | None, schema, required: list[str], clean,
          rejected: str | None, dated: bool, trigger: str, available_now: bool, query_name: str | None) -> StreamingQuery:
    checkpoint = _checkpoint(path, checkpoint)
    if not rejected:
        df = clean(ev.parse_events(raw, schema))
        return write_stream(by_date(df) if dated else df, path, checkpoint, trigger, available_now, query_name,
                            partition_by=["event_date"] if dated else None)

    def land(lines: DataFrame, batch_id: int) -> None:
        # Both outputs come from one parse; a repeated batch writes over itself.
        lines = lines.persist()
        try:
            kept = clean(lines.where("reason is null").drop("value", "reason"))
            for rows, target, cols in ((by_date(kept) if dated else kept, path, ["event_date"] if dated else []),
                                       (lines.where("reason is not null").select("value", "reason"), rejected, [])):
                (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", *cols).parquet(target))
        finally:
            lines.unpersist()

    w = ev.parse_checked(raw, schema, required).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()


def land_clickstream(raw: DataFrame, path: str, checkpoint: str | None = None, rejected: str | None = None,
                     dated: bool = False, trigger: str = DEFAULT_TRIGGER, available_now: bool = False,
                     query_name: str | None = None) -> StreamingQuery:
    """M7: raw click values -> parsed, cleaned, weighted -> Parquet.

    ``rejected`` names a folder for the lines that cleaning drops, each with
    its reason: every line read lands in exactly one of the two, both
    partitioned by the micro-batch (``batch_id``), which overwrites itself
    when repeated. ``dated`` partitions the landing by event date.
    """
    return _land(raw, path, checkpoint, schemas.CLICK_EVENT, ev.CLICK_REQUIRED, ev.clean_clickstream, rejected, dated,
                 trigger, available_now, query_name)


def land_competitor_prices(raw: DataFrame, path: str, checkpoint: str | None = None, rejected: str | None = None,
                           dated: bool = False, trigger: str = DEFAULT_TRIGGER, available_now: bool = False,
                           query_name: str | None = None) -> StreamingQuery:
    """M8: raw quote values -> parsed, cleaned -> Parquet; see
    :func:`land_clickstream`."""
    return _land(raw, path, checkpoint, schemas.COMPETITOR_EVENT, ev.QUOTE_REQUIRED, ev.clean_competitor, rejected, dated,
                 trigger, available_now, query_name)


# Streams run with a width of their own: every micro-batch touches all
# partitions of the state store.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.shuffle.partitions": "48",
}


REALTIME_SCHEMA = ("window_start timestamp, product_id string, demand_score int, competitor string, "
                   "competitor_price double, availability boolean, pricing_action string, pair_count long, "
                   "processed_at timestamp")


def land_realtime_pricing(raw_clicks: DataFrame, raw_quotes: DataFrame, path: str,
                          checkpoint: str | None = None, max_gap: str = "1 hour",
                          lateness: str = "10 minutes", trigger: str = DEFAULT_TRIGGER,
                          available_now: bool = False, query_name: str | None = None) -> StreamingQuery:
    """M9: both raw streams -> counted pairs at most ``max_gap`` apart ->
    Parquet, append only.

    Spark's state store keeps the events of open windows, two rows each. When
    the watermark (the smaller of the two sources' latest event times less
    ``lateness``) passes a window's end, its events leave the state and its
    pairs (those whose later event it holds) are counted by running totals.
    After a restart the watermark is taken up from the checkpoint, and a
    window whose end it had not passed waits for the next events of *both*
    sources: it comes out with them, whole.

    A micro-batch writes the folder ``batch_id=N`` and, when it is repeated
    after a failure, writes the same rows over it.
    """
    spark = raw_clicks.sparkSession
    if read_optional(spark, path) is None:  # readers find a table before the first window closes
        spark.createDataFrame([], REALTIME_SCHEMA).write.mode("append").parquet(f"{path.rstrip('/')}/batch_id=-1")
    gap = ev.gap_micros(spark, max_gap)
    entries = ev.near_entries(ev.parse_clicks(raw_clicks), ev.parse_quotes(raw_quotes), gap, lateness)

    def land(closed: DataFrame, batch_id: int) -> None:
        rows = ev.with_processed_at(ev.priced(ev.near_pairs(closed, gap)))
        (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    w = entries.writeStream.outputMode("append").foreachBatch(land).option(
        "checkpointLocation", _checkpoint(path, checkpoint))
    if query_name:
        w = w.queryName(query_name)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()
