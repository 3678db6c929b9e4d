"""Event parsing, cleaning and the real-time pricing join.

Every function here is a plain DataFrame transform, so the same code runs
on a batch frame (tests, back-fills, the oracle check) and on a streaming
frame (landing jobs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas
from shelfwise.functions import rules

REALTIME_COLUMNS = ["product_id", "demand_score", "competitor", "competitor_price",
                    "availability", "pricing_action", "pair_count"]


def parse_events(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """T1 + T2: bytes or text -> JSON struct by the declared schema -> columns.

    Malformed text, the literal null and an empty object all yield a row
    of nulls (permissive mode); a field of the wrong type is null on its
    own; unknown fields are ignored.
    """
    text = F.col(value).cast("string")
    # The struct is unpacked by a generator over a one-element array: a
    # Generate is a barrier for predicate pushdown, so the cleaning filters
    # downstream read the parsed columns instead of each re-inlining (and
    # re-running) from_json; every line is parsed exactly once.
    return df.select(F.inline(F.array(F.from_json(text, schema))))


def parse_checked(df: DataFrame, schema: T.StructType, required: list[str], value: str = "value") -> DataFrame:
    """T1 + T2 with the line kept: the fields of the schema, ``value`` as text
    and ``reason`` why the line is none to land (null: it is): "malformed" for
    text that is no JSON object or has a field of the wrong type, "no x" for
    the first required field that is missing. Parsed once, as in
    :func:`parse_events`."""
    text = F.col(value).cast("string")
    broken = "_broken"
    parsed = F.from_json(text, T.StructType([*schema.fields, T.StructField(broken, T.StringType())]),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken})
    rows = df.select(text.alias("value"), F.inline(F.array(F.struct(parsed.alias("e")))))
    none = F.col("e").isNull() | F.col(f"e.{broken}").isNotNull() | ~F.coalesce(F.trim("value").startswith("{"), F.lit(False))
    reason = F.when(none, "malformed")
    for name in required:
        reason = reason.when(F.col(f"e.{name}").isNull(), f"no {name}")
    return rows.select("value", reason.alias("reason"), *[F.col(f"e.{f.name}").alias(f.name) for f in schema.fields])


def with_event_timestamp(df: DataFrame, source: str = "event_time",
                         target: str = "event_timestamp") -> DataFrame:
    """The event time as a timestamp; unparsable text gives null and the
    row stays. A text without a zone is UTC whatever the session's zone is;
    an offset in the text is honoured."""
    text = F.trim(F.col(source))
    zoned = text.rlike(r"([zZ]|[+-]\d{2}:?\d{2})$") & text.contains(":")
    parsed = F.coalesce(F.try_to_timestamp(F.when(zoned, text).otherwise(F.concat(text, F.lit("Z")))),
                        F.try_to_timestamp(F.concat(text, F.lit("T00:00:00Z"))))
    return df.withColumn(target, parsed)


def with_processed_at(df: DataFrame) -> DataFrame:
    """Time of the (micro-)batch."""
    return df.withColumn("processed_at", F.current_timestamp())


CLICK_REQUIRED = ["product_id", "event_type", "event_time"]
QUOTE_REQUIRED = ["product_id", "competitor_price", "competitor"]


def clean_clickstream(parsed: DataFrame, processed_at: bool = True) -> DataFrame:
    """Required fields present, timestamps, demand signal."""
    df = parsed.filter(F.col("product_id").isNotNull()
                       & F.col("event_type").isNotNull()
                       & F.col("event_time").isNotNull())
    df = with_event_timestamp(df)
    if processed_at:
        df = with_processed_at(df)
    return df.withColumn("demand_signal", rules.event_weight("event_type"))


def clean_competitor(parsed: DataFrame, processed_at: bool = True) -> DataFrame:
    """Product, price and competitor present, timestamps."""
    df = parsed.filter(F.col("product_id").isNotNull()
                       & F.col("competitor_price").isNotNull()
                       & F.col("competitor").isNotNull())  # dropna would take NaN for missing
    df = with_event_timestamp(df)
    return with_processed_at(df) if processed_at else df


def encode_events(df: DataFrame) -> DataFrame:
    """K7: each row as one UTF-8 JSON ``value`` (the Kafka sink's input)."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
                     .alias("value"))


# --------------------------------------------------------------------------
# Real-time pricing
# --------------------------------------------------------------------------

def _time(df: DataFrame) -> list[str]:
    return [c for c in ("event_timestamp",) if c in df.columns]


def realtime_clicks(parsed_clicks: DataFrame) -> DataFrame:
    """T5 + R16: click side of the join (event type may be null)."""
    return (parsed_clicks.filter(F.col("product_id").isNotNull())
            .select("product_id", rules.event_weight("event_type").alias("demand_score"), *_time(parsed_clicks)))


def realtime_quotes(parsed_quotes: DataFrame) -> DataFrame:
    """T5: quote side of the join (price may be null)."""
    return (parsed_quotes.filter(F.col("product_id").isNotNull())
            .select("product_id", "competitor", "competitor_price", "availability", *_time(parsed_quotes)))


CLICK_KEYS = ["product_id", "demand_score"]
QUOTE_KEYS = ["product_id", "competitor", "competitor_price", "availability"]


def _grouped(df: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Events reduced to distinct keys with their number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))


#: Every weight an event can have.
SCORES = sorted({0, *rules.EVENT_WEIGHTS.values()})
ENTRY_KEYS = ["product_id", "at", "demand_score", "competitor", "competitor_price", "availability"]


def gap_micros(spark: SparkSession, max_gap: str) -> int:
    gap = spark.range(1).select(F.expr(f"unix_micros(timestamp_seconds(0) + interval '{max_gap}')")).first()[0]
    if gap <= 0:
        raise ValueError(f"max_gap must be positive, not {max_gap!r}")
    return gap


def timed_events(clicks: DataFrame, quotes: DataFrame) -> DataFrame:
    """Clicks and quotes under one another: ENTRY_KEYS and event_timestamp.
    Quotes have no ``demand_score``; events without a time are left out."""
    at = F.unix_micros("event_timestamp").alias("at")
    none = F.lit(None)
    left = clicks.select("event_timestamp", "product_id", at, "demand_score", none.cast("string").alias("competitor"),
                         none.cast("double").alias("competitor_price"), none.cast("boolean").alias("availability"))
    right = quotes.select("event_timestamp", "product_id", at, none.cast("int").alias("demand_score"), "competitor",
                          "competitor_price", "availability")
    return left.union(right).where(F.col("event_timestamp").isNotNull())


def near_pairs(entries: DataFrame, gap: int) -> DataFrame:
    """Pairs of a click and a quote of one product at most ``gap``
    microseconds apart, counted by running totals.

    ``entries``: ENTRY_KEYS, ``n`` (events the row stands for) and ``later``,
    the start of a window of length ``gap``. Each event is entered under its
    own window and under the next; a pair is counted in the window of its
    later event. In there a quote of the window meets every click from ``at -
    gap`` on, and a quote of the window before every click of the window up to
    ``at + gap``: differences of running totals over the clicks in time order,
    one per weight. Rows and work grow with the events, never with the pairs.
    A product is one group per window, sorted with spill.
    """
    at, later, click = F.col("at"), F.col("later"), F.col("demand_score").isNotNull()
    own = at >= later
    # In time order; at one time look-backs come before clicks, look-aheads after.
    rows = entries.select("*", own.alias("own"), F.when(click, at).when(own, at - gap).otherwise(at + gap).alias("x"),
                          F.when(click, 1).when(own, 0).otherwise(2).alias("turn"))
    group = Window.partitionBy("later", "product_id")
    so_far = group.orderBy("x", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    clicks = {s: F.when(F.col("demand_score") == s, F.col("n")) for s in SCORES}
    zero = F.lit(0).cast("long")
    rows = rows.select(
        "later", *QUOTE_KEYS, "own", "n", click.alias("click"),
        *[F.coalesce(F.sum(clicks[s]).over(so_far), zero).alias(f"before{i}") for i, s in enumerate(SCORES)],
        *[F.coalesce(F.sum(F.when(F.col("own") == (half == "own"), clicks[s])).over(group), zero).alias(f"{half}{i}")
          for i, s in enumerate(SCORES) for half in ("own", "old")]).where(~F.col("click"))
    met = [F.when(F.col("own"), F.col(f"own{i}") + F.col(f"old{i}") - F.col(f"before{i}"))
           .otherwise(F.col(f"before{i}") - F.col(f"old{i}")) for i in range(len(SCORES))]
    totals = rows.groupBy("later", *QUOTE_KEYS).agg(
        *[F.sum(F.col("n") * m).alias(f"pairs{i}") for i, m in enumerate(met)])
    by_score = F.inline(F.array(*[F.struct(F.lit(s).alias("demand_score"), F.col(f"pairs{i}").alias("pair_count"))
                                  for i, s in enumerate(SCORES)]))
    return (totals.select(F.timestamp_micros("later").alias("window_start"), *QUOTE_KEYS, by_score)
            .where("pair_count > 0"))


def priced(pairs: DataFrame) -> DataFrame:
    """R17 on counted pairs."""
    return pairs.select(
        *[c for c in ("window_start",) if c in pairs.columns], "product_id", "demand_score", *QUOTE_KEYS[1:],
        rules.realtime_action("demand_score", "competitor_price").alias("pricing_action"), "pair_count")


def of_clicked(parsed_clicks: DataFrame, parsed_quotes: DataFrame) -> DataFrame:
    """Quotes of products that have a click; no other can be in a pair. The
    products are few beside the quotes and often broadcast, so the rest goes
    before its times are parsed and before anything is shuffled."""
    clicked = parsed_clicks.select("product_id").where(F.col("product_id").isNotNull()).distinct()
    return parsed_quotes.join(clicked, "product_id", "left_semi")


def realtime_pricing(parsed_clicks: DataFrame, parsed_quotes: DataFrame, max_gap: str | None = None,
                     clicked_only: bool = False) -> DataFrame:
    """Every click x quote pair of a product with its pricing action (batch
    frames; for streams see ``jobs.land_realtime_pricing``).

    The source job emits one row per pair (a product with c clicks and q
    quotes gives c*q rows, quadratic in a hot product). The action only
    depends on (score, price), so each output row stands for ``pair_count``
    pairs of a product, score and quote: the multiset of pairs is kept whole
    while the output grows with the number of distinct quotes (times at most
    as many scores as there are).

    Without ``max_gap`` a quote meets every earlier and later click, as in
    the source job. With it, pairs are those whose event times are at most
    that far apart, on either side of any clock time: the frame gains
    ``window_start``, the start of the window of that length with the pair's
    later event, ``pair_count`` is per window, and events without a time
    (null) pair with none. Pairs are counted, never listed: see
    :func:`near_pairs`. ``clicked_only`` drops the quotes of products without
    a click first (:func:`of_clicked`), at the price of reading the clicks
    twice; the result is the same.
    """
    if parsed_clicks.isStreaming or parsed_quotes.isStreaming:
        raise ValueError("streams are paired by land_realtime_pricing, which bounds its state by max_gap and lateness")
    if not max_gap:
        pairs = _grouped(realtime_clicks(parsed_clicks), CLICK_KEYS, "click_events").join(
            _grouped(realtime_quotes(parsed_quotes), QUOTE_KEYS, "quote_events"), ["product_id"])
        return priced(pairs.withColumn("pair_count", F.col("click_events") * F.col("quote_events")))
    if clicked_only:
        parsed_quotes = of_clicked(parsed_clicks, parsed_quotes)
    gap = gap_micros(parsed_clicks.sparkSession, max_gap)
    events = timed_events(realtime_clicks(with_event_timestamp(parsed_clicks)),
                          realtime_quotes(with_event_timestamp(parsed_quotes)))
    own = F.col("at") - F.pmod(F.col("at"), F.lit(gap))
    entries = events.select(*ENTRY_KEYS, F.lit(1).cast("long").alias("n"), F.explode(F.array(own, own + gap)).alias("later"))
    return priced(near_pairs(entries, gap))


def near_entries(raw_clicks: DataFrame, raw_quotes: DataFrame, gap: int, lateness: str) -> DataFrame:
    """Streaming side of the pairing: parsed clicks and quotes as counted
    entries (see :func:`near_pairs`), of which a window's come out together
    once the watermark (the smaller of the two sources') has passed its end.
    The state store holds one row per distinct event and window."""
    clicks = realtime_clicks(with_event_timestamp(raw_clicks)).withWatermark("event_timestamp", lateness)
    quotes = realtime_quotes(with_event_timestamp(raw_quotes)).withWatermark("event_timestamp", lateness)
    # Windows of twice the length name their second half; each event is in two.
    window = F.window("event_timestamp", f"{2 * gap} microseconds", f"{gap} microseconds").alias("window")
    return (timed_events(clicks, quotes).groupBy(window, *ENTRY_KEYS).agg(F.count(F.lit(1)).alias("n"))
            .select(*ENTRY_KEYS, "n", (F.unix_micros("window.end") - gap).alias("later")))


def parse_clicks(df: DataFrame, value: str = "value") -> DataFrame:
    return parse_events(df, schemas.CLICK_EVENT, value)


def parse_quotes(df: DataFrame, value: str = "value") -> DataFrame:
    return parse_events(df, schemas.COMPETITOR_EVENT, value)
