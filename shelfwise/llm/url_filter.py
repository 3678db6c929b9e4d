"""URL filters over dated lists: a temporal list join.

List entries come and go: events (list, pattern, action, at) become
validity intervals, and every capture is judged by the entries that were
active when it was fetched. Patterns are host suffixes (``example.org``)
or a host with a path prefix (``example.org/en``).

A capture is looked up under the suffixes of its host and the prefixes of
its path, as deep as the lists go. The as-of condition is an equality on
(pattern, time slot) and a range on the time: intervals are cut into slots,
so a host with many captures and many intervals only meets the intervals of
the same slot. At most one interval of a list and pattern is active at a
time, so the join adds no rows beyond the matches. A hot host is spread over
its slots, and both sides have plain shuffles that AQE can split further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.llm.tables import written

_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/+([^?#]*)"


def host(url: Column) -> Column:
    """Lower-cased host without user, port and trailing dots; empty if the
    URL has none."""
    return F.rtrim(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit("."))


def path_segments(url: Column) -> Column:
    """Segments of the path (array), empty ones left out."""
    return F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/+"), lambda s: s != "")


def validity_intervals(events: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) from events (list, pattern,
    action, at). ``add`` starts validity, ``remove`` ends it; an action that
    changes nothing is ignored; of several events at one time ``add`` wins;
    ``valid_to`` is null while the entry stands. Events with a null in any
    column or another action are ignored.
    """
    known = (events.where(F.col("action").isin("add", "remove"))
             .dropna(subset=["list", "pattern", "at"])
             .groupBy("list", "pattern", "at").agg(F.min("action").alias("action")))
    order = W.partitionBy("list", "pattern").orderBy("at")
    changes = (known.withColumn("_before", F.lag("action", 1, "remove").over(order))
               .where(F.col("action") != F.col("_before")))
    return (changes.withColumn("valid_to", F.lead("at").over(order)).where("action = 'add'")
            .select("list", F.lower("pattern").alias("pattern"), F.col("at").alias("valid_from"), "valid_to"))


def _slot(at: Column, days: int) -> Column:
    return F.floor(F.unix_seconds(at) / (86400 * days))


def filter_urls(captures: DataFrame, events: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
                time_col: str = "fetched_at", slot_days: int = 30) -> DataFrame:
    """One row per distinct (id, url, fetch time): ``id_col``, ``url``,
    ``fetched_at``, ``host``, ``n_entries`` (active entries that match),
    ``blocked`` (any), ``lists`` (their names, sorted, comma-joined),
    ``pattern`` and ``listed_since`` (of the longest matching pattern, ties
    to the smaller one, and then of the earliest).

    An interval holds from ``valid_from`` on, up to but without
    ``valid_to``. Defined cases: a null or malformed URL has an empty host
    and matches nothing, nor does a capture without fetch time; repeated
    captures give one row; repeated list events count once; without events
    nothing is blocked; an empty table gives an empty result; other columns
    are not looked at.
    """
    entries = written(validity_intervals(events).withColumn(
        "depth", F.size(F.split("pattern", "/")) - 1), "url-entries")
    span = entries.agg(F.coalesce(F.max("depth"), F.lit(0)).alias("depth"),
                       F.max(F.greatest("valid_from", "valid_to")).alias("last")).first()
    # An open interval is cut into slots up to the last fetch or event.
    last = captures.agg(F.max(time_col).alias("t")).first()["t"]
    last = max((t for t in (last, span["last"]) if t is not None), default=None)
    until = F.coalesce("valid_to", F.lit(last).cast("timestamp"))
    cut = written(entries.drop("depth")
                  .withColumn("slot", F.explode(F.sequence(
                      _slot(F.col("valid_from"), slot_days),
                      F.greatest(_slot(F.col("valid_from"), slot_days), _slot(until, slot_days))))), "url-slots")

    got = captures.select(F.col(id_col).alias("_id"), F.col(url_col).alias("url"),
                          F.col(time_col).alias("fetched_at"))
    got = got.withColumn("host", F.coalesce(host(F.col("url")), F.lit("")))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    depth = int(span["depth"])
    keys = suffixes
    if depth:
        got = got.withColumn("_path", F.coalesce(path_segments(F.col("url")), F.array().cast("array<string>")))
        deep = F.least(F.size("_path"), F.lit(depth))
        prefixes = F.when(deep > 0, F.transform(F.sequence(F.lit(1), F.greatest(deep, F.lit(1))), lambda i: F.lower(
            F.concat_ws("/", "host", F.array_join(F.slice("_path", 1, i), "/"))))).otherwise(F.array().cast("array<string>"))
        keys = F.concat(suffixes, prefixes)
    asked = got.select("_id", "url", "fetched_at", "host", F.explode(F.array_distinct(keys)).alias("_key"),
                       _slot(F.col("fetched_at"), slot_days).alias("_slot"))
    active = ((F.col("_key") == F.col("pattern")) & (F.col("_slot") == F.col("slot"))
              & (F.col("fetched_at") >= F.col("valid_from"))
              & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))))
    # A set: a repeated capture meets the same entries again.
    hits = F.collect_set(F.when(F.col("pattern").isNotNull(), F.struct(
        (-F.length("pattern")).alias("n"), "pattern", "valid_from", "list")))
    out = (asked.join(cut, active, "left").groupBy("_id", "url", "fetched_at", "host")
           .agg(F.array_sort(hits).alias("_hits")))
    best = F.get("_hits", F.lit(0))
    return out.select(F.col("_id").alias(id_col), "url", "fetched_at", "host",
                      F.size("_hits").cast("long").alias("n_entries"), (F.size("_hits") > 0).alias("blocked"),
                      F.array_join(F.array_sort(F.array_distinct("_hits.list")), ",").alias("lists"),
                      best["pattern"].alias("pattern"), best["valid_from"].alias("listed_since"))
