"""Exact per-group median without gathering a group into one task.

``F.median`` keeps, per group, a map from each distinct value to its count
and merges those maps in one task per group: fine while a group has few
distinct values (prices of a product), unbounded otherwise. The selection
below never holds more than ``buckets`` rows (or ``small`` candidate
values) of one group in a task:

1. rows -> distinct (key, value) counts (map-side combined, shuffled by
   key *and* value, so a hot key spreads over all partitions);
2. per key the answer ranks r1 = floor((n-1)/2) and r2 = ceil((n-1)/2);
3. each round splits a key's candidate range [lo, hi] into ``buckets``
   equal-width buckets, counts per bucket (hash aggregate), runs a window
   over <= ``buckets`` rows per key to find the bucket holding the rank,
   and narrows [lo, hi] to that bucket's min/max;
4. once a key's range holds at most ``small`` distinct values (or one
   value), the exact value at the rank is picked with a window over them.

Each round reads the distinct-value table (not the raw rows); it and each
round's small state are written as Parquet tables in the shared checkpoint
folder, so lineage stays short and a lost executor only recomputes one
round. The result
equals ``percentile(value, 0.5)`` bit for bit: 0.5*v[r1] + 0.5*v[r2].
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize


def exact_median(df: DataFrame, keys: list[str], value: str, alias: str = "median",
                 weight: str | None = None, buckets: int = 1024,
                 small: int = 4096) -> DataFrame:
    """(keys..., alias) with the exact median of ``value`` per key.

    Null values are skipped; rows with a null key are ignored. With
    ``weight`` naming a count column, ``df`` is taken as already reduced to
    one row per (key, value) and already materialised (a checkpoint or a
    written table), so a caller can share one pre-aggregation.

    ``buckets`` and ``small`` bound a task's memory and nothing else. A round
    puts a range's ends into different buckets, so every round narrows every
    open range and the rounds end by themselves.
    """
    v = F.col(value).cast("double")
    present = df.filter(F.col(value).isNotNull())
    if weight:
        vc = present.select(*keys, v.alias("_v"), F.col(weight).cast("bigint").alias("_c"))
    else:
        vc = present.groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
        vc = materialize(vc, "median-values")  # read once per round
    stats = vc.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.min("_v").alias("_lo"),
                                  F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_nd"))
    half = (F.col("_n") - 1) / 2
    targets = stats.select(*keys, F.explode(F.array(
        F.struct(F.lit(1).alias("_t"), F.floor(half).alias("_r")),
        F.struct(F.lit(2).alias("_t"), F.ceil(half).alias("_r")))).alias("_x"),
        "_lo", "_hi", "_nd").select(*keys, "_x._t", "_x._r", "_lo", "_hi", "_nd")
    # The targets come out of a per-key aggregate, hash-partitioned by key;
    # rebalanced, the joins below shuffle both sides, so AQE can split the
    # distinct values of a hot key over many tasks (later rounds read
    # written tables and have that shape anyway).
    state = targets.hint("rebalance")
    done_parts = []
    tkeys = [*keys, "_t"]
    while True:
        settled = (F.col("_nd") <= small) | (F.col("_lo") == F.col("_hi"))
        done_parts.append(state.filter(settled))
        state = state.filter(~settled)
        if state.isEmpty():
            break
        cand = vc.join(state, keys).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        # Halves keep the width finite; the range's own ends always part.
        width = F.nullif(F.col("_hi") / 2 - F.col("_lo") / 2, F.lit(0.0))
        b = F.floor((F.col("_v") / 2 - F.col("_lo") / 2) / width * buckets)
        b = (F.when(F.col("_v") == F.col("_hi"), buckets - 1).when(F.col("_v") == F.col("_lo"), 0)
             .otherwise(F.least(F.coalesce(b, F.lit(0)), F.lit(buckets - 1))))
        per_bucket = cand.groupBy(*tkeys, "_r", b.alias("_b")).agg(
            F.sum("_c").alias("_cnt"), F.min("_v").alias("_blo"),
            F.max("_v").alias("_bhi"), F.count(F.lit(1)).alias("_bnd"))
        w = Window.partitionBy(*tkeys).orderBy("_b").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        ranked = per_bucket.withColumn("_upto", F.sum("_cnt").over(w))
        before = F.col("_upto") - F.col("_cnt")
        pick = ranked.filter((before <= F.col("_r")) & (F.col("_r") < F.col("_upto")))
        state = pick.select(*tkeys, (F.col("_r") - before).alias("_r"),
                            F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi"),
                            F.col("_bnd").alias("_nd"))
        state = materialize(state, "median-state")
    settled = done_parts[0]
    for part in done_parts[1:]:
        settled = settled.unionByName(part)
    cand = vc.join(settled, keys).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    w = Window.partitionBy(*tkeys).orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = cand.withColumn("_upto", F.sum("_c").over(w))
    at = ranked.filter((F.col("_upto") - F.col("_c") <= F.col("_r"))
                       & (F.col("_r") < F.col("_upto")))
    both = at.groupBy(*keys).agg(F.min(F.when(F.col("_t") == 1, F.col("_v"))).alias("_a"),
                                 F.min(F.when(F.col("_t") == 2, F.col("_v"))).alias("_b"))
    a, bb = F.col("_a"), F.col("_b")
    return both.select(*keys, F.when(a == bb, a)
                       .otherwise(F.lit(0.5) * a + F.lit(0.5) * bb).alias(alias))
