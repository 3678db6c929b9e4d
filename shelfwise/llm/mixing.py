"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source gets a target of words. The whole mix is a number of
equal-token blocks, and blocks go to sources by the highest quotients
target / (2k + 1); each source's blocks go to its shards the same way,
by shard size. Within a shard the documents are put in seeded order, one
pass after the other, and the shard's quota takes the first blocks of that
order.

Blocks are never made into rows. The seats of a divisor d are
round(target / d); with d = total / blocks they miss the wanted number by
at most half the number of parties, and only the quotients that lie between
d / 2 and the last one to give or take are listed and ranked. The result is
that of listing all quotients.

A source may hold a third of all rows: it is cut into shards by the hash of
the document id, the shard count follows the corpus size, and the
only window over documents runs inside one shard of one source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.llm.tables import carried, written

#: Blocks that the smallest target is made of, where it has so many words.
BLOCKS_PER_SOURCE = 16
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1),
                   share: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """``sizes``: (source, source_size), one row per source. Adds
    ``target``: sources in code point order (null last) weigh ``weights`` in
    turn and share ``share`` times all words; no target is above
    ``max_repeats`` times its source, the excess is shared anew by weight.

    The targets are min(cap, level * weight). Ranked by cap / weight, the
    capped sources come first, so one running sum finds the level. The
    windows run over one row per source, not over documents.
    """
    n = len(weights)
    order = W.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("_i", F.row_number().over(order) - 1)
    pick = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("_i") % n + 1).cast("int"))
    w = (w.withColumn("_w", pick.cast("double"))
         .withColumn("_cap", F.col("source_size").cast("double") * max_repeats))
    by_ratio = W.orderBy(F.col("_cap") / F.col("_w"), "_i")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    w = (w.withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
         .withColumn("_used_w", F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
         .withColumn("_all_w", F.sum("_w").over(everything))
         .withColumn("_total", F.sum("source_size").over(everything).cast("double") * share)
         .withColumn("_level", (F.col("_total") - F.col("_capped")) / (F.col("_all_w") - F.col("_used_w"))))
    # The first source in ratio order whose cap is not below the level fixes it.
    fits = F.col("_cap") >= F.col("_level") * F.col("_w")
    level = F.first(F.when(fits, F.col("_level")), ignorenulls=True).over(
        by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return (w.withColumn("_final", level)
            .select("source", "source_size",
                    F.when(F.col("_final").isNull(), F.col("_cap"))
                    .otherwise(F.least("_cap", F.col("_final") * F.col("_w"))).alias("target")))


def sainte_lague(parties: DataFrame, *, group: list[str], key: list[str], votes: str,
                 seats: str) -> DataFrame:
    """Adds ``quota``: the ``seats`` of each group (a column, equal within
    the group) go to its parties by the highest quotients votes / (2k + 1),
    ties to the smallest ``key``. Votes of zero get no seat.
    """
    g = W.partitionBy(*group)
    p = (parties.withColumn("_sum", F.sum(votes).over(g))
         .withColumn("_d", F.col("_sum").cast("double") / F.nullif(F.col(seats), F.lit(0)))
         .withColumn("_base", F.when((F.col(votes) > 0) & (F.col(seats) > 0),
                                     F.floor(F.col(votes) / F.col("_d") + 0.5)).otherwise(0).cast("long"))
         .withColumn("_miss", F.col(seats) - F.sum("_base").over(g)))

    def near(side: DataFrame, first: Column, best_first: bool) -> DataFrame:
        """The ``_miss`` best quotients beside the base seats, counted per party."""
        def ranked(k: Column):  # the last of a tie gives a seat back first
            q = F.col(votes).cast("double") / (2 * k + 1)
            tie = [F.col(c).asc_nulls_last() if best_first else F.col(c).desc_nulls_first() for c in key]
            return q, W.partitionBy(*group).orderBy(q.desc() if best_first else q.asc(), *tie)

        q, rank = ranked(first)
        need = F.abs(F.col("_miss"))
        side = (side.withColumn("_q", q).withColumn("_r", F.row_number().over(rank))
                .withColumn("_edge", F.max(F.when(F.col("_r") <= need, F.struct("_r", "_q"))).over(g)["_q"]))
        reach = ((F.col(votes).cast("double") / F.col("_edge")) - 1) / 2
        if best_first:
            ks = F.sequence(F.col("_base"), F.greatest(F.col("_base"), F.floor(reach + 1)))
        else:
            ks = F.sequence(F.greatest(F.lit(0).cast("long"), F.least(F.col("_base") - 1, F.ceil(reach - 1))),
                            F.col("_base") - 1)
        side = side.select(*group, *[c for c in key if c not in group], votes, "_miss", F.explode(ks).alias("_k"))
        _, rank = ranked(F.col("_k"))
        return (side.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= need)
                .groupBy(*{**dict.fromkeys(group), **dict.fromkeys(key)})
                .agg(F.count(F.lit(1)).alias("_change")))

    more = near(p.where((F.col("_miss") > 0) & (F.col(votes) > 0)), F.col("_base"), True)
    less = near(p.where((F.col("_miss") < 0) & (F.col("_base") > 0)), F.col("_base") - 1, False)
    change = more.unionByName(less.withColumn("_change", -F.col("_change")))
    on = list({**dict.fromkeys(group), **dict.fromkeys(key)})
    renamed = change.select(*[F.col(c).alias(f"_on_{c}") for c in on], "_change")
    same = [p[c].eqNullSafe(renamed[f"_on_{c}"]) for c in on]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return (p.join(renamed, cond, "left")
            .withColumn("quota", F.col("_base") + F.coalesce("_change", F.lit(0)))
            .drop("_sum", "_d", "_base", "_miss", "_change", *[f"_on_{c}" for c in on]))


def _digest(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))))


def shard_of(digest: Column, shards: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % shards


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1),
                share: float = 1.5, max_repeats: int = 2, block_words: int = 64,
                shard_words: int = 200_000, seed: int = 7,
                carry: list[str] | None = None) -> DataFrame:
    """One row per input row: ``id_col``, ``size`` (words), ``source_size``,
    ``target`` (words, of the row's source) and ``taken`` (words the mix
    takes of the row, repeats counted, at most ``max_repeats`` times its
    size), and with ``carry`` the named input columns in a struct ``carried``.

    A block has ``block_words`` words, or fewer where the smallest target
    above zero does not hold BLOCKS_PER_SOURCE of that size (one word at
    least): with a long tail of small sources no source misses the mix, and
    none gains what their rounding leaves. As apportionment rounds every
    target by the same divisor, a source's taken words differ from its target
    by a block or by a sixteenth of the target, whichever is more, and by at
    most a block per shard more where the target is the whole repeated source
    (a target under half a word can round to nothing). Reruns give the same
    result: order and shards depend on the seed and the id alone.

    Defined cases: a null text has size 0 and nothing is taken; rows with a
    null source form one source, the last; rows repeated with the same id
    count each, in order of size and of a hash of the text; an empty table or one without words gives
    targets of 0; extra columns are not looked at unless named in ``carry``.
    """
    wide = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
                       word_count(text_col).alias("size"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"),
                       carried(carry).alias("_carry"))
    # Sizes are counted once and written; carried columns are read again at
    # the end instead of being written too.
    rows = written(wide.drop("_carry") if carry else wide, "mix-rows")

    sizes = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    # Blocks per source. The block total is that of the whole mix.
    by_source = source_targets(sizes, weights=weights, share=share, max_repeats=max_repeats)
    every = W.partitionBy()
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(every)
    fine = F.floor(least / BLOCKS_PER_SOURCE)
    by_source = (by_source.withColumn("_one", F.lit(1))
                 .withColumn("_block", F.greatest(F.lit(1), F.least(F.lit(block_words), F.coalesce(fine, F.lit(1)))).cast("long"))
                 .withColumn("_seats", F.round(F.sum("target").over(every) / F.col("_block")).cast("long")))
    by_source = sainte_lague(by_source, group=["_one"], key=["source"], votes="target", seats="_seats")
    by_source = written(by_source.select(
        "source", "source_size", "target", "_block", F.col("quota").alias("_blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long").alias("_shards")),
        "mix-sources")

    # The per-source table is joined on a null-safe key; it is small next to
    # the rows, so AQE broadcasts it or splits a hot source.
    def place(df: DataFrame) -> DataFrame:
        return (df.join(by_source.withColumnRenamed("source", "_source"),
                        F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
                .withColumn("_order", _digest(seed))
                .withColumn("_shard", shard_of(F.col("_order"), F.col("_shards"))))

    placed = place(rows)
    shards = placed.groupBy("source", "_shard").agg(
        F.sum("size").alias("_shard_size"), F.max("_blocks").alias("_blocks"))
    shards = sainte_lague(shards, group=["source"], key=["source", "_shard"], votes="_shard_size",
                          seats="_blocks")
    shards = written(shards.select(F.col("source").alias("_source"), F.col("_shard").alias("_s"),
                                   "_shard_size", "quota"), "mix-shards")

    # Seeded order inside (source, shard): pass r takes the words from
    # r * shard size on, so the quota is cut from each pass in closed form.
    inside = W.partitionBy("source", "_shard").orderBy("_order", F.col("_id").asc_nulls_last(), "size", "_text")
    upto = F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow))
    placed = (place(wide) if carry else placed).withColumn("_end", upto)
    out = placed.join(shards, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_s")))
    words = F.col("quota") * F.col("_block")
    begin = F.col("_end") - F.col("size")
    taken = F.lit(0)
    for r in range(max_repeats):
        left = words - F.col("_shard_size") * r - begin
        taken = taken + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return out.select(
        F.col("_id").alias(id_col),
        *([F.col("_carry").alias("carried")] if carry else []),
        "size", "source_size", "target", taken.cast("long").alias("taken"))
