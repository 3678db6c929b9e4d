"""Connected components by alternating star operations on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.tables import written


def connected_components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``links``: (a, b); ``nodes``: (node, label), one row per node. Returns
    (node, root, component): the component's smallest node and its smallest
    label (null only if all its labels are null).

    Large-star and small-star rounds turn the links into stars around each
    component's smallest node. Every round is a hash aggregate for the
    smallest neighbour, whose partial results combine a hub's links before
    the shuffle, and a join back to the links; rounds grow with the
    logarithm of the component size. Each round's links are written to the
    shared folder, so a lost executor repeats a part of one round.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "links")
    while not edges.isEmpty():
        # Large star: every larger neighbour of u links to u's smallest.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "links-least")
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        large = written(large, "links-large")
        # Small star: u and its smaller neighbours link to the smallest of them.
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "links-least")
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        small = written(small, "links-small")
        if _same(edges, small):
            edges = small
            break
        edges = small
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    placed = (nodes.join(roots, nodes["node"] == roots["u"], "left")
              .select("node", "label", F.coalesce("root", "node").alias("root")))
    placed = written(placed, "links-roots")
    best = written(placed.groupBy("root").agg(F.min("label").alias("component")), "links-labels")
    return placed.join(best, "root").select("node", "root", "component")


def _same(x: DataFrame, y: DataFrame) -> bool:
    """Equal sets of links, by count and two sums over hashes of the rows."""
    def digest(df):
        h = F.xxhash64("u", "v")
        return tuple(df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())
    return digest(x) == digest(y)
