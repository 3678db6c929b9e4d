"""Exact dedup by progressive refinement: length, prefix hash, full hash.

1. One scan computes each text's normalised length and the hash of its
   first characters and counts rows per (length, prefix hash); no text is
   shuffled, and the counts are combined before the shuffle.
2. Lengths with one row are settled, then prefixes with one row.
3. The texts are read again and only those of surviving (length, prefix)
   groups get the full SHA-256. Rows with equal length and SHA-256 are equal.

A group of copies may hold a third of all rows: every grouping is a
hash aggregate with map-side partial results, and the two joins that bring
a group's result back to its rows have plain shuffles of written tables on
both sides, so AQE splits a hot group (or broadcasts a small table). The
written tables hold ids and hashes, no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.tables import written

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: str) -> Column:
    """Every run of ASCII white space becomes one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = 256, hash_all: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, ``keep_id``, ``group_size``,
    ``kept`` and ``text_sha256``.

    Of equal texts the row with the smallest id stays. ``text_sha256`` is
    null for a text that differed from all others by length or prefix,
    unless ``hash_all`` asks for it as a digest.

    Defined cases: null text equals the empty text; rows repeated with the
    same id are copies of each other, exactly one of them stays; a null id
    is kept only when its whole group has null ids (one row stays); an
    empty table gives an empty result; other input columns, whatever their
    names, are not looked at.
    """
    out = _resolved(docs, id_col, text_col, prefix_chars, hash_all)
    lone = F.col("_size").isNull()
    return out.select(
        F.col("_id").alias(id_col),
        F.when(lone, F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.when(lone, F.lit(1)).otherwise(F.col("_size")).cast("long").alias("group_size"),
        (lone | (F.col("_row") == F.col("_keep_row"))).alias("kept"),
        F.col("_sha").alias("text_sha256"))


def _keys(norm: Column, prefix_chars: int) -> tuple[Column, Column]:
    return F.length(norm).alias("_len"), F.xxhash64(F.substring(norm, 1, prefix_chars)).alias("_prefix")


def _resolved(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int, hash_all: bool) -> DataFrame:
    """A row per document: id, length, prefix hash, full hash where it was
    needed, and of its group (null: alone) the id and row that stay."""
    text = docs.select(F.col(id_col).alias("_id"), normalised(text_col).alias("_norm"))
    keyed = text.select("_id", "_norm", *_keys(F.col("_norm"), prefix_chars))

    # Refinement on counts alone: (length, prefix) -> length -> prefix.
    by_prefix = keyed.groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    by_prefix = written(by_prefix, "dedup-prefixes")
    lengths = (by_prefix.groupBy("_len").agg(F.sum("_n").alias("_rows"))
               .where("_rows > 1").select("_len"))
    shared = written(by_prefix.join(lengths, "_len", "left_semi").where("_n > 1")
                     .select("_len", "_prefix", F.lit(True).alias("_shared")),
                     "dedup-survivors")

    # Full hash of the survivors (of all rows when the digest is wanted).
    survives = F.col("_shared").isNotNull()
    hashed = (keyed.join(shared, ["_len", "_prefix"], "left")
              .select("_id", "_len", "_prefix", survives.alias("_survives"),
                      (F.sha2("_norm", 256) if hash_all
                       else F.when(survives, F.sha2("_norm", 256))).alias("_sha"),
                      F.monotonically_increasing_id().alias("_row")))
    hashed = written(hashed, "dedup-hashes")  # also fixes _row
    groups = (hashed.where("_survives").groupBy("_len", "_sha")
              .agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"),
                   F.min_by("_row", "_id").alias("_keep_row"), F.min("_row").alias("_any_row"))
              .where("_size > 1")
              .select("_len", "_sha", "_keep", "_size",
                      F.coalesce("_keep_row", "_any_row").alias("_keep_row")))
    groups = written(groups, "dedup-groups")
    return hashed.join(groups, ["_len", "_sha"], "left")


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = 256) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Dropped rows are found again by id, length and prefix hash; the full hash
    is taken only of rows that meet a dropped one in all three. Their table
    has a row per copy and is broadcast only if its files are small; else the
    rows are shuffled once, and AQE splits a hot key.
    """
    found = _resolved(docs, id_col, text_col, prefix_chars, False).where("_size > 1")
    keys = [F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("_k"), F.col("_id").isNull().alias("_n"), "_len", "_prefix", "_sha"]
    found = written(found.select(*keys, F.col("_id").eqNullSafe(F.col("_keep")).alias("_first")), "dedup-copies")
    gone = found.where("not _first").drop("_first").distinct()
    # Rows that repeat the id and the text of the one that stays.
    again = found.where("_first").groupBy("_k", "_n", "_len", "_prefix", "_sha").count().where("count > 1").drop("count")

    norm = normalised(text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns]).alias("_row"),
                       F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_k"), F.col(id_col).isNull().alias("_n"),
                       *_keys(norm, prefix_chars), norm.alias("_norm"))

    def same(right: DataFrame) -> tuple[DataFrame, Column]:
        right = right.select(*[F.col(c).alias(f"{c}2") for c in right.columns])
        # In a CASE the full hash is no join key: it is taken after the keys have met.
        full = F.when(F.sha2("_norm", 256) == F.col("_sha2"), True).otherwise(False)
        cond = full
        for c in ("_k", "_n", "_len", "_prefix"):
            cond = (F.col(c) == F.col(f"{c}2")) & cond
        return right, cond

    left = rows.join(*same(gone), "left_anti")
    again = written(again, "dedup-again")
    if again.isEmpty():
        return left.select("_row.*")
    once = left.join(*same(again), "left_semi")
    return (left.join(*same(again), "left_anti").select("_row.*")
            .union(once.dropDuplicates(["_k", "_n", "_norm"]).select("_row.*")))
