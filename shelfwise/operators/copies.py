"""Identical rows, found by a hash before any whole row is shuffled.

Every row is reduced to a 128-bit hash and the hashes are counted; only rows
whose hash occurs more than once are then compared in full. The hash never
decides: rows that merely share one stay, as their values differ. The shuffle
carries 16 bytes a row instead of the row, at the price of reading the input
again, so it pays where rows are read from files (columnar ones above all)
and few are copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import materialize

#: Repeated hashes that may be broadcast to the tasks (16 bytes each, about
#: 100 MB as a hash table); beyond, whole rows are shuffled.
BROADCAST_HASHES = 1_000_000


def _columns(df: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in df.columns]


def with_row_hash(df: DataFrame) -> DataFrame:
    """Adds ``_h1`` and ``_h2``: two 64-bit hashes over all columns. Equal
    rows (as grouping sees them: NaN equals NaN, null equals null) have equal
    hashes."""
    cols = _columns(df)
    return df.withColumns({"_h1": F.xxhash64(*cols), "_h2": F.xxhash64(F.lit("second"), *cols)})


def repeated_hashes(df: DataFrame) -> DataFrame:
    """(_h1, _h2) of the hashes that more than one row has, written to the
    shared folder. One shuffle of hash rows, combined per task first."""
    counted = with_row_hash(df).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    return materialize(counted.where("_n > 1").select("_h1", "_h2"), "row-hashes")


def drop_copies(df: DataFrame, most: int = BROADCAST_HASHES) -> DataFrame:
    """``df.dropDuplicates()`` without shuffling rows that have no copy.

    The hashes are counted while the frame is built. Without a repeated hash
    the input is returned as it is; with up to ``most`` of them the rows that
    carry one are picked out by a broadcast of the hashes and de-duplicated
    by value; with more, all rows are.
    """
    hashes = repeated_hashes(df)
    n = hashes.count()  # from the file footers
    if n == 0:
        return df
    if n > most:
        return df.dropDuplicates()
    hashed, key = with_row_hash(df), ["_h1", "_h2"]
    some = F.broadcast(hashes)  # at most `most` rows of two longs
    alone = hashed.join(some, key, "left_anti").select(*_columns(df))
    copied = hashed.join(some, key, "left_semi").select(*_columns(df))
    return alone.unionByName(copied.dropDuplicates())


def copied_rows(df: DataFrame, most: int = BROADCAST_HASHES) -> DataFrame | None:
    """``df`` with ``_copy``: a struct of the whole row where another row may
    equal it, else null. Counting rows and distinct values of it gives the
    number of copies. None if too many rows are copies to tell so."""
    hashes = repeated_hashes(df)
    n = hashes.count()
    if n > most:
        return None
    whole = F.struct(*_columns(df))
    if n == 0:
        return df.withColumn("_copy", F.when(F.lit(False), whole))
    marked = with_row_hash(df).join(F.broadcast(hashes.withColumn("_seen", F.lit(True))), ["_h1", "_h2"], "left")
    return marked.select(*_columns(df), F.when(F.col("_seen"), whole).alias("_copy"))
