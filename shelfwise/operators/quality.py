"""Validation, profiling and key checks (M10, M11; J8, J9, A14-A23)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.copies import copied_rows


def missing_keys(left: DataFrame, right: DataFrame, key: str = "product_id") -> DataFrame:
    """Distinct keys of ``left`` absent from ``right``.

    Both sides are reduced to distinct keys first (partial aggregation),
    then a left-anti join; a null key is kept once if the right side has
    no null key, like a set difference.
    """
    lk = left.select(F.col(key)).distinct()
    rk = right.select(F.col(key)).distinct()
    return lk.join(rk, lk[key].eqNullSafe(rk[key]), "left_anti")


def duplicate_keys(df: DataFrame, key: str = "product_id") -> F.Column:
    """A14 as an aggregate expression: rows beyond the first per key value
    (a null key counts as one value)."""
    has_null = F.max(F.col(key).isNull().cast("int"))
    return (F.count(F.lit(1)) - F.count_distinct(F.col(key))
            - F.coalesce(has_null, F.lit(0))).cast("bigint")


def distinct_values(col: str) -> F.Column:
    """Distinct values as a set counts them: a missing value is one value."""
    has_null = F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0))
    return (F.count_distinct(F.col(col)) + has_null).cast("bigint")


def count_negative(col: str) -> F.Column:
    """A15 as an aggregate expression."""
    return F.count_if(F.col(col) < 0)


def repeated_keys(df: DataFrame, key) -> DataFrame:
    """Key values that occur more than once, with their count."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def assert_unique_key(df: DataFrame, key) -> DataFrame:
    """``df``, or an error that names some of the repeated key values (a
    join on such a key multiplies rows)."""
    some = repeated_keys(df, key).limit(5).collect()
    if some:
        raise ValueError(f"key {key} is not unique: {[tuple(r) for r in some]}")
    return df


def assemble_report(parts: list[DataFrame], order: list[str],
                    derived: dict | None = None) -> DataFrame:
    """One-row metric frames -> (position, metric, value) text rows.

    The parts (each a one-row global aggregate) are unioned in long form
    and pivoted back into a single wide row, so every part, and the input
    behind it, is planned and computed once; ``derived`` metrics are
    column expressions over that row (e.g. a verdict); the row is then
    unpivoted in ``order``.
    """
    long = None
    names = []
    for part in parts:
        names += part.columns
        text = part.select(*[F.col(c).cast("string").alias(c) for c in part.columns])
        piece = text.unpivot([], part.columns, "metric", "value")
        long = piece if long is None else long.unionByName(piece)
    wide = long.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n)
                      for n in names])
    if derived:
        wide = wide.withColumns(derived)
    out = wide.select(*[F.col(n).cast("string").alias(n) for n in order]) \
        .unpivot([], order, "metric", "value")
    pos = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("metric"))
    return out.select(pos.cast("int").alias("position"), "metric", "value")


CHECKS = ["missing_from_catalog", "missing_from_inventory", "duplicate_catalog_ids",
          "duplicate_inventory_ids", "negative_quantities", "negative_unit_prices",
          "negative_current_stock"]


def validation_report(tx: DataFrame, catalog: DataFrame, inventory: DataFrame) -> DataFrame:
    """Row and key counts, seven checks and a verdict, as
    (position, metric, value) rows. The verdict is SUCCESSFUL only when all
    seven checks are 0. Every number is a global aggregate (partial per
    partition), assembled by :func:`assemble_report`, never by the driver."""
    # One pass over each table: its rows under one another, counted by product
    # (a null id is one value), then one global aggregate over the products.
    zero = F.lit(0).cast("bigint")
    parts = {"t": tx, "c": catalog, "i": inventory}
    negative = {"q": (tx, "quantity"), "p": (tx, "unit_price"), "s": (inventory, "current_stock")}
    rows = None
    for side, df in parts.items():
        counts = [(F.lit(1).cast("bigint") if side == x else zero).alias(x) for x in parts]
        below = [(F.when(F.col(c) < 0, 1).otherwise(0).cast("bigint") if d is df else zero).alias(x)
                 for x, (d, c) in negative.items()]
        part = df.select("product_id", *counts, *below)
        rows = part if rows is None else rows.union(part)
    per = rows.groupBy("product_id").agg(*[F.sum(x).alias(x) for x in (*parts, *negative)])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    known = lambda x: F.count_if(F.col(x) > 0)
    report = per.agg(
        total("t").alias("transaction_rows"), known("t").alias("transaction_products"),
        known("c").alias("catalog_products"), known("i").alias("inventory_products"),
        F.count_if((F.col("t") > 0) & (F.col("c") == 0)).alias("missing_from_catalog"),
        F.count_if((F.col("t") > 0) & (F.col("i") == 0)).alias("missing_from_inventory"),
        (total("c") - known("c")).alias("duplicate_catalog_ids"),
        (total("i") - known("i")).alias("duplicate_inventory_ids"),
        total("q").alias("negative_quantities"), total("p").alias("negative_unit_prices"),
        total("s").alias("negative_current_stock"))
    failed = sum((F.col(n).cast("bigint") for n in CHECKS[1:]), F.col(CHECKS[0]).cast("bigint"))
    order = ["transaction_rows", "transaction_products", "catalog_products",
             "inventory_products", *CHECKS, "validation"]
    return assemble_report(
        [report], order,
        {"validation": F.when(failed == 0, "SUCCESSFUL").otherwise("FAILED")})


# --------------------------------------------------------------------------
# Source profile
# --------------------------------------------------------------------------

def profile_columns(df: DataFrame) -> DataFrame:
    """Per column its position, type name and null count.

    One pass computes every null count; the result is unpivoted to one row
    per column (type names come from the schema, not from the data).
    """
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}")
                      for i, c in enumerate(df.columns)])
    long = counts.unpivot([], counts.columns, "slot", "null_count")
    meta = [(f"c{i}", i + 1, c, t) for i, (c, t) in enumerate(df.dtypes)]
    names = F.create_map(*[x for s, _, c, _ in meta for x in (F.lit(s), F.lit(c))])
    types = F.create_map(*[x for s, _, _, t in meta for x in (F.lit(s), F.lit(t))])
    posn = F.create_map(*[x for s, p, _, _ in meta for x in (F.lit(s), F.lit(p))])
    return long.select(posn[F.col("slot")].alias("position"),
                       names[F.col("slot")].alias("column_name"),
                       types[F.col("slot")].alias("data_type"),
                       F.col("null_count").cast("bigint").alias("null_count"))


def profile_table(df: DataFrame, product: str = "product_id",
                  customer: str | None = "customer_id", country: str = "country",
                  date: str = "invoice_date", duplicates: str = "hashes") -> DataFrame:
    """One row with row/column counts, duplicated rows,
    distinct products/customers/countries and the date range (unparsable
    dates ignored).

    ``duplicates`` "hashes" counts row hashes first (while the frame is
    built) and compares only rows that may have a copy, so no whole table is
    shuffled; "rows" groups all whole rows and reads the source once. Either
    way the other figures come from the same global aggregate.
    """
    cols = df.columns
    dt = dict(df.dtypes).get(date)
    if dt == "string":
        from shelfwise.operators.prepare import parse_date
        when = parse_date(F.col(date))
    else:
        when = F.col(date)
    marked = copied_rows(df) if duplicates == "hashes" else None
    if marked is not None:
        rows = marked
        count, copies = F.count(F.lit(1)), F.count("_copy") - F.count_distinct("_copy")
    else:
        rows = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
        # Distinct counts over a row-grouped table equal those over the table.
        count, copies = F.sum("_n"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
    out = rows.agg(
        count.alias("row_count"),
        F.lit(len(cols)).alias("column_count"),
        copies.cast("bigint").alias("duplicate_rows"),
        F.count_distinct(F.col(product)).alias("unique_products"),
        (F.count_distinct(F.col(customer)) if customer and customer in cols
         else F.lit(None).cast("bigint")).alias("unique_customers"),
        F.count_distinct(F.col(country)).alias("unique_countries"),
        F.min(when).alias("min_date"),
        F.max(when).alias("max_date"),
    )
    return out.withColumn("row_count", F.coalesce(F.col("row_count"), F.lit(0)).cast("bigint"))


def profile(df: DataFrame, sample_rows: int = 5, **columns) -> dict[str, DataFrame]:
    """The source profile as three frames, per column (position, type,
    null count), per table (counts, duplicates, distincts, date range) and
    the first ``sample_rows`` rows; ``columns`` maps the roles of
    :func:`profile_table` to source names."""
    return {"columns": profile_columns(df), "table": profile_table(df, **columns),
            "sample": df.limit(sample_rows)}
