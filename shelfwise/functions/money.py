"""Order-independent sums and means of prices and revenue.

A double sum depends on the order rows arrive in, so the same query can
give different last digits on 8 or 1000 partitions. Amounts from a
millionth to a trillion are summed as DECIMAL(38, 18); the few outside that
range (and a decimal sum past its 20 integer digits) are summed as doubles
beside them, so no finite value is lost and none aborts the job. NaN and
infinities are no amounts: they are left out of sums and counts alike. A
mean is the sum divided by the count of amounts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DECIMAL = "decimal(38,18)"
SMALLEST, LARGEST = 1e-6, 1e12


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def amount(col) -> Column:
    """The value as a finite double, else null."""
    c = _col(col).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def money_sum(col) -> Column:
    """Sum of the amounts as a double (null for an empty group)."""
    c = amount(col)
    usual = (c == 0) | F.abs(c).between(SMALLEST, LARGEST)
    inner = F.when(usual, c)
    exact = F.coalesce(F.try_sum(inner.try_cast(MONEY_DECIMAL)).cast("double"), F.sum(inner))
    outer = F.sum(F.when(~usual, c))
    return F.when(exact.isNull(), outer).otherwise(exact + F.coalesce(outer, F.lit(0.0)))


def money_mean(col) -> Column:
    """Mean of the amounts, as a double."""
    n = F.count(amount(col))
    return F.when(n > 0, money_sum(col) / n)


def count_mean(col) -> Column:
    """Mean of an integer measure: bigint sum over count, as a double."""
    c = _col(col)
    n = F.count(c)
    return F.when(n > 0, F.sum(c).cast("double") / n)


def money_parts(col) -> list[Column]:
    """The sums behind :func:`money_sum` and :func:`money_mean` as aggregate
    columns that can be added up again (:func:`money_total`): ``exact`` (null
    if it does not fit), ``plain``, ``usual`` (amounts in them), ``outer``
    and ``n``."""
    c = amount(col)
    usual = (c == 0) | F.abs(c).between(SMALLEST, LARGEST)
    inner = F.when(usual, c)
    return [F.try_sum(inner.try_cast(MONEY_DECIMAL)).alias("exact"), F.sum(inner).alias("plain"),
            F.count(inner).alias("usual"), F.sum(F.when(~usual, c)).alias("outer"), F.count(c).alias("n")]


def money_total(at: str = "") -> tuple[Column, Column]:
    """Sum of the amounts and their number, over rows of money_parts (in a
    struct, when ``at`` names one)."""
    field = lambda name: F.col(f"{at}.{name}" if at else name)
    lost = F.count_if((field("usual") > 0) & field("exact").isNull())
    inner = F.when(lost == 0, F.try_sum(field("exact")).cast("double"))
    inner = F.coalesce(inner, F.sum(field("plain")))
    outer = F.sum(field("outer"))
    return F.when(inner.isNull(), outer).otherwise(inner + F.coalesce(outer, F.lit(0.0))), F.sum(field("n"))
