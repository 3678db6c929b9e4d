"""Calendar columns derived from the invoice timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sale_date(ts: str = "invoice_date") -> Column:
    return F.to_date(F.col(ts))


def add_calendar(df: DataFrame, ts: str = "invoice_date") -> DataFrame:
    """Add year, month, day and day_of_week (1 = Sunday) in one projection."""
    t = F.col(ts)
    return df.withColumns({
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "day_of_week": F.dayofweek(t),
    })
