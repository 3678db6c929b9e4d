"""Options that change the source behaviour on request, and small operators."""

import datetime as dt
import os

from shelfwise.operators import (
    click_counts,
    competitor_average,
    standardize_inventory,
)
from shelfwise.sources.files import read_optional


def test_one_row_per_key_is_deterministic(spark):
    rows = [("P1", 5, 3, 2, 4), ("P1", 5, 1, 2, 4), ("P1", None, 9, 9, 9), ("P2", 1, 1, 1, 1)]
    df = spark.createDataFrame(rows, "product_id string, initial_stock int, current_stock int, "
                                     "reorder_level int, lead_time_days int")
    for parts in (1, 3):
        got = {r.product_id: tuple(r)[1:] for r in
               standardize_inventory(df.repartition(parts)).collect()}
        assert got["P1"] == (5, 1, 2, 4)  # smallest row, filled before missing
        assert got["P2"] == (1, 1, 1, 1)


def test_read_optional_empty_folder(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/empty")
    assert read_optional(spark, f"{tmp_dir}/empty") is None


def test_competitor_available_only(spark):
    q = spark.createDataFrame([("P1", 10.0, True), ("P1", 2.0, False), ("P1", None, True)],
                              "product_id string, competitor_price double, availability boolean")
    assert competitor_average(q).first().average_competitor_price == 6.0
    assert competitor_average(q, available_only=True).first().average_competitor_price == 10.0


def test_click_count_filters(spark):
    t = dt.datetime(2024, 1, 2)
    c = spark.createDataFrame([("P1", "view", dt.datetime(2024, 1, 1)), ("P1", "view", t),
                               ("P1", "purchase", t)],
                              "product_id string, event_type string, event_timestamp timestamp_ntz")
    assert click_counts(c).first().real_time_click_count == 3
    assert click_counts(c, since=t).first().real_time_click_count == 2
    assert click_counts(c, event_types=["purchase"]).first().real_time_click_count == 1
