"""Distributed exact median equals Spark's percentile median."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import build_catalog
from shelfwise.operators.stats import exact_median
from shelfwise.sources import testviews as tv


def _as_dict(df, key, col):
    return {r[key]: r[col] for r in df.collect()}


def test_exact_median_matches_percentile(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(20000):
        k = "HOT" if i % 3 == 0 else f"k{i % 37}"
        v = rnd.choice([rnd.uniform(-5, 5), float(rnd.randint(0, 9)), rnd.expovariate(0.01)])
        rows.append((k, None if i % 101 == 0 else v))
    rows += [("ONE", 3.5), ("TWO", 1.0), ("TWO", 2.0), ("SAME", 4.0), ("SAME", 4.0),
             ("NULLS", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    want = _as_dict(df.groupBy("k").agg(F.median("v").alias("m")), "k", "m")
    got = _as_dict(exact_median(df, ["k"], "v", alias="m", buckets=4, small=3), "k", "m")
    assert {k: v for k, v in want.items() if v is not None} == got
    assert got["TWO"] == 1.5 and got["ONE"] == 3.5 and got["SAME"] == 4.0


def test_catalog_median_modes_agree(spark):
    tx = tv.transactions(spark, SF_SMALL)
    a = _as_dict(build_catalog(tx, median="percentile"), "product_id", "selling_price")
    b = _as_dict(build_catalog(tx), "product_id", "selling_price")
    assert a == b and len(a) > 100


def test_catalog_and_history_in_one_pass(spark):
    from shelfwise.operators import historical_demand
    from shelfwise.operators.prepare import catalog_and_history
    tx = tv.transactions(spark, SF_SMALL)
    cat, hist = catalog_and_history(tx)
    assert sorted(map(tuple, cat.collect())) == sorted(map(tuple, build_catalog(tx).collect()))
    assert sorted(map(tuple, hist.collect())) == \
        sorted(map(tuple, historical_demand(tx).collect()))
    assert cat.columns == build_catalog(tx).columns
    assert hist.columns == historical_demand(tx).columns
