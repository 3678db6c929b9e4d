"""Maintained signals and single-month restatement."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import click_counts, competitor_average, standardize_inventory
from shelfwise.plans.runner import RunOptions, restate_months, run_all
from shelfwise.sources import testviews as tv
from shelfwise.sources.files import restate_partitions, write_partitioned
from shelfwise.streaming import maintained


def _all(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def _read_rows(spark, path, monkeypatch):
    """Rows each micro-batch read, noted by the reduction itself."""
    seen = []
    for kind, (columns, schema, reduce, merge) in list(maintained.KINDS.items()):
        def noted(rows, reduce=reduce):
            seen.append(rows.count())
            return reduce(rows)
        monkeypatch.setitem(maintained.KINDS, kind, (columns, schema, noted, merge))
    return seen


def test_second_run_reads_only_new_files(spark, tmp_dir, monkeypatch):
    seen = _read_rows(spark, tmp_dir, monkeypatch)
    clicks, quotes = tv.clicks(spark, SF_SMALL, with_key=True), tv.competitor_quotes(spark, SF_SMALL, with_key=True)
    for kind, df, full in (("clicks", clicks, click_counts), ("quotes", quotes, competitor_average)):
        landed, store = f"{tmp_dir}/{kind}", f"{tmp_dir}/{kind}-store"
        seen.clear()
        for part in range(3):
            df.where(F.col("_key") % 3 == part).drop("_key").write.mode("append").parquet(landed)
            got = maintained.refresh(spark, landed, store, kind)
            assert _all(got) == _all(full(spark.read.parquet(landed)).select(*got.columns))
        assert seen == [df.where(F.col("_key") % 3 == i).count() for i in range(3)]
        maintained.refresh(spark, landed, store, kind)
        assert len(seen) == 3  # nothing new, nothing read


def test_failed_run_counts_every_file_once(spark, tmp_dir, monkeypatch):
    landed, store = f"{tmp_dir}/c", f"{tmp_dir}/s"
    clicks = tv.clicks(spark, SF_SMALL, with_key=True)
    clicks.where("_key % 2 = 0").drop("_key").write.parquet(landed)
    maintained.refresh(spark, landed, store, "clicks")
    clicks.where("_key % 2 = 1").drop("_key").write.mode("append").parquet(landed)
    columns, schema, reduce, merge = maintained.KINDS["clicks"]
    with monkeypatch.context() as broken:  # a task dies: some rows never arrive
        broken.setitem(maintained.KINDS, "clicks", (columns, schema, lambda r: reduce(r).withColumn(
            "n", F.when(F.col("product_id") > "5", F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("n"))), merge))
        with pytest.raises(Exception, match="lost"):
            maintained.refresh(spark, landed, store, "clicks")
    # the run before died after its parts were written but before its commit
    commits = f"{store}/checkpoint/commits"
    maintained.refresh(spark, landed, store, "clicks")
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    os.replace(f"{commits}/{last}", f"{tmp_dir}/commit")
    if os.path.exists(f"{commits}/.{last}.crc"):
        os.replace(f"{commits}/.{last}.crc", f"{tmp_dir}/crc")
    got = maintained.refresh(spark, landed, store, "clicks")
    assert _all(got) == _all(click_counts(spark.read.parquet(landed)))


def test_no_landed_values(spark, tmp_dir):
    assert maintained.totals(spark, f"{tmp_dir}/none", "quotes").collect() == []
    rows = [("a", None), ("a", float("nan")), ("b", 1e30), ("b", 2.0), ("c", 1e-9), ("d", 0.1), ("d", 0.2)]
    spark.createDataFrame(rows, "product_id string, competitor_price double").coalesce(1).write.parquet(f"{tmp_dir}/q")
    got = maintained.refresh(spark, f"{tmp_dir}/q", f"{tmp_dir}/s", "quotes")
    assert _all(got) == _all(competitor_average(spark.read.parquet(f"{tmp_dir}/q")))


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/year=*/month=*/part-*")}


def test_restating_partitions_leaves_the_others(spark, tmp_dir):
    rows = spark.range(200).selectExpr("id", "2024 as year", "cast(id % 4 + 1 as int) as month", "1 as v")
    write_partitioned(rows, f"{tmp_dir}/t")
    before = _files(f"{tmp_dir}/t")
    month = lambda fs, m: {f for f in fs if f"month={m}/" in f}
    bad = rows.where("month = 2").withColumn("v", F.when(F.col("id") > 150, F.raise_error(F.lit("lost")).cast("int")).otherwise(2))
    with pytest.raises(Exception, match="lost"):
        restate_partitions(bad, f"{tmp_dir}/t")
    assert _files(f"{tmp_dir}/t") == before and spark.read.parquet(f"{tmp_dir}/t").agg(F.sum("v")).first()[0] == 200
    restate_partitions(rows.where("month = 2").withColumn("v", F.lit(2)), f"{tmp_dir}/t")
    after = _files(f"{tmp_dir}/t")
    assert {k: v for k, v in after.items() if k not in month(after, 2)} == {k: v for k, v in before.items() if k not in month(before, 2)}
    assert not month(after, 2) & set(before) and spark.read.parquet(f"{tmp_dir}/t").agg(F.sum("v")).first()[0] == 250


def test_months_are_restated_and_landed_signals_kept(spark, tmp_dir):
    landed = tv.clicks(spark, SF_SMALL)
    landed.write.parquet(f"{tmp_dir}/streaming/clickstream")
    tv.competitor_quotes(spark, SF_SMALL).write.parquet(f"{tmp_dir}/streaming/competitor_prices")
    opt = RunOptions(high=0.3, medium=0.2, database=None)
    run_all(spark, tmp_dir, ledger=tv.ledger(spark, SF_SMALL), catalog=tv.product_catalog(spark, SF_SMALL),
            inventory=standardize_inventory(tv.inventory(spark, SF_SMALL)), options=opt)
    from shelfwise.plans.queries import QUERIES
    pricing = spark.read.parquet(f"{tmp_dir}/analytics/pricing_recommendations")
    want = QUERIES["dynamic_pricing"](spark, SF_SMALL)
    assert _all(pricing.select(*want.columns)) == _all(want)
    sales = spark.read.parquet(f"{tmp_dir}/processed/master_sales")
    first = sales.groupBy("year", "month").count().orderBy("year", "month").first()
    total = sales.count()
    before = _files(f"{tmp_dir}/processed/master_sales")
    # lines of that month leave the transactions, and a month is all gone
    tx = spark.read.parquet(f"{tmp_dir}/raw/transactions")
    other = sales.where((F.col("year") == first["year"] + 1)).select("year", "month").first()
    gone = (F.year("invoice_date") == other["year"]) & (F.month("invoice_date") == other["month"])
    part = (F.year("invoice_date") == first["year"]) & (F.month("invoice_date") == first["month"]) & (F.col("quantity") > 20)
    tx.where(~gone & ~part).write.parquet(f"{tmp_dir}/kept")
    spark.read.parquet(f"{tmp_dir}/kept").write.mode("overwrite").parquet(f"{tmp_dir}/raw/transactions")
    rows = restate_months(spark, tmp_dir, [(first["year"], first["month"]), (other["year"], other["month"])])
    after = spark.read.parquet(f"{tmp_dir}/processed/master_sales")
    assert 0 < rows[f"{first['year']}-{first['month']:02d}"] < first["count"] and rows[f"{other['year']}-{other['month']:02d}"] == 0
    assert after.where((F.col("year") == other["year"]) & (F.col("month") == other["month"])).count() == 0
    assert after.count() == after.where("quantity > 0").count() < total
    now = _files(f"{tmp_dir}/processed/master_sales")
    same = [f for f in now if f in before]
    assert len(same) == len(now) - len({f for f in now if f"year={first['year']}/month={first['month']}/" in f})
