"""Demand kept up by month: equal to the full computation, one month read."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import demand_analytics
from shelfwise.operators.demand_partials import demand_from_partials, refresh_demand
from shelfwise.plans.queries import _sales
from shelfwise.sources.files import write_partitioned


def _all(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_months_add_up_to_the_whole(spark, tmp_dir):
    path, store = f"{tmp_dir}/sales", f"{tmp_dir}/store"
    sales = _sales(spark, SF_SMALL)
    odd = sales.limit(0).union(sales.where("quantity > 48").withColumn("category", F.lit(None).cast("string")).withColumn(
        "customer_id", F.lit(None).cast("string")).select(*sales.columns))
    write_partitioned(sales.unionByName(odd), path)
    fact = spark.read.parquet(path)
    months = [(r["year"], r["month"]) for r in fact.select("year", "month").distinct().orderBy("year", "month").collect()]
    first, rest = months[:4], months[4:]
    got = refresh_demand(spark, fact, store, first)
    some = fact.where(F.concat_ws("-", "year", "month").isin([f"{y}-{m}" for y, m in first]))
    assert _all(got) == _all(demand_analytics(some))
    got = refresh_demand(spark, fact, store, rest)
    assert _all(got) == _all(demand_analytics(fact))
    # invoices and customers that several months share count once
    assert got.agg(F.sum("unique_customers")).first()[0] < spark.read.parquet(f"{store}/partials").where(
        "kind = 'customers'").agg(F.sum(F.bitmap_count("bits"))).first()[0]
    ids = spark.read.parquet(f"{store}/ids/customers")
    n = ids.count()
    assert ids.select("value").distinct().count() == n and ids.agg(F.max("id"), F.min("id")).first() == (n - 1, 0)
    # a month changes: it alone is read, and the result is that of a full run
    changed = fact.where(~((F.col("year") == months[2][0]) & (F.col("month") == months[2][1]) & (F.col("quantity") > 30)))
    changed.write.partitionBy("year", "month").parquet(f"{tmp_dir}/changed")
    changed = spark.read.parquet(f"{tmp_dir}/changed")
    got = refresh_demand(spark, changed, store, [months[2]])
    assert _all(got) == _all(demand_analytics(changed))
    with redirect_stdout(io.StringIO()) as text:
        got.explain("formatted")
    assert f"{tmp_dir}/changed" not in text.getvalue()  # from the partials alone


def test_failed_refresh_leaves_the_partials(spark, tmp_dir):
    path, store = f"{tmp_dir}/sales", f"{tmp_dir}/store"
    write_partitioned(_sales(spark, SF_SMALL), path)
    fact = spark.read.parquet(path)
    months = [(r["year"], r["month"]) for r in fact.select("year", "month").distinct().orderBy("year", "month").limit(3).collect()]
    want = _all(refresh_demand(spark, fact, store, months))
    broken = fact.withColumn("quantity", F.when(F.col("quantity") > 40, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("quantity")))
    with pytest.raises(Exception, match="lost"):
        refresh_demand(spark, broken, store, months[:1])
    assert _all(demand_from_partials(spark, store)) == want
    assert _all(refresh_demand(spark, fact, store, months[:1])) == want
