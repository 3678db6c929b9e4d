"""The whole batch chain on a temporary root, then the catalog tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import standardize_inventory
from shelfwise.plans.runner import RunOptions, run_all
from shelfwise.session import checkpoint_root
from shelfwise.sources import testviews as tv
from shelfwise.streaming.events import clean_clickstream, parse_clicks


def test_run_all_and_register(spark, tmp_dir):
    ledger = tv.ledger(spark, SF_SMALL)
    clicks = clean_clickstream(parse_clicks(tv.click_json(spark, SF_SMALL)))
    import glob
    scratch = f"{checkpoint_root(spark)}/tables/run-*"
    opt = run_all(spark, tmp_dir, ledger=ledger, clicks=clicks,
                  quotes=tv.competitor_quotes(spark, SF_SMALL),
                  options=RunOptions(high=0.3, medium=0.2, database="retail_test"))
    assert glob.glob(scratch) == []  # the run's own tables are gone
    q = opt.metrics["sales_quality"]
    assert q["row_count"] > 0 and q["invalid_quantity"] == 0 and q["invalid_revenue"] > 0
    assert set(opt.metrics["input_rows"]) == {"transactions", "product_catalog", "inventory"}
    dropped = {r.reason: r.rows for r in spark.read.parquet(f"{tmp_dir}/raw/dropped_rows").collect()}
    assert len(dropped) == 8 and all(dropped.values()) and opt.metrics["validation"] == "SUCCESSFUL"
    n_sales = spark.read.parquet(f"{tmp_dir}/processed/master_sales").count()
    assert spark.table("retail_test.master_sales").count() == n_sales == q["row_count"]
    demand = spark.table("retail_test.demand_analytics")
    assert spark.table("retail_test.pricing_recommendations").count() == demand.count()
    assert spark.table("retail_test.inventory_recommendations").count() == demand.count()
    assert demand.filter(F.col("demand_level") == "HIGH").count() > 0
    report = spark.read.parquet(f"{tmp_dir}/raw/data_quality_report")
    assert report.count() == 10
    # the observed raw count equals a direct count of the ledger
    got = {r.metric: r.value for r in report.collect()}
    assert got["initial_rows"] == str(ledger.count()) == str(opt.metrics["ledger_rows"])
    assert int(got["removed_rows"]) == ledger.count() - int(got["final_transaction_rows"])
    # restart from a later stage reuses the written tables
    run_all(spark, tmp_dir, start_at="decisions", options=RunOptions(database=None))
    assert spark.read.parquet(f"{tmp_dir}/analytics/pricing_recommendations").count() \
        == demand.count()


def test_run_all_matches_registered_queries(spark, tmp_dir):
    from shelfwise.plans.queries import QUERIES, SCALED_HIGH, SCALED_MEDIUM
    run_all(spark, tmp_dir, ledger=tv.ledger(spark, SF_SMALL),
            catalog=tv.product_catalog(spark, SF_SMALL),
            inventory=standardize_inventory(tv.inventory(spark, SF_SMALL)),
            clicks=tv.clicks(spark, SF_SMALL), quotes=tv.competitor_quotes(spark, SF_SMALL),
            options=RunOptions(high=SCALED_HIGH, medium=SCALED_MEDIUM, database=None))

    def same(path, name):
        written = spark.read.parquet(f"{tmp_dir}/{path}")
        query = QUERIES[name](spark, SF_SMALL)
        assert sorted(map(repr, written.select(*query.columns).collect())) == sorted(map(repr, query.collect()))

    same("analytics/pricing_recommendations", "dynamic_pricing")
    same("analytics/inventory_recommendations", "inventory_optimization")
    same("processed/inventory_analytics", "inventory_analytics")
