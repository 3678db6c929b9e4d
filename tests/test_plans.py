"""Physical-plan checks: no Python in any plan, pushdown and pruning."""

import re

import pytest

from conftest import SF_SMALL
from shelfwise.plans.queries import QUERIES


def _explain(df):
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


SKIP = {"master_sales_partition_pruned"}  # writes a table; checked below


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_python_in_plan(spark, name):
    text = _explain(QUERIES[name](spark, SF_SMALL))
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                   "MapInPandas"):
        assert marker not in text, f"{name}: {marker}"
    # every query reads the given test tables (build_catalog reads the
    # intermediate table it wrote from them while the frame was built)
    if name != "build_catalog":
        assert "/root/testdata/" in text, name
    # whole tables: no sampling, and limits only where top-k is the feature
    assert "Sample" not in text, name
    if name not in ("top_products", "lowest_coverage"):
        assert "Limit" not in text and "TakeOrderedAndProject" not in text, name
    # every join is an equi-join: no cartesian or nested-loop plans
    for marker in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert marker not in text, f"{name}: {marker}"


def test_partition_pruning(spark):
    text = _explain(QUERIES["master_sales_partition_pruned"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(year" in text and "(year#" in text


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _explain(QUERIES["top_products"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in _explain(QUERIES["lowest_coverage"](spark, SF_SMALL))


def test_column_pruning_and_pushdown(spark):
    text = _explain(QUERIES["click_counts"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text  # event_id is the fixture's country key
    text = _explain(QUERIES["competitor_average"](spark, SF_SMALL))
    # the order key and line number pick the fixture's odd prices
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," \
           "l_quantity:double,l_extendedprice:double>" in text
    assert "PushedFilters: [IsNotNull(l_suppkey)" in text


def test_validation_reads_the_ledger_once(spark):
    text = _explain(QUERIES["validation_report"](spark, SF_SMALL))
    assert text.count("l_extendedprice:double") == 1  # one ReadSchema of lineitem


def test_no_sort_aggregate_over_lines(spark):
    """Text minimums only run over the lines of each product's first moment."""
    from shelfwise.operators.prepare import build_catalog
    from shelfwise.sources import testviews as tv
    text = _explain(build_catalog(tv.transactions(spark, SF_SMALL), median="percentile"))
    assert text.count("partial_min(struct(") == 1


def test_ledger_texts_and_parses_occur_once(spark):
    """Each text of the fixture and each parse of the operator is one
    expression in the plan, whatever filters and projections stand above."""
    from shelfwise.operators.prepare import DATE_FORMATS
    from shelfwise.sources import testviews as tv
    text = _explain(tv.transactions(spark, SF_SMALL))
    body = text[text.rindex("== Physical Plan =="):]
    assert body.count("date_format(") == 4  # the fixture's four date formats
    assert body.lower().count("rlike") == len(DATE_FORMATS)
    parses = [line for line in body.splitlines() if "invoice_date" in line and "RLIKE" in line]
    assert len(parses) == 1 and "Arguments: inline(" in parses[0]


def test_filters_and_columns_pass_the_coercion(spark, tmp_dir):
    """Filters on columns that are not coerced reach the scan, and columns
    that nobody reads leave it."""
    from shelfwise.operators.prepare import prepare_transactions
    from shelfwise.sources import testviews as tv
    tv.ledger(spark, SF_SMALL).write.parquet(f"{tmp_dir}/ledger")
    ledger = spark.read.parquet(f"{tmp_dir}/ledger")
    text = _explain(prepare_transactions(ledger, dedupe=False).select("product_id", "quantity"))
    scan = text[text.index("Batched"):]
    assert "IsNotNull(invoice_no)" in scan and "IsNotNull(product_id)" in scan
    assert "description" not in scan[:scan.index("(2)")]


def test_ledger_lines_are_shuffled_by_order_and_part_only(spark):
    """Customers and nations join the orders, not the lines."""
    from shelfwise.sources import testviews as tv
    plan = tv.ledger(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"Join Inner, \((\w+)#", plan) == ["l_partkey", "l_orderkey", "o_custkey", "c_nationkey"]


def test_prepared_validation_prepares_once(spark):
    """Catalog and inventory are derived from written transactions; only the
    transactions' own counts go back to the ledger."""
    text = _explain(QUERIES["validation_report_prepared"](spark, SF_SMALL))
    assert text.count("l_extendedprice:double") == 1  # one ReadSchema of lineitem


def test_validation_counts_of_null_and_repeated_ids(spark):
    from shelfwise.operators import validation_report
    tx = spark.createDataFrame([("a", 1, 1.0), ("a", -1, 1.0), (None, 2, -2.0), ("b", None, None)],
                               "product_id string, quantity int, unit_price double")
    cat = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("z",)], "product_id string")
    inv = spark.createDataFrame([("b", -1), ("b", 3), ("y", None)], "product_id string, current_stock int")
    rows = validation_report(tx, cat, inv)
    assert {r.metric: r.value for r in rows.collect()} == {
        "transaction_rows": "4", "transaction_products": "3", "catalog_products": "3", "inventory_products": "2",
        "missing_from_catalog": "1", "missing_from_inventory": "2", "duplicate_catalog_ids": "2",
        "duplicate_inventory_ids": "1", "negative_quantities": "1", "negative_unit_prices": "1",
        "negative_current_stock": "1", "validation": "FAILED"}
    assert "Join" not in _explain(rows)  # every table is read once
    empty = {r.metric: r.value for r in validation_report(tx.limit(0), cat.limit(0), inv.limit(0)).collect()}
    assert empty.pop("validation") == "SUCCESSFUL" and set(empty.values()) == {"0"}
