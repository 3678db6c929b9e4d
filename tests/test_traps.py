"""One test per semantic trap of SURVEY section 2.14."""

from shelfwise.operators import (
    build_master_sales,
    dynamic_pricing,
    inventory_analytics,
    optimize_inventory,
    prepare_transactions,
    standardize_catalog,
    standardize_inventory,
)
from shelfwise.operators.demand import demand_analytics
from shelfwise.sources.files import read_inventory, read_optional, read_transactions


def test_csv_columns_bound_by_header(spark, tmp_dir):
    # country before customer_id, as the preparation writes it
    path = f"{tmp_dir}/tx.csv"
    with open(path, "w") as fh:
        fh.write("invoice_no,product_id,description,quantity,invoice_date,unit_price,"
                 "country,customer_id,revenue\n")
        fh.write("536365,85123A,WHITE HANGING,6,2010-12-01 08:26:00,2.55,United Kingdom,17850,15.3\n")
    row = read_transactions(spark, path).first()
    assert row.country == "United Kingdom" and row.customer_id == "17850"
    assert row.quantity == 6 and row.unit_price == 2.55


def test_float_text_reorder_level(spark, tmp_dir):
    path = f"{tmp_dir}/inv.csv"
    with open(path, "w") as fh:
        fh.write("product_id,initial_stock,current_stock,reorder_level,lead_time_days\n")
        fh.write("00123,10,4,12.0,5\n")
        fh.write("00124,x,4,7,5\n")
    got = standardize_inventory(read_inventory(spark, path)).orderBy("product_id").collect()
    assert got[0].product_id == "00123" and got[0].reorder_level == 12
    assert got[1].initial_stock is None  # bad text becomes null, the job does not fail


def test_ansi_safe_coercion(spark):
    ledger = spark.createDataFrame(
        [("1", "A", "d", "abc", "2020-01-01 10:00:00", "1.5", "c1", "UK"),
         ("2", "A", "d", "2", "not a date", "1.5", "c1", "UK"),
         ("3", "A", "d", "2", "2020-01-01 10:00:00", "x", "c1", "UK"),
         ("4", "A", "d", "2", "2020-01-01 10:00:00", "1.5", "c1", "UK")],
        "InvoiceNo string, StockCode string, Description string, Quantity string, "
        "InvoiceDate string, UnitPrice string, CustomerID string, Country string")
    got = prepare_transactions(ledger).collect()
    assert [r.invoice_no for r in got] == ["4"]
    assert got[0].revenue == 3.0 and got[0].quantity == 2


def _chain(spark, sales_rows, inventory_rows):
    tx = spark.createDataFrame(
        sales_rows, "invoice_no string, product_id string, description string, quantity int, "
        "invoice_date timestamp, unit_price double, country string, customer_id string, "
        "revenue double")
    cat = spark.createDataFrame([("P1", "Mug", "MUG", 2.0)],
                                "product_id string, product_name string, category string, "
                                "selling_price double")
    sales = build_master_sales(tx, standardize_catalog(cat))
    demand = demand_analytics(sales, high=2.0, medium=1.0)
    inv = spark.createDataFrame(inventory_rows,
                                "product_id string, initial_stock int, current_stock int, "
                                "reorder_level int, lead_time_days int")
    return demand, inventory_analytics(demand, inv)


def test_label_case_trap(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, 10)
    demand, inv = _chain(spark, [("1", "P1", "Mug", 10, t, 2.0, "UK", "c", 20.0)],
                         [("P1", 10, 5, 1, 30)])
    assert demand.first().demand_level == "HIGH"
    assert inv.first().stockout_risk == "HIGH"
    legacy = dynamic_pricing(demand, inv).first()
    norm = dynamic_pricing(demand, inv, labels="normalized").first()
    assert legacy.pricing_action == "KEEP_PRICE"
    assert norm.pricing_action == "INCREASE_PRICE" and norm.recommended_price == 2.2


def test_stockout_becomes_normal(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, 10)
    _, inv = _chain(spark, [("1", "P1", "Mug", 1, t, 2.0, "UK", "c", 2.0)],
                    [("P1", 10, 0, 5, 3)])
    assert inv.first().stockout_risk == "STOCKOUT"
    r = optimize_inventory(inv).first()
    assert (r.inventory_action, r.final_reorder_quantity) == ("NORMAL", 0)
    r = optimize_inventory(inv, stockout_is_urgent=True).first()
    assert (r.inventory_action, r.final_reorder_quantity) == ("URGENT_RESTOCK", 5)


def test_fan_out_on_repeated_names(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, 10)
    rows = [("1", "P9", "Name A", 1, t, 2.0, "UK", "c", 2.0),
            ("2", "P9", "Name B", 1, t, 2.0, "UK", "c", 2.0)]
    demand, inv = _chain(spark, rows, [("P9", 10, 5, 1, 30)])
    assert demand.count() == 2
    assert dynamic_pricing(demand, inv).count() == 4  # 2 x 2, as in the source job
    import pytest

    from shelfwise.operators import assert_unique_key, repeated_keys
    assert repeated_keys(demand, "product_id").count() == 1
    with pytest.raises(ValueError, match="P9"):
        assert_unique_key(demand, "product_id")
    assert assert_unique_key(demand, "product_name").count() == 2


def test_missing_signals_and_optional_inputs(spark, tmp_dir):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, 10)
    demand, inv = _chain(spark, [("1", "P1", "Mug", 1, t, 2.0, "UK", "c", 2.0)],
                         [("P1", 10, 600, 5, 3)])
    assert read_optional(spark, f"{tmp_dir}/nothing_here") is None
    no_pid = spark.createDataFrame([("x",)], "other string")
    r = dynamic_pricing(demand, inv, clicks=no_pid, quotes=no_pid).first()
    assert r.real_time_click_count == 0 and r.average_competitor_price is None
    out = dynamic_pricing(demand, inv)
    assert dict(out.dtypes)["real_time_click_count"] == "bigint"
    assert dict(out.dtypes)["average_competitor_price"] == "double"


def test_json_errors(spark):
    from shelfwise.streaming.events import clean_competitor, parse_quotes
    lines = spark.createDataFrame(
        [('{"product_id":"1","competitor":"A","competitor_price":"abc"}',),
         ('{"product_id":"1","competitor":"A","competitor_price":2.5,"x":1}',),
         ("null",), ("{}",), ('{"product_id":',), (None,)], "value string")
    parsed = parse_quotes(lines)
    assert parsed.count() == 6
    clean = clean_competitor(parsed).collect()
    assert len(clean) == 1 and clean[0].competitor_price == 2.5
