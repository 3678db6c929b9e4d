"""File sources and sinks, and the ledger -> CSV -> chain round trip."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import prepare_transactions, quality_report
from shelfwise.sources import testviews as tv
from shelfwise.sources.files import (
    load_products,
    read_catalog,
    read_ledger,
    read_transactions,
    write_csv,
    write_table,
)


def test_load_products(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        load_products(spark, f"{tmp_dir}/missing.csv")
    empty = f"{tmp_dir}/empty.csv"
    with open(empty, "w") as fh:
        fh.write("product_id,product_name,category,selling_price\n")
    with pytest.raises(ValueError):
        load_products(spark, empty)
    cat = tv.product_catalog(spark, SF_SMALL)
    write_table(cat, f"{tmp_dir}/cat")
    assert load_products(spark, f"{tmp_dir}/cat").count() == cat.count()


def test_csv_round_trip_keeps_leading_zeros(spark, tmp_dir):
    df = spark.createDataFrame([("00123", "Mug", "MUG", 1.5)],
                               "product_id string, product_name string, category string, "
                               "selling_price double")
    write_csv(df, f"{tmp_dir}/cat_csv")
    back = read_catalog(spark, f"{tmp_dir}/cat_csv").first()
    assert back.product_id == "00123" and back.selling_price == 1.5


def test_raw_ledger_csv_headers(spark, tmp_dir):
    path = f"{tmp_dir}/ledger.csv"
    with open(path, "w") as fh:
        fh.write(" InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,Country\n")
        fh.write("536365,85123A,WHITE HANGING HEART,6,2010-12-01 08:26:00,2.55,United Kingdom\n")
        fh.write("C536366,85123A,WHITE HANGING HEART,6,2010-12-01 08:26:00,2.55,United Kingdom\n")
    raw = read_ledger(spark, path)
    tx = prepare_transactions(raw)
    assert tx.columns == ["invoice_no", "product_id", "description", "quantity",
                          "invoice_date", "unit_price", "country", "revenue"]
    assert tx.count() == 1
    rep = {r.metric: r.value for r in quality_report(raw, tx).collect()}
    assert rep["unique_customers"] == "N/A" and rep["removed_rows"] == "1"


def test_missing_required_column(spark):
    df = spark.createDataFrame([("1",)], "InvoiceNo string")
    with pytest.raises(ValueError, match="ledger lacks the columns"):
        prepare_transactions(df)


def test_cli_batch(spark, tmp_dir):
    from shelfwise.__main__ import main
    ledger = tv.source_ledger(spark, SF_SMALL).drop("CustomerID")  # no customers: runs all the same
    ledger.coalesce(1).write.option("header", True).csv(f"{tmp_dir}/ledger")
    main(["batch", "--root", f"{tmp_dir}/out", "--ledger", f"{tmp_dir}/ledger",
          "--database", "cli_test", "--high", "0.3", "--medium", "0.2"])
    assert spark.table("cli_test.pricing_recommendations").count() > 0
    sales = spark.read.parquet(f"{tmp_dir}/out/processed/master_sales")
    assert sales.count() == sales.filter("customer_id is null").count() > 0


def _csv(path, *lines):
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_cli_batch_from_csvs(spark, tmp_dir, capsys):
    from shelfwise.__main__ import main
    _csv(f"{tmp_dir}/tx.csv", "invoice_no,product_id,description,quantity,invoice_date,unit_price,country,revenue",
         "1,007,Tote,3,2024-01-01 10:00:00,2.5,FR,7.5", "2,007,Tote,1,2024-01-02 10:00:00,2.5,FR,2.5",
         "3,008,Mug,1,2024-01-02 10:00:00,1.5,FR,1.5")
    _csv(f"{tmp_dir}/cat.csv", "selling_price,product_id,product_name,category", "2.75,007,Tote bag,BAG")
    _csv(f"{tmp_dir}/inv.csv", "product_id,initial_stock,current_stock,reorder_level,lead_time_days", "007,10,4,12.0,5")
    main(["batch", "--root", f"{tmp_dir}/out", "--transactions", f"{tmp_dir}/tx.csv", "--catalog", f"{tmp_dir}/cat.csv",
          "--inventory", f"{tmp_dir}/inv.csv", "--database", "", "--csv", "--unique-products"])
    assert "FAILED" in capsys.readouterr().out  # 008 is in neither table
    got = {r.product_id: r for r in spark.read.parquet(f"{tmp_dir}/out/analytics/pricing_recommendations").collect()}
    assert got["007"].product_name == "Tote bag" and got["007"].current_stock == 4 and got["008"].current_stock is None
    back = read_transactions(spark, f"{tmp_dir}/out/raw/transactions_csv")
    assert back.count() == 3 and back.first().product_id.startswith("00")
    main(["validate", "--transactions", f"{tmp_dir}/tx.csv", "--catalog", f"{tmp_dir}/cat.csv",
          "--inventory", f"{tmp_dir}/inv.csv", "--out", f"{tmp_dir}/checked"])
    rep = {r.metric: r.value for r in spark.read.parquet(f"{tmp_dir}/checked/validation").collect()}
    assert rep["missing_from_catalog"] == "1" and rep["transaction_rows"] == "3"
    _csv(f"{tmp_dir}/ledger.csv", "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country",
         "1,A,Mug,1,12/1/2010 8:26,2,c,FR", "1,A,Mug,1,12/1/2010 8:26,2,c,FR")
    main(["profile", "--ledger", f"{tmp_dir}/ledger.csv", "--out", f"{tmp_dir}/profile"])
    t = spark.read.parquet(f"{tmp_dir}/profile/table").first()
    assert (t.row_count, t.duplicate_rows, t.min_date.month) == (2, 1, 12)
    assert spark.read.parquet(f"{tmp_dir}/profile/sample").count() == 2


def test_csv_folder_with_two_headers(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/tx")
    _csv(f"{tmp_dir}/tx/a.csv", "invoice_no,product_id,description,quantity,invoice_date,unit_price,country,customer_id,revenue",
         "1,A,d,1,2024-01-01 10:00:00,2.0,FR,C1,2.0")
    _csv(f"{tmp_dir}/tx/b.csv", "invoice_no,product_id,description,quantity,invoice_date,unit_price,customer_id,country,revenue",
         "2,A,d,1,2024-01-01 10:00:00,2.0,C2,DE,2.0")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_transactions(spark, f"{tmp_dir}/tx").collect()
    got = sorted((r.invoice_no, r.country, r.customer_id) for r in read_transactions(spark, f"{tmp_dir}/tx", by_file=True).collect())
    assert got == [("1", "FR", "C1"), ("2", "DE", "C2")]
    _csv(f"{tmp_dir}/cat.csv", "product_id,product_name", "1,x")
    with pytest.raises(ValueError, match="selling_price"):
        read_catalog(spark, f"{tmp_dir}/cat.csv")


def test_peek_topic_text(spark, tmp_dir):
    from shelfwise import schemas
    from shelfwise.streaming.jobs import peek_topic
    tv.json_lines(tv.clicks(spark, SF_SMALL, with_key=True)).write.text(f"{tmp_dir}/c")
    got = peek_topic(spark, None, schemas.CLICK_EVENT, n=7, fmt="text", path=f"{tmp_dir}/c")
    assert got.columns[:3] == ["partition", "offset", "event_time"] and got.count() == 7
    assert got.filter("product_id is not null").count() > 0


def test_cluster_needs_a_shared_folder(spark):
    from shelfwise.session import ensure_checkpoint_dir

    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        conf = Conf({"spark.master": "yarn"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_cli_streaming(spark, tmp_dir):
    from shelfwise.__main__ import main
    tv.json_lines(tv.clicks(spark, SF_SMALL, with_key=True)).write.text(f"{tmp_dir}/c")
    tv.json_lines(tv.competitor_quotes(spark, SF_SMALL, with_key=True)).write.text(f"{tmp_dir}/q")
    main(["land", "--kind", "clicks", "--format", "text", "--path", f"{tmp_dir}/c",
          "--out", f"{tmp_dir}/landed", "--checkpoint", f"{tmp_dir}/ck1", "--available-now"])
    assert spark.read.parquet(f"{tmp_dir}/landed").count() > 0
    main(["realtime", "--format", "text", "--click-path", f"{tmp_dir}/c",
          "--quote-path", f"{tmp_dir}/q", "--out", f"{tmp_dir}/rt",
          "--checkpoint", f"{tmp_dir}/ck2", "--available-now", "--max-per-trigger", "1"])
    assert "window_start" in spark.read.parquet(f"{tmp_dir}/rt").columns


def test_sorted_prepare_and_preview(spark, capsys):
    from shelfwise.sources.files import preview
    tx = prepare_transactions(tv.ledger(spark, SF_SMALL), sort=True)
    for part in tx.select("invoice_date").rdd.glom().collect():
        dates = [r[0] for r in part]
        assert dates == sorted(dates)  # ordered within each partition
    preview(tx, 3)
    out = capsys.readouterr().out
    assert "invoice_no" in out and "root" in out
