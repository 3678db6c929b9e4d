"""Command line: ``spark-submit -m shelfwise <command> ...`` or
``python -m shelfwise <command> ...``.

Commands
  batch     ledger -> transactions, catalog, inventory, report -> master
            sales -> demand -> inventory analytics -> pricing and restock
            recommendations -> catalog tables (stages as in plans.runner);
            or from CSVs of prepared transactions, catalog and inventory
  validate  checks of transactions against catalog and inventory
  profile   columns, nulls, duplicates, date range and first rows of a ledger
  land      land a JSON event stream (clicks or quotes) into Parquet
  realtime  real-time pricing from the click and quote streams

The session comes from spark-submit (master, resources, the shared
``spark.checkpoint.dir``); nothing here sets the master.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from shelfwise.session import CLUSTER_CONF, RECOMMENDED_CONF, ensure_checkpoint_dir


def _session(name: str, more: dict | None = None) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:  # embedded use: never retune someone else's session
        ensure_checkpoint_dir(active)
        return active
    from pyspark import SparkConf
    submitted = SparkConf()  # what spark-submit / spark-defaults already set
    builder = SparkSession.builder.appName(name)
    for k, v in {**CLUSTER_CONF, **RECOMMENDED_CONF, **(more or {})}.items():
        if not submitted.contains(k):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="shelfwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--root", required=True, help="output root (raw/, processed/, analytics/)")
    b.add_argument("--ledger", help="raw ledger (CSV with header, or Parquet with --ledger-format)")
    b.add_argument("--ledger-format", default="csv")
    b.add_argument("--single-line", action="store_true",
                   help="no quoted line breaks in the ledger: large CSV files are split over tasks")
    b.add_argument("--inventory", help="optional stock feed (CSV) replacing the generated one")
    b.add_argument("--transactions", help="prepared transactions (CSV), instead of a ledger")
    b.add_argument("--catalog", help="optional product catalog (CSV) replacing the built one")
    b.add_argument("--by-file", action="store_true", help="bind every CSV file to its own header")
    b.add_argument("--csv", action="store_true", help="also write the prepared tables as CSV folders")
    b.add_argument("--unique-products", action="store_true", help="fail if a product has several demand rows")
    b.add_argument("--dedupe-partitions", type=int,
                   help="de-duplicate by one shuffle of whole rows of this width, instead of by row hashes")
    b.add_argument("--sort", action="store_true", help="write the transactions in order of time over all files")
    b.add_argument("--start-at", default="prepare")
    b.add_argument("--high", type=float, default=10.0)
    b.add_argument("--medium", type=float, default=3.0)
    b.add_argument("--labels", default="legacy", choices=["legacy", "normalized"])
    b.add_argument("--database", default="retail")
    v = sub.add_parser("validate")
    for name in ("transactions", "catalog", "inventory"):
        v.add_argument(f"--{name}", required=True, help="Parquet, or CSV if the name ends in csv")
    v.add_argument("--out", help="also write the report (Parquet)")
    f = sub.add_parser("profile")
    f.add_argument("--ledger", required=True)
    f.add_argument("--ledger-format", default="csv")
    f.add_argument("--out", help="also write the profile (Parquet, one folder per part)")
    for name in ("land", "realtime"):
        p = sub.add_parser(name)
        p.add_argument("--out", required=True)
        p.add_argument("--checkpoint")
        p.add_argument("--format", default="kafka", help="kafka or text")
        p.add_argument("--bootstrap", default="localhost:9092")
        p.add_argument("--trigger", default="10 seconds")
        p.add_argument("--available-now", action="store_true")
        p.add_argument("--max-per-trigger", type=int,
                       help="cap per micro-batch: Kafka offsets or files, so a "
                            "backlog is worked off in bounded batches")
        if name == "land":
            p.add_argument("--kind", choices=["clicks", "quotes"], required=True)
            p.add_argument("--topic")
            p.add_argument("--path")
        else:
            p.add_argument("--click-topic", default="clickstream")
            p.add_argument("--quote-topic", default="competitor_prices")
            p.add_argument("--click-path")
            p.add_argument("--quote-path")
            p.add_argument("--max-gap", default="1 hour", help="window in which clicks and quotes pair")
            p.add_argument("--lateness", default="10 minutes", help="how late an event may arrive")
    a = ap.parse_args(argv)

    if a.cmd == "batch":
        from shelfwise.plans.runner import RunOptions, run_all
        from shelfwise.sources.files import (
            read_catalog,
            read_inventory,
            read_ledger,
            read_transactions,
            split_rejected,
            write_table,
        )
        spark = _session("shelfwise-batch")
        ledger = None
        if a.ledger:  # records that do not fit are kept apart, not dropped unseen
            ledger, rejected = split_rejected(read_ledger(spark, a.ledger, a.ledger_format, checked=True,
                                                          multi_line=not a.single_line))
            write_table(rejected, f"{a.root.rstrip('/')}/raw/rejected_records")
        tx = read_transactions(spark, a.transactions, a.by_file) if a.transactions else None
        cat = read_catalog(spark, a.catalog, a.by_file) if a.catalog else None
        inv = read_inventory(spark, a.inventory, a.by_file) if a.inventory else None
        opt = run_all(spark, a.root, ledger=ledger, transactions=tx, catalog=cat, inventory=inv,
                      start_at=a.start_at,
                      options=RunOptions(high=a.high, medium=a.medium, labels=a.labels, csv=a.csv,
                                         unique_products=a.unique_products,
                                         dedupe_partitions=a.dedupe_partitions, sort=a.sort,
                                         database=a.database or None))
        print({k: v for k, v in opt.metrics.items()})
        return

    if a.cmd in ("validate", "profile"):
        from shelfwise.operators import (
            normalize_columns,
            profile,
            rename_source,
            validation_report,
        )
        from shelfwise.sources import files
        spark = _session(f"shelfwise-{a.cmd}")
        if a.cmd == "validate":
            def read(path, as_csv):
                return as_csv(spark, path) if path.rstrip("/").endswith("csv") else files.read_table(spark, path)
            parts = {"validation": validation_report(
                read(a.transactions, files.read_transactions), read(a.catalog, files.read_catalog),
                read(a.inventory, files.read_inventory))}
        else:
            parts = profile(rename_source(normalize_columns(files.read_ledger(spark, a.ledger, a.ledger_format))))
        for name, df in parts.items():
            if a.out:
                files.write_table(df, f"{a.out.rstrip('/')}/{name}")
            files.preview(df, 50)
        return

    from shelfwise.streaming.jobs import (
        STATE_CONF,
        land_clickstream,
        land_competitor_prices,
        land_realtime_pricing,
        read_topic,
    )
    kw = dict(trigger=a.trigger, available_now=a.available_now)
    cap = {}
    if a.max_per_trigger:
        key = "maxOffsetsPerTrigger" if a.format == "kafka" else "maxFilesPerTrigger"
        cap = {key: str(a.max_per_trigger)}
    if a.cmd == "land":
        spark = _session(f"shelfwise-land-{a.kind}")
        raw = read_topic(spark, a.topic, fmt=a.format, path=a.path, bootstrap=a.bootstrap,
                         **cap)
        job = land_clickstream if a.kind == "clicks" else land_competitor_prices
        job(raw, a.out, a.checkpoint, **kw).awaitTermination()
    else:
        spark = _session("shelfwise-realtime", STATE_CONF)
        rc = read_topic(spark, a.click_topic, fmt=a.format, path=a.click_path,
                        bootstrap=a.bootstrap, **cap)
        rq = read_topic(spark, a.quote_topic, fmt=a.format, path=a.quote_path,
                        bootstrap=a.bootstrap, **cap)
        land_realtime_pricing(rc, rq, a.out, a.checkpoint, max_gap=a.max_gap, lateness=a.lateness,
                              **kw).awaitTermination()


if __name__ == "__main__":
    main()
