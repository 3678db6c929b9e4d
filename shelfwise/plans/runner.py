"""The batch chain (ledger -> recommendations -> catalog tables).

Each stage writes its output to the shared folder and the next stage
reads it back: lineage stays one stage deep, a lost executor only redoes
its tasks of the current stage, and a failed run can restart from the
last written stage (``start_at``). Click counts are aggregated once and
fed to both decision jobs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import (
    assert_unique_key,
    clean_transactions,
    click_counts,
    competitor_average,
    demand_analytics,
    dynamic_pricing,
    generate_inventory,
    inventory_analytics,
    observe_quality,
    optimize_inventory,
    prepare_transactions,
    quality_report,
    standardize_catalog,
    validation_report,
)
from shelfwise.operators.prepare import catalog_and_history, coerced_ledger, observed_faults
from shelfwise.operators.sales import build_master_sales, observe_rows
from shelfwise.plans.tables import register_tables
from shelfwise.session import delete_folder, materialize, run_folder
from shelfwise.sources.files import (
    read_optional,
    read_table,
    restate_partitions,
    write_csv,
    write_partitioned,
    write_table,
)
from shelfwise.streaming.maintained import refresh

STAGES = ["prepare", "sales", "demand", "inventory", "decisions", "register"]


@dataclass
class Layout:
    root: str

    def path(self, zone: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{zone}/{name}"

    @property
    def transactions(self): return self.path("raw", "transactions")
    @property
    def catalog(self): return self.path("raw", "product_catalog")
    @property
    def inventory(self): return self.path("raw", "inventory")
    @property
    def quality(self): return self.path("raw", "data_quality_report")
    @property
    def dropped(self): return self.path("raw", "dropped_rows")
    @property
    def validation(self): return self.path("raw", "validation_report")
    @property
    def master_sales(self): return self.path("processed", "master_sales")
    @property
    def demand(self): return self.path("processed", "demand_analytics")
    @property
    def inventory_analytics(self): return self.path("processed", "inventory_analytics")
    @property
    def clickstream(self): return self.path("streaming", "clickstream")
    @property
    def competitor_prices(self): return self.path("streaming", "competitor_prices")
    @property
    def pricing(self): return self.path("analytics", "pricing_recommendations")
    @property
    def replenishment(self): return self.path("analytics", "inventory_recommendations")


@dataclass
class RunOptions:
    high: float = 10.0
    medium: float = 3.0
    labels: str = "legacy"
    overstock: int = 500
    stockout_is_urgent: bool = False
    database: str | None = "retail"
    csv: bool = False  # M1 also as CSV folders beside the Parquet tables
    unique_products: bool = False  # fail if a product has several demand rows (J3 multiplies them)
    dedupe_partitions: int | None = None
    sort: bool = False  # transactions in order of time over all files (O3)
    metrics: dict = field(default_factory=dict)


def run_all(spark: SparkSession, root: str, ledger: DataFrame | None = None,
            inventory: DataFrame | None = None, catalog: DataFrame | None = None,
            clicks: DataFrame | None = None, quotes: DataFrame | None = None,
            options: RunOptions | None = None, start_at: str = "prepare",
            transactions: DataFrame | None = None) -> RunOptions:
    """Run the chain from ``start_at``; return the options with metrics.

    Starting at "prepare" needs a raw ``ledger``, or ``transactions`` that
    are prepared already (S1). ``inventory`` and ``catalog`` override the
    prepared ones (S2, S3, e.g. a real stock feed); ``clicks``/``quotes``
    override the landed streams under ``root``. Tables that only one run
    needs are deleted at its end.
    """
    with run_folder(spark):
        return _run(spark, root, ledger, inventory, catalog, clicks, quotes, options or RunOptions(),
                    STAGES.index(start_at), transactions)


def _landed(spark, path, *columns) -> bool:
    found = read_optional(spark, path)
    return found is not None and set(columns) <= set(found.columns)


def _run(spark, root, ledger, inventory, catalog, clicks, quotes, opt, begin, transactions) -> RunOptions:
    lay = Layout(root)

    if begin <= 0:
        if ledger is None and transactions is None:
            raise ValueError("run_all needs a ledger or transactions to start at 'prepare'")
        if transactions is not None:
            write_table(transactions, lay.transactions)
        else:
            # The ledger itself is read once: its parsed rows are written
            # together with the counts of rows and faults, and the
            # de-duplication reads those columnar files.
            coerced, seen = coerced_ledger(ledger)
            coerced = materialize(coerced, "ledger")
            counts = seen.get
            write_table(prepare_transactions(coerced, sort=opt.sort, dedupe_partitions=opt.dedupe_partitions,
                                             dedupe_method="hashes"), lay.transactions)
            opt.metrics["ledger_rows"] = counts["ledger_rows"]
        tx = read_table(spark, lay.transactions)
        if catalog is None or inventory is None:
            built_catalog, history = catalog_and_history(tx)  # one pass for both
        write_table(catalog if catalog is not None else built_catalog, lay.catalog)
        write_table(inventory if inventory is not None else generate_inventory(history),
                    lay.inventory)
        if ledger is not None and transactions is None:
            write_table(quality_report(ledger, tx, initial_rows=opt.metrics["ledger_rows"]), lay.quality)
            write_table(observed_faults(spark, counts), lay.dropped)
        write_table(validation_report(tx, read_table(spark, lay.catalog), read_table(spark, lay.inventory)),
                    lay.validation)
        verdict = read_table(spark, lay.validation).where("metric = 'validation'").first()
        opt.metrics["validation"] = verdict["value"]
        if opt.csv:
            for name in ("transactions", "product_catalog", "inventory", "data_quality_report"):
                part = read_optional(spark, lay.path("raw", name))
                if part is not None:
                    write_csv(part, lay.path("raw", f"{name}_csv"))

    if begin <= 1:
        tx, tx_rows = observe_rows(read_table(spark, lay.transactions), "transaction_rows")
        cat, cat_rows = observe_rows(read_table(spark, lay.catalog), "catalog_rows")
        cat = standardize_catalog(cat)
        sales, obs = observe_quality(build_master_sales(clean_transactions(tx), cat))
        write_partitioned(sales, lay.master_sales)
        opt.metrics["sales_quality"] = obs.get
        opt.metrics["input_rows"] = {"transactions": tx_rows.get["rows"],
                                     "product_catalog": cat_rows.get["rows"]}

    if begin <= 2:
        write_table(demand_analytics(read_table(spark, lay.master_sales),
                                     high=opt.high, medium=opt.medium), lay.demand)

    if begin <= 3:
        stock, stock_rows = observe_rows(read_table(spark, lay.inventory), "inventory_rows")
        write_table(inventory_analytics(read_table(spark, lay.demand), stock), lay.inventory_analytics)
        opt.metrics.setdefault("input_rows", {})["inventory"] = stock_rows.get["rows"]

    if begin <= 4:
        # Landed events are summed once: later runs read only new files.
        counts = averages = None
        if clicks is None and _landed(spark, lay.clickstream, "product_id"):
            counts = refresh(spark, lay.clickstream, lay.path("processed", "click_totals"), "clicks")
        if quotes is None and _landed(spark, lay.competitor_prices, "product_id", "competitor_price"):
            averages = refresh(spark, lay.competitor_prices, lay.path("processed", "quote_totals"), "quotes")
        if clicks is not None and "product_id" in clicks.columns:
            counts_path = lay.path("processed", "click_counts")
            write_table(click_counts(clicks), counts_path)
            counts = read_table(spark, counts_path)
        if quotes is not None and {"product_id", "competitor_price"} <= set(quotes.columns):
            averages = competitor_average(quotes)
        demand = read_table(spark, lay.demand)
        inv_an = read_table(spark, lay.inventory_analytics)
        if opt.unique_products:
            assert_unique_key(demand, "product_id")
        write_table(dynamic_pricing(demand, inv_an, click_count_table=counts,
                                    competitor_table=averages, labels=opt.labels,
                                    overstock=opt.overstock), lay.pricing)
        write_table(optimize_inventory(inv_an, click_count_table=counts,
                                       overstock=opt.overstock,
                                       stockout_is_urgent=opt.stockout_is_urgent),
                    lay.replenishment)

    if begin <= 5 and opt.database:
        opt.metrics["tables"] = register_tables(spark, root, opt.database)
    return opt


def restate_months(spark: SparkSession, root: str, months: list[tuple[int, int]]) -> dict[str, int]:
    """Rebuild the sales fact for some (year, month) from the transactions
    and catalog under ``root``; files of other months are not touched, and
    none is until all rows of the new ones are written. A month without rows
    left loses its folder. Returns the rows written by month."""
    lay = Layout(root)
    begin = [(F.make_timestamp(F.lit(y), F.lit(m), F.lit(1), F.lit(0), F.lit(0), F.lit(0)), y, m) for y, m in months]
    wanted = F.lit(False)
    for start, _, _ in begin:  # ranges of the date itself, so that they reach the scan
        wanted = wanted | ((F.col("invoice_date") >= start) & (F.col("invoice_date") < F.add_months(start, 1).cast("timestamp")))
    tx = read_table(spark, lay.transactions).where(wanted)
    sales = build_master_sales(clean_transactions(tx), standardize_catalog(read_table(spark, lay.catalog)))
    name = lambda y, m: f"{y}-{m:02d}"
    seen = Observation("restated")
    observed = sales.observe(seen, *[F.count_if((F.col("year") == y) & (F.col("month") == m)).alias(name(y, m))
                                     for _, y, m in begin])
    restate_partitions(observed, lay.master_sales)
    rows = seen.get
    for y, m in months:
        if not rows[name(y, m)]:
            delete_folder(spark, f"{lay.master_sales}/year={y}/month={m}")
    return rows
