"""Adapter views that present the driver's TPC-H-style test tables as the
retail inputs the operators expect (ledger, catalog, inventory, clicks,
competitor quotes).

Every view is a lazy DataFrame over the whole parquet tables; no row is
sampled, capped or left out. The ledger, catalog and inventory come as text,
as raw files do. The modulo rules below only add to the tables: beside some
rows stands a second one with a fault (text where a number belongs, a
missing value, a blank id, a copy), and some ids are re-labelled, so that
joins have misses on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.rules import classify_product
from shelfwise.operators.prepare import once, prepare_transactions

# events.event_type -> click event type
EVENT_TYPE_MAP = {"click": "add_to_cart", "error": "remove_from_cart",
                  "signup": "search"}

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# A word at the end of a description, by part: one for each category, and one for none.
NAME_WORDS = ["tote", "Mug", "candle", "PLATE", "mirror", "toy", "notebook", "Towel", "gift", "plain"]
LINE_FAULTS, FAULT_EVERY = 22, 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _unit_price(extended: Column, quantity: Column, digits: int = 2) -> Column:
    # Cut to whole cents (or finer): same double operations in Spark and DuckDB.
    scale = 10 ** digits
    return F.when(quantity != 0, F.floor(extended * scale / quantity) / scale)


def _named(key: Column, name: Column) -> Column:
    word = F.element_at(F.array(*[F.lit(w) for w in NAME_WORDS]), (key % len(NAME_WORDS) + 1).cast("int"))
    return F.concat(name, F.lit(" "), word)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines as text: lineitem x orders x part x customer x nation.

    Dates come in four formats, every fifth price has four digits, and lines
    of the slots 0 to 21 of FAULT_EVERY stand twice, the second time with the
    fault of their slot. A file holds its texts; here each is made once a row.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # The country joins the orders first: of the lines, several to an order,
    # none is shuffled for it.
    placed = (orders.join(cust.join(nation, cust.c_nationkey == nation.n_nationkey),
                          orders.o_custkey == cust.c_custkey)
              .select("o_orderkey", "o_custkey", "o_orderdate", "n_name"))
    joined = li.join(placed, li.l_orderkey == placed.o_orderkey).join(part, li.l_partkey == part.p_partkey)
    slot = (F.col("l_orderkey") + F.col("l_linenumber") * 3) % FAULT_EVERY
    joined = joined.withColumn("v", F.explode(
        F.when(slot < LINE_FAULTS, F.array(F.lit(-1).cast("bigint"), slot)).otherwise(F.array(F.lit(-1).cast("bigint")))))
    at = (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(
        F.lit(0), (F.col("l_orderkey") % 24).cast("int"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 60).cast("int"), F.lit(0)))
    form = F.col("l_linenumber") % 4
    date = (F.when(form == 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
            .when(form == 1, F.date_format(at, "M/d/yyyy H:mm"))
            .when(form == 2, F.date_format(at, "yyyy/MM/dd HH:mm"))
            .otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")))
    qty, ext = F.col("l_quantity"), F.col("l_extendedprice")
    price = F.when(F.col("l_linenumber") % 5 == 0, _unit_price(ext, qty, 4).cast("decimal(18,4)").cast("string")) \
        .otherwise(_unit_price(ext, qty).cast("decimal(18,2)").cast("string"))
    pid, order = F.col("l_partkey").cast("string"), F.col("l_orderkey").cast("string")
    v = F.col("v")
    none = F.lit(None).cast("string")
    lines = once(joined, {
        "invoice_no": F.when(v == 0, none).when(v == 1, F.concat(F.lit(" c"), order))
        .otherwise(F.concat(F.when(F.col("l_returnflag") == "R", "C").otherwise(""), order)),
        "product_id": F.when(v == 2, none).when(v == 3, F.lit("   ")).when(v == 4, F.concat(F.lit(" "), pid, F.lit(" ")))
        .when(v == 20, F.concat(F.lit("N"), order)).otherwise(pid),
        "quantity": F.when(v == 6, "abc").when(v == 7, "3000000000").when(v == 8, "-5").when(v == 9, "0")
        .when(v == 10, "NaN").when(v == 21, "1").otherwise(qty.cast("int").cast("string")),
        "invoice_date": F.when(v == 11, "not a date").when(v == 12, none).otherwise(date),
        "unit_price": F.when(v == 13, "NaN").when(v == 14, "Infinity").when(v == 15, "-1.5").when(v == 16, "")
        .when(v == 19, "0").when(v == 21, "0.001").otherwise(price),
    })
    return lines.select(
        "invoice_no", "product_id",
        F.when(v == 5, none).otherwise(_named(F.col("l_partkey"), F.col("p_name"))).alias("description"),
        "quantity", "invoice_date", "unit_price",
        F.when(v == 17, none).otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("n_name").alias("country"),
    )


SOURCE_HEADERS = {"invoice_no": " InvoiceNo", "product_id": "StockCode ", "description": "Description",
                  "quantity": "Quantity", "invoice_date": "InvoiceDate", "unit_price": "UnitPrice",
                  "customer_id": "CustomerID", "country": " Country "}


def source_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger under the headers of a workbook export."""
    return ledger(spark, sf_dir).withColumnsRenamed(SOURCE_HEADERS)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_transactions(ledger(spark, sf_dir))


def transactions_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared transactions, and beside every line of at most two pieces
    one that lacks the product, the date or a positive figure."""
    fault = F.explode(F.when(F.col("quantity") <= 2, F.array(*[F.lit(i) for i in range(-1, 5)]))
                      .otherwise(F.array(F.lit(-1))))
    tx = transactions(spark, sf_dir).withColumn("v", fault)
    v = F.col("v")
    return tx.withColumns({
        "product_id": F.when(v != 0, F.col("product_id")),
        "quantity": F.when(v == 1, 0).otherwise(F.col("quantity")),
        "unit_price": F.when(v == 2, -1.0).otherwise(F.col("unit_price")),
        "revenue": F.when(v == 3, 0.0).otherwise(F.col("revenue")),
        "invoice_date": F.when(v != 4, F.col("invoice_date")),
    }).drop("v")


def _twice(df: DataFrame, also: Column) -> DataFrame:
    """Adds ``v``: 0 for every row, and a second row with 1 where ``also``."""
    return df.withColumn("v", F.explode(F.when(also, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


def product_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part; every 25th under an id the ledger lacks, every 30th
    a second time with fields missing, every 40th without name and category."""
    k, second = F.col("p_partkey"), F.col("v") == 1
    part = _twice(table(spark, sf_dir, "part"), F.col("p_partkey") % 30 == 7)
    nameless = second | (k % 40 == 9)
    name = F.concat(F.lit("Catalog "), _named(k, F.col("p_name")))
    return part.withColumn("name", F.when(~nameless, name)).select(
        F.concat(F.when(k % 25 == 0, "X").otherwise(""), k.cast("string")).alias("product_id"),
        F.col("name").alias("product_name"),
        F.when(~nameless, classify_product("name")).alias("category"),
        F.when(second, "n/a").otherwise(F.col("p_retailprice").cast("decimal(18,2)").cast("string"))
        .alias("selling_price"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part; every 20th under an id the ledger lacks, every 45th
    a second time with fields missing; some figures are "12.0" or no number,
    some stock is negative."""
    k, second = F.col("p_partkey"), F.col("v") == 1
    part = _twice(table(spark, sf_dir, "part"), F.col("p_partkey") % 45 == 11)
    current = (F.when(k % 50 == 3, F.lit(-4)).when(k % 7 == 0, k % 6).otherwise((k * 37) % 700)).cast("int")
    size = (F.col("p_size") * 4).cast("int").cast("string")
    none = F.lit(None).cast("string")
    return part.select(
        F.concat(F.when(k % 20 == 0, "X").otherwise(""), k.cast("string")).alias("product_id"),
        F.when(second, none).otherwise((current + 100).cast("string")).alias("initial_stock"),
        current.cast("string").alias("current_stock"),
        F.when(second, none).when(k % 33 == 5, "n/a").when(k % 2 == 1, F.concat(size, F.lit(".0"))).otherwise(size)
        .alias("reorder_level"),
        (k % 12 + 3).cast("int").cast("string").alias("lead_time_days"),
    )


def _mapped_event_type(c: Column) -> Column:
    expr = None
    for src, dst in EVENT_TYPE_MAP.items():
        expr = (F.when if expr is None else expr.when)(c == src, F.lit(dst))
    return expr.otherwise(c)


def clicks(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """Click events (all string fields, as the JSON schema declares).

    ``with_key`` keeps ``event_id`` as ``_key`` for :func:`json_lines`.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ev = table(spark, sf_dir, "events")
    ev = ev.join(nation, ev["event_id"] % 25 == nation["n_nationkey"], "left")
    pid = F.floor("value").cast("string")
    cols = [
        F.date_format("ts", ISO_FORMAT).alias("event_time"),
        F.concat(F.lit("SESSION_"), F.col("user_id").cast("string"), F.lit("_"),
                 F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.concat(F.lit("USER_"), F.col("user_id").cast("string")).alias("user_id"),
        pid.alias("product_id"),
        F.concat(F.lit("item "), pid).alias("product_description"),
        _mapped_event_type(F.col("event_type")).alias("event_type"),
        F.concat(F.lit("device "), (F.col("user_id") % 4).cast("string")).alias("device"),
        F.col("n_name").alias("country"),
    ]
    if with_key:
        cols.append(F.col("event_id").alias("_key"))
    return ev.select(*cols)


QUOTE_FAULTS, QUOTE_FAULT_EVERY = 5, 60


def competitor_quotes(spark: SparkSession, sf_dir: str, with_key: bool = False, recent: bool = False) -> DataFrame:
    """A competitor quote per invoice line; parts divisible by 5 under an id
    the ledger lacks, every sixth time with a UTC offset, and beside lines of
    the slots 0 to 4 a second quote with an odd price. Quotes are of the
    shipping date or, ``recent``, of a minute of the month of the clicks."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    slot = (F.col("l_orderkey") + F.col("l_linenumber")) % QUOTE_FAULT_EVERY
    q = li.join(sup, li.l_suppkey == sup.s_suppkey).withColumn("v", F.explode(
        F.when(slot < QUOTE_FAULTS, F.array(F.lit(-1).cast("bigint"), slot)).otherwise(F.array(F.lit(-1).cast("bigint")))))
    pid = F.concat(F.when(F.col("l_partkey") % 5 == 0, "Q").otherwise(""), F.col("l_partkey").cast("string"))
    factor = F.lit(0.85) + F.lit(0.03) * (F.col("l_suppkey") % 10)
    v = F.col("v")
    price = (F.when(v == 0, F.lit(float("nan"))).when(v == 1, F.lit(1e40)).when(v == 2, F.lit(1e-7))
             .when(v == 3, F.lit(None).cast("double")).when(v == 4, F.lit(float("inf")))
             .otherwise(_unit_price(F.col("l_extendedprice"), F.col("l_quantity")) * factor))
    minute = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 1009) % (30 * 24 * 60)
    at = F.timestamp_seconds(F.lit(1704067200) + minute * 60) if recent else F.col("l_shipdate")
    cols = [
        F.concat(F.date_format(at, ISO_FORMAT),
                 F.when(F.col("l_linenumber") % 6 == 0, "+02:00").otherwise("")).alias("event_time"),
        pid.alias("product_id"),
        F.concat(F.lit("item "), pid).alias("product_description"),
        F.col("s_name").alias("competitor"),
        price.alias("competitor_price"),
        (F.col("l_linenumber") % 4 != 0).alias("availability"),
    ]
    if with_key:
        cols.append((F.col("l_orderkey") + F.col("l_linenumber")).alias("_key"))
    return q.select(*cols)


# Of every so many JSON lines these slots have a second, faulty line beside
# them: 1 cut text, 2 the literal null, 3 an empty object, 5 an object with
# product and unreadable time only. Slot 4 itself has an extra field.
JSON_VARIANT_EVERY = 40


def json_lines(df: DataFrame, key: str = "_key", every: int = JSON_VARIANT_EVERY) -> DataFrame:
    """Encode rows as JSON text in a ``value`` column, as a topic carries
    them: a line per row, and the faulty lines beside some."""
    cols = [c for c in df.columns if c != key]
    encoded = df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias("_t"),
                        (F.col(key) % every).alias("_slot"), "product_id")
    text, slot = F.col("_t"), F.col("_slot")
    own = F.when(slot == 4, F.concat(F.expr("substring(_t, 1, length(_t) - 1)"),
                                     F.lit(', "extra_field": 1}'))).otherwise(text)
    fault = (F.when(slot == 1, F.substring(text, 1, 12)).when(slot == 2, F.lit("null")).when(slot == 3, F.lit("{}"))
             .when(slot == 5, F.concat(F.lit('{"product_id":"'), F.col("product_id"), F.lit('","event_time":"soon"}'))))
    return encoded.select(F.explode(F.when(fault.isNull(), F.array(own)).otherwise(F.array(own, fault))).alias("value"))


def click_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click lines as bytes, as a topic delivers them."""
    return json_lines(clicks(spark, sf_dir, with_key=True)).select(F.col("value").cast("binary").alias("value"))


def quote_json(spark: SparkSession, sf_dir: str, recent: bool = False) -> DataFrame:
    return json_lines(competitor_quotes(spark, sf_dir, with_key=True, recent=recent))
