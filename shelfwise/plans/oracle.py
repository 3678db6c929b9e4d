"""Independent DuckDB SQL for every registered query.

The adapter views are re-stated as CTEs over the base test tables, and
each query is written directly in SQL (not generated from the Spark
plan). Conventions that make the two engines agree exactly:

* Spark rounds half-up on the shortest decimal text of a double; the SQL
  rounds the same text as a DECIMAL (``R2``).
* Money sums are exact sums of decimals with 18 digits after the point; what
  such a decimal cannot hold well (under a millionth, over a trillion) is
  summed as doubles beside it. NaN and infinities count nowhere. A mean is
  the sum over the count.
* Word lists, weights, thresholds and the fixtures' rules are written out
  here; nothing is taken from the code under test.
* DuckDB's ``dayofweek`` is 0-based, its integer sums are HUGEINT and its
  ``year()`` is BIGINT: all are cast to the Spark types.
"""

from __future__ import annotations

def R2(x: str) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,15)), 2) AS DOUBLE)"


def MSUM(x: str) -> str:
    usual = f"isfinite({x}) AND (({x}) = 0 OR abs({x}) BETWEEN 0.000001::DOUBLE AND 1e12::DOUBLE)"
    rare = f"isfinite({x}) AND NOT (({x}) = 0 OR abs({x}) BETWEEN 0.000001::DOUBLE AND 1e12::DOUBLE)"
    inner = f"CAST(SUM(TRY_CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18))) FILTER (WHERE {usual}) AS DOUBLE)"
    outer = f"SUM({x}) FILTER (WHERE {rare})"
    return f"(CASE WHEN {inner} IS NULL THEN {outer} ELSE {inner} + COALESCE({outer}, 0::DOUBLE) END)"


def MMEAN(x: str) -> str:
    n = f"COUNT({x}) FILTER (WHERE isfinite({x}))"
    return f"(CASE WHEN {n} > 0 THEN {MSUM(x)} / {n} END)"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def classify_sql(x: str) -> str:
    def any_of(*words: str) -> str:
        return " OR ".join(f"contains(upper({x}), '{w}')" for w in words)
    return f"""(CASE
  WHEN {any_of('BAG', 'PURSE', 'TOTE', 'SHOPPER')} THEN 'BAG'
  WHEN {any_of('MUG', 'CUP')} THEN 'MUG'
  WHEN {any_of('CANDLE', 'VOTIVE', 'TEALIGHT')} THEN 'CANDLE'
  WHEN {any_of('KITCHEN', 'PLATE', 'BOWL', 'SPOON', 'FORK', 'KNIFE', 'CUTLERY', 'JUG', 'TEAPOT')} THEN 'KITCHEN'
  WHEN {any_of('FRAME', 'MIRROR', 'ORNAMENT', 'DECORATION', 'WALL', 'SIGN', 'HANGING')} THEN 'DECORATION'
  WHEN {any_of('TOY', 'GAME', 'DOLL', 'PUZZLE')} THEN 'TOY'
  WHEN {any_of('PEN', 'NOTEBOOK', 'PAPER', 'CARD', 'STATIONERY')} THEN 'STATIONERY'
  WHEN {any_of('CUSHION', 'PILLOW', 'TOWEL', 'BLANKET', 'FABRIC')} THEN 'TEXTILE'
  WHEN {any_of('GIFT', 'PRESENT', 'WRAP')} THEN 'GIFT'
  ELSE 'OTHER' END)"""


def weight_sql(x: str) -> str:
    return (f"(CASE {x} WHEN 'purchase' THEN 5 WHEN 'add_to_cart' THEN 3 WHEN 'view' THEN 1 "
            "WHEN 'remove_from_cart' THEN -1 ELSE 0 END)")


def lead_sql(x: str) -> str:
    return ("CAST(COALESCE(list_sum(list_transform(string_split(CAST(" + x +
            " AS VARCHAR), ''), lambda c: ascii(c))), 0) % 12 + 3 AS INTEGER)")


def level_sql(x: str, high: float, medium: float) -> str:
    return (f"(CASE WHEN {x} >= CAST({high!r} AS DOUBLE) THEN 'HIGH' "
            f"WHEN {x} >= CAST({medium!r} AS DOUBLE) THEN 'MEDIUM' ELSE 'LOW' END)")


def signal_sql(x: str) -> str:
    return f"(CASE WHEN {x} >= 100 THEN 'HIGH' WHEN {x} >= 30 THEN 'MEDIUM' ELSE 'LOW' END)"


ISO = "'%Y-%m-%dT%H:%M:%S.%f'"

# --------------------------------------------------------------------------
# CTEs (name -> (dependencies, body))
# --------------------------------------------------------------------------

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name, deps, body):
    CTES[name] = (deps, body)


_NAMED = ("p_name || ' ' || ['tote', 'Mug', 'candle', 'PLATE', 'mirror', 'toy', 'notebook', 'Towel', 'gift', "
          "'plain'][CAST(p_partkey % 10 + 1 AS INTEGER)]")

cte("ledger", [], f"""
SELECT CASE v WHEN 0 THEN NULL WHEN 1 THEN ' c' || l_orderkey
            ELSE (CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END) || l_orderkey END AS invoice_no,
       CASE v WHEN 2 THEN NULL WHEN 3 THEN '   ' WHEN 4 THEN ' ' || l_partkey || ' ' WHEN 20 THEN 'N' || l_orderkey
            ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
       CASE WHEN v <> 5 THEN {_NAMED} END AS description,
       CASE v WHEN 6 THEN 'abc' WHEN 7 THEN '3000000000' WHEN 8 THEN '-5' WHEN 9 THEN '0' WHEN 10 THEN 'NaN'
              WHEN 21 THEN '1' ELSE CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) END AS quantity,
       CASE WHEN v = 11 THEN 'not a date' WHEN v = 12 THEN NULL
            WHEN l_linenumber % 4 = 0 THEN strftime(at_time, '%Y-%m-%d %H:%M:%S')
            WHEN l_linenumber % 4 = 1 THEN strftime(at_time, '%-m/%-d/%Y %-H:%M')
            WHEN l_linenumber % 4 = 2 THEN strftime(at_time, '%Y/%m/%d %H:%M')
            ELSE strftime(at_time, '%Y-%m-%dT%H:%M:%S') END AS invoice_date,
       CASE v WHEN 13 THEN 'NaN' WHEN 14 THEN 'Infinity' WHEN 15 THEN '-1.5' WHEN 16 THEN '' WHEN 19 THEN '0'
              WHEN 21 THEN '0.001'
            ELSE CASE WHEN l_quantity = 0 THEN NULL
                      WHEN l_linenumber % 5 = 0
                        THEN CAST(CAST(floor(l_extendedprice * 10000 / l_quantity) / 10000 AS DECIMAL(18,4)) AS VARCHAR)
                      ELSE CAST(CAST(floor(l_extendedprice * 100 / l_quantity) / 100 AS DECIMAL(18,2)) AS VARCHAR) END
       END AS unit_price,
       CASE WHEN v <> 17 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
       n_name AS country
FROM (SELECT *, o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER))
                + to_minutes((l_orderkey * 7 + l_linenumber) % 60) AS at_time
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
      JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) j,
     unnest(CASE WHEN (l_orderkey + l_linenumber * 3) % 200 < 22
                 THEN [-1, (l_orderkey + l_linenumber * 3) % 200] ELSE [-1] END) AS u(v)""")

# The ledger with types: a text that is no number or date is null.
cte("ledger_typed", ["ledger"], """
SELECT invoice_no, product_id, description, country, customer_id, quantity AS quantity_text,
       CASE WHEN isfinite(TRY_CAST(quantity AS DOUBLE)) THEN TRY_CAST(quantity AS DOUBLE) END AS qty,
       TRY_STRPTIME(invoice_date, ['%Y-%m-%d %H:%M:%S', '%-m/%-d/%Y %-H:%M', '%Y/%m/%d %H:%M', '%Y-%m-%dT%H:%M:%S'])
         AS ts,
       CASE WHEN isfinite(TRY_CAST(unit_price AS DOUBLE)) THEN TRY_CAST(unit_price AS DOUBLE) END AS price
FROM ledger""")

cte("ledger_judged", ["ledger_typed"], """
SELECT *, CASE WHEN invoice_no IS NULL THEN 'invoice_no'
               WHEN product_id IS NULL OR trim(product_id) = '' THEN 'product_id'
               WHEN ts IS NULL THEN 'invoice_date'
               WHEN qty IS NULL OR abs(qty) > 2147483647 THEN 'quantity'
               WHEN price IS NULL THEN 'unit_price'
               WHEN starts_with(upper(trim(invoice_no)), 'C') THEN 'cancelled'
               WHEN qty <= 0 THEN 'quantity_not_positive'
               WHEN price <= 0 THEN 'unit_price_not_positive' END AS reason
FROM ledger_typed""")

cte("transactions", ["ledger_judged"], """
SELECT trim(invoice_no) AS invoice_no, trim(product_id) AS product_id, description,
       CAST(trunc(qty) AS INTEGER) AS quantity, ts AS invoice_date, price AS unit_price, country, customer_id,
       qty * price AS revenue
FROM (SELECT DISTINCT invoice_no, product_id, description, qty, ts, price, country, customer_id
      FROM ledger_judged WHERE reason IS NULL) d""")

cte("transactions_feed", ["transactions"], """
SELECT invoice_no, CASE WHEN v <> 0 THEN product_id END AS product_id, description,
       CASE WHEN v = 1 THEN 0 ELSE quantity END AS quantity,
       CASE WHEN v <> 4 THEN invoice_date END AS invoice_date,
       CASE WHEN v = 2 THEN -1 ELSE unit_price END AS unit_price, country, customer_id,
       CASE WHEN v = 3 THEN 0 ELSE revenue END AS revenue
FROM transactions, unnest(CASE WHEN quantity <= 2 THEN [-1, 0, 1, 2, 3, 4] ELSE [-1] END) AS u(v)""")

cte("product_catalog", [], f"""
SELECT (CASE WHEN p_partkey % 25 = 0 THEN 'X' ELSE '' END) || p_partkey AS product_id, product_name,
       CASE WHEN product_name IS NOT NULL THEN {classify_sql('product_name')} END AS category,
       CASE WHEN v = 1 THEN 'n/a' ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS selling_price
FROM (SELECT *, CASE WHEN v = 0 AND p_partkey % 40 <> 9 THEN 'Catalog ' || {_NAMED} END AS product_name
      FROM part, unnest(CASE WHEN p_partkey % 30 = 7 THEN [0, 1] ELSE [0] END) AS u(v)) p""")

cte("inventory", [], """
SELECT (CASE WHEN p_partkey % 20 = 0 THEN 'X' ELSE '' END) || p_partkey AS product_id,
       CASE WHEN v = 0 THEN CAST(stock + 100 AS VARCHAR) END AS initial_stock,
       CAST(stock AS VARCHAR) AS current_stock,
       CASE WHEN v = 1 THEN NULL WHEN p_partkey % 33 = 5 THEN 'n/a'
            WHEN p_partkey % 2 = 1 THEN CAST(p_size * 4 AS INTEGER) || '.0'
            ELSE CAST(CAST(p_size * 4 AS INTEGER) AS VARCHAR) END AS reorder_level,
       CAST(p_partkey % 12 + 3 AS VARCHAR) AS lead_time_days
FROM (SELECT *, CAST(CASE WHEN p_partkey % 50 = 3 THEN -4 WHEN p_partkey % 7 = 0 THEN p_partkey % 6
                          ELSE (p_partkey * 37) % 700 END AS INTEGER) AS stock
      FROM part, unnest(CASE WHEN p_partkey % 45 = 11 THEN [0, 1] ELSE [0] END) AS u(v)) p""")

cte("catalog_std", ["product_catalog"], """
SELECT DISTINCT ON (product_id) CAST(product_id AS VARCHAR) AS product_id,
       CAST(product_name AS VARCHAR) AS product_name, CAST(category AS VARCHAR) AS category,
       TRY_CAST(selling_price AS DOUBLE) AS catalog_selling_price
FROM product_catalog
ORDER BY product_id, product_name NULLS LAST, category NULLS LAST, catalog_selling_price NULLS LAST""")

INV_TYPED = """
SELECT CAST(product_id AS VARCHAR) AS product_id,
       TRY_CAST(TRY_CAST(initial_stock AS DOUBLE) AS INTEGER) AS initial_stock,
       TRY_CAST(TRY_CAST(current_stock AS DOUBLE) AS INTEGER) AS current_stock,
       TRY_CAST(TRY_CAST(reorder_level AS DOUBLE) AS INTEGER) AS reorder_level,
       TRY_CAST(TRY_CAST(lead_time_days AS DOUBLE) AS INTEGER) AS lead_time_days
FROM inventory"""
cte("inventory_typed", ["inventory"], INV_TYPED)
cte("inventory_std", ["inventory_typed"], """
SELECT DISTINCT ON (product_id) * FROM inventory_typed
ORDER BY product_id, initial_stock NULLS LAST, current_stock NULLS LAST,
         reorder_level NULLS LAST, lead_time_days NULLS LAST""")

cte("feed_clean", ["transactions_feed"], """
SELECT * FROM transactions_feed
WHERE product_id IS NOT NULL AND quantity > 0 AND unit_price > 0 AND revenue > 0
  AND invoice_date IS NOT NULL""")

cte("tx_clean", ["transactions"], """
SELECT * FROM transactions
WHERE product_id IS NOT NULL AND quantity > 0 AND unit_price > 0 AND revenue > 0
  AND invoice_date IS NOT NULL""")

cte("master_sales", ["tx_clean", "catalog_std"], f"""
SELECT t.invoice_no, t.product_id,
       COALESCE(p.product_name, t.description) AS product_name,
       COALESCE(p.category, 'OTHER') AS category,
       t.quantity, t.invoice_date, CAST(t.invoice_date AS DATE) AS sale_date,
       t.unit_price, p.catalog_selling_price, t.customer_id, t.country,
       {R2('t.revenue')} AS revenue,
       CAST(day(t.invoice_date) AS INTEGER) AS day,
       CAST(dayofweek(t.invoice_date) + 1 AS INTEGER) AS day_of_week,
       CAST(year(t.invoice_date) AS INTEGER) AS year,
       CAST(month(t.invoice_date) AS INTEGER) AS month
FROM tx_clean t LEFT JOIN catalog_std p ON t.product_id = p.product_id""")


def _demand_body(high, medium):
    return f"""
SELECT product_id, product_name, category, total_quantity_sold, total_orders,
       unique_customers, total_revenue, average_quantity_per_transaction,
       average_selling_price, first_sale_date, last_sale_date, active_days,
       average_daily_demand, {level_sql('average_daily_demand', high, medium)} AS demand_level
FROM (
  SELECT *, CASE WHEN active_days > 0 THEN CAST(total_quantity_sold AS DOUBLE) / active_days
                 ELSE CAST(0 AS DOUBLE) END AS average_daily_demand
  FROM (
    SELECT product_id, product_name, category,
           CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
           COUNT(DISTINCT invoice_no) AS total_orders,
           COUNT(DISTINCT customer_id) AS unique_customers,
           {R2(MSUM('revenue'))} AS total_revenue,
           {R2('CAST(SUM(quantity) AS DOUBLE) / COUNT(quantity)')} AS average_quantity_per_transaction,
           {R2(MMEAN('unit_price'))} AS average_selling_price,
           MIN(sale_date) AS first_sale_date, MAX(sale_date) AS last_sale_date,
           CAST(date_diff('day', MIN(sale_date), MAX(sale_date)) + 1 AS INTEGER) AS active_days
    FROM master_sales GROUP BY product_id, product_name, category) a) b"""


cte("demand_default", ["master_sales"], _demand_body(10.0, 3.0))
cte("demand", ["master_sales"], _demand_body(0.30, 0.20))

cte("inv_analytics", ["demand", "inventory_std"], f"""
SELECT product_id, product_name, category, total_quantity_sold,
       {R2('average_daily_demand')} AS average_daily_demand, demand_level,
       initial_stock, current_stock, reorder_level, lead_time_days,
       {R2('coverage')} AS stock_coverage_days,
       CASE WHEN current_stock <= 0 THEN 'STOCKOUT'
            WHEN coverage <= lead_time_days THEN 'HIGH'
            WHEN current_stock <= reorder_level THEN 'MEDIUM'
            ELSE 'LOW' END AS stockout_risk,
       CASE WHEN current_stock < reorder_level THEN greatest(reorder_level - current_stock, 0)
            ELSE 0 END AS recommended_reorder_quantity
FROM (
  SELECT d.product_id, d.product_name, d.category, d.total_quantity_sold,
         d.average_daily_demand, d.demand_level, i.initial_stock, i.current_stock,
         i.reorder_level, i.lead_time_days,
         CASE WHEN d.average_daily_demand > 0
              THEN CAST(i.current_stock AS DOUBLE) / d.average_daily_demand END AS coverage
  FROM demand d LEFT JOIN inventory_std i ON d.product_id = i.product_id) x""")

cte("clicks_keyed", [], f"""
SELECT strftime(ts, {ISO}) AS event_time,
       'SESSION_' || CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id,
       'USER_' || CAST(user_id AS VARCHAR) AS user_id,
       CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS product_id,
       'item ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS product_description,
       CASE event_type WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'remove_from_cart' WHEN 'signup' THEN 'search'
            ELSE event_type END AS event_type,
       'device ' || CAST(user_id % 4 AS VARCHAR) AS device, n_name AS country,
       event_id AS _key
FROM events LEFT JOIN nation ON event_id % 25 = n_nationkey""")
cte("clicks", ["clicks_keyed"], "SELECT * EXCLUDE (_key) FROM clicks_keyed")

cte("quotes_keyed", [], f"""
SELECT strftime(l_shipdate, {ISO}) || (CASE WHEN l_linenumber % 6 = 0 THEN '+02:00' ELSE '' END) AS event_time,
       (CASE WHEN l_partkey % 5 = 0 THEN 'Q' ELSE '' END) || l_partkey AS product_id,
       'item ' || (CASE WHEN l_partkey % 5 = 0 THEN 'Q' ELSE '' END) || l_partkey AS product_description,
       s_name AS competitor,
       CASE v WHEN 0 THEN 'nan'::DOUBLE WHEN 1 THEN 1e40::DOUBLE WHEN 2 THEN 1e-7::DOUBLE WHEN 3 THEN NULL
              WHEN 4 THEN 'inf'::DOUBLE
            ELSE (CASE WHEN l_quantity <> 0 THEN floor(l_extendedprice * 100 / l_quantity) / 100 END)
                 * (CAST(0.85 AS DOUBLE) + CAST(0.03 AS DOUBLE) * (l_suppkey % 10)) END AS competitor_price,
       l_linenumber % 4 <> 0 AS availability,
       l_orderkey + l_linenumber AS _key
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey,
     unnest(CASE WHEN (l_orderkey + l_linenumber) % 60 < 5 THEN [-1, (l_orderkey + l_linenumber) % 60] ELSE [-1] END)
       AS u(v)""")
# The same quotes at minutes of January 2024.
cte("recent_keyed", [], CTES["quotes_keyed"][1].replace(
    "strftime(l_shipdate, ", "strftime(make_timestamp((1704067200 + ((l_orderkey * 7 + l_linenumber * 1009) % 43200) * 60)"
    " * 1000000), "))
cte("quotes", ["quotes_keyed"], "SELECT * EXCLUDE (_key) FROM quotes_keyed")

# Parsed JSON lines: beside the rows of slots 1, 2 and 3 of 40 stands a line
# that gives only nulls, beside those of slot 5 one with a product and an
# unreadable time.
def _parsed(source: str, fields: list[str]) -> str:
    lone = {"product_id": "product_id", "event_time": "'soon'"}
    return (f"SELECT {', '.join(fields)} FROM {source} "
            f"UNION ALL SELECT {', '.join('NULL' for _ in fields)} FROM {source} WHERE _key % 40 IN (1, 2, 3) "
            f"UNION ALL SELECT {', '.join(lone.get(c, 'NULL') for c in fields)} FROM {source} WHERE _key % 40 = 5")


cte("clicks_parsed", ["clicks_keyed"], _parsed("clicks_keyed", [
    "event_time", "session_id", "user_id", "product_id", "product_description", "event_type", "device", "country"]))
cte("quotes_parsed", ["quotes_keyed"], _parsed("quotes_keyed", [
    "event_time", "product_id", "product_description", "competitor", "competitor_price", "availability"]))
cte("recent_parsed", ["recent_keyed"], _parsed("recent_keyed", [
    "event_time", "product_id", "product_description", "competitor", "competitor_price", "availability"]))

EVENT_TS = """CASE WHEN ends_with(event_time, '+02:00')
            THEN TRY_CAST(left(event_time, length(event_time) - 6) AS TIMESTAMP) - INTERVAL 2 HOUR
            ELSE TRY_CAST(event_time AS TIMESTAMP) END"""

cte("click_counts", ["clicks"], """
SELECT product_id, COUNT(*) AS real_time_click_count FROM clicks GROUP BY product_id""")
cte("competitor_avg", ["quotes"], f"""
SELECT product_id, {MMEAN('competitor_price')} AS average_competitor_price
FROM quotes GROUP BY product_id""")

cte("hist", ["transactions"], """
SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
       MIN(invoice_date) AS first_sale_date, MAX(invoice_date) AS last_sale_date,
       CAST((epoch_us(MAX(invoice_date)) - epoch_us(MIN(invoice_date))) // 86400000000 + 1 AS INTEGER)
         AS active_days
FROM transactions GROUP BY product_id""")


def with_ctes(sql: str, *names: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    body = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{sql}"


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------

def _pricing_sql(labels: str, signals: bool) -> str:
    hi, lo = ("High", "Low") if labels == "legacy" else ("HIGH", "LOW")
    clicks = "COALESCE(c.real_time_click_count, 0)" if signals else "CAST(0 AS BIGINT)"
    comp = "a.average_competitor_price" if signals else "CAST(NULL AS DOUBLE)"
    joins = ("LEFT JOIN click_counts c ON d.product_id = c.product_id "
             "LEFT JOIN competitor_avg a ON d.product_id = a.product_id") if signals else ""
    return f"""
SELECT product_id, product_name, category, average_selling_price,
       {R2('average_selling_price * (CAST(1 AS DOUBLE) + price_adjustment_percentage / CAST(100 AS DOUBLE))')} AS recommended_price,
       total_quantity_sold, average_daily_demand, demand_level, current_stock, reorder_level,
       stockout_risk, real_time_click_count, real_time_demand_signal, average_competitor_price,
       pricing_action, price_adjustment_percentage
FROM (
  SELECT *, CASE pricing_action WHEN 'INCREASE_PRICE' THEN CAST(10 AS DOUBLE)
                                WHEN 'DECREASE_PRICE' THEN CAST(-10 AS DOUBLE)
                                WHEN 'MATCH_COMPETITOR' THEN CAST(-5 AS DOUBLE)
                                ELSE CAST(0 AS DOUBLE) END AS price_adjustment_percentage
  FROM (
    SELECT *, CASE
        WHEN demand_level = '{hi}' AND stockout_risk = 'HIGH' THEN 'INCREASE_PRICE'
        WHEN real_time_demand_signal = 'HIGH' AND current_stock <= reorder_level THEN 'INCREASE_PRICE'
        WHEN demand_level = '{lo}' AND current_stock > 500 THEN 'DECREASE_PRICE'
        WHEN average_competitor_price IS NOT NULL AND average_competitor_price < average_selling_price
          THEN 'MATCH_COMPETITOR'
        ELSE 'KEEP_PRICE' END AS pricing_action
    FROM (
      SELECT d.product_id, d.product_name, d.category, d.total_quantity_sold,
             d.average_daily_demand, d.average_selling_price, d.demand_level,
             i.current_stock, i.reorder_level, i.stockout_risk,
             {clicks} AS real_time_click_count,
             {signal_sql(clicks)} AS real_time_demand_signal,
             {comp} AS average_competitor_price
      FROM demand d LEFT JOIN inv_analytics i ON d.product_id = i.product_id
      {joins}) s) t) u"""


def _q():
    q: dict[str, str] = {}
    tx_cols = ("invoice_no, product_id, description, quantity, invoice_date, unit_price, "
               "country, customer_id, revenue")
    q["clean_transactions"] = with_ctes(f"SELECT {tx_cols} FROM feed_clean", "feed_clean")
    q["standardize_catalog"] = with_ctes("SELECT * FROM catalog_std", "catalog_std")
    q["standardize_inventory"] = with_ctes("SELECT * FROM inventory_std", "inventory_std")
    q["master_sales"] = with_ctes("SELECT * FROM master_sales", "master_sales")
    q["sales_calendar"] = with_ctes("""
SELECT invoice_no, product_id, invoice_date, quantity,
       CAST(year(invoice_date) AS INTEGER) AS year, CAST(month(invoice_date) AS INTEGER) AS month,
       CAST(day(invoice_date) AS INTEGER) AS day,
       CAST(dayofweek(invoice_date) + 1 AS INTEGER) AS day_of_week
FROM transactions""", "transactions")
    q["master_sales_partition_pruned"] = with_ctes(
        f"SELECT * FROM master_sales WHERE year = 1997", "master_sales")
    q["demand_analytics"] = with_ctes("SELECT * FROM demand_default", "demand_default")
    q["demand_levels"] = with_ctes("""
SELECT product_id, product_name, category, average_daily_demand, demand_level FROM demand""",
                                   "demand")
    q["top_products"] = with_ctes("""
SELECT * FROM demand_default
ORDER BY total_quantity_sold DESC, product_id, product_name, category LIMIT 10""",
                                  "demand_default")
    q["inventory_analytics"] = with_ctes("SELECT * FROM inv_analytics", "inv_analytics")
    q["stockout_risk"] = with_ctes("""
SELECT product_id, product_name, category, current_stock, reorder_level, lead_time_days,
       stock_coverage_days, stockout_risk FROM inv_analytics""", "inv_analytics")
    q["reorder_quantity"] = with_ctes("""
SELECT product_id, product_name, category, current_stock, reorder_level,
       recommended_reorder_quantity FROM inv_analytics""", "inv_analytics")
    q["lowest_coverage"] = with_ctes("""
SELECT * FROM inv_analytics
ORDER BY stock_coverage_days ASC NULLS FIRST, product_id, product_name, category LIMIT 20""",
                                     "inv_analytics")
    q["click_counts"] = with_ctes("SELECT * FROM click_counts", "click_counts")
    q["click_signal"] = with_ctes(f"""
SELECT product_id, real_time_click_count,
       {signal_sql('real_time_click_count')} AS real_time_demand_signal FROM click_counts""",
                                  "click_counts")
    q["click_counts_attached"] = with_ctes("""
SELECT d.product_id, d.product_name, d.category,
       COALESCE(c.real_time_click_count, 0) AS real_time_click_count
FROM demand d LEFT JOIN click_counts c ON d.product_id = c.product_id""",
                                           "demand", "click_counts")
    q["competitor_average"] = with_ctes("SELECT * FROM competitor_avg", "competitor_avg")
    q["competitor_attached"] = with_ctes("""
SELECT d.product_id, d.product_name, d.category, d.average_selling_price,
       a.average_competitor_price
FROM demand d LEFT JOIN competitor_avg a ON d.product_id = a.product_id""",
                                         "demand", "competitor_avg")
    q["demand_score"] = with_ctes("""
SELECT product_id, product_name, category, demand_level,
       CASE WHEN demand_level = 'High' THEN 3 WHEN demand_level = 'Medium' THEN 2 ELSE 1 END
         AS demand_score,
       CASE WHEN demand_level = 'HIGH' THEN 3 WHEN demand_level = 'MEDIUM' THEN 2 ELSE 1 END
         AS demand_score_normalized
FROM demand""", "demand")
    deps = ("demand", "inv_analytics", "click_counts", "competitor_avg")
    q["dynamic_pricing"] = with_ctes(_pricing_sql("legacy", True), *deps)
    q["dynamic_pricing_normalized"] = with_ctes(_pricing_sql("normalized", True), *deps)
    q["pricing_without_signals"] = with_ctes(_pricing_sql("legacy", False),
                                             "demand", "inv_analytics")
    q["inventory_optimization"] = with_ctes("""
SELECT product_id, product_name, category, current_stock, reorder_level, lead_time_days,
       stock_coverage_days, stockout_risk, average_daily_demand, demand_level,
       real_time_click_count, real_time_demand_status, inventory_action,
       recommended_reorder_quantity,
       CASE WHEN inventory_action IN ('URGENT_RESTOCK', 'RESTOCK_SOON')
            THEN recommended_reorder_quantity ELSE 0 END AS final_reorder_quantity
FROM (
  SELECT *, CASE
      WHEN current_stock <= reorder_level AND real_time_demand_status = 'HIGH' THEN 'URGENT_RESTOCK'
      WHEN stockout_risk = 'HIGH' THEN 'URGENT_RESTOCK'
      WHEN stockout_risk = 'MEDIUM' THEN 'RESTOCK_SOON'
      WHEN current_stock > 500 THEN 'OVERSTOCK'
      ELSE 'NORMAL' END AS inventory_action
  FROM (
    SELECT i.*, COALESCE(c.real_time_click_count, 0) AS real_time_click_count,
           """ + signal_sql("COALESCE(c.real_time_click_count, 0)") + """ AS real_time_demand_status
    FROM inv_analytics i LEFT JOIN click_counts c ON i.product_id = c.product_id) s) t""",
                                            "inv_analytics", "click_counts")
    q["prepare_transactions"] = with_ctes("SELECT * FROM transactions", "transactions")
    q["drop_cancelled"] = with_ctes("""
SELECT trim(invoice_no) AS invoice_no, product_id, description, quantity, invoice_date,
       unit_price, customer_id, country
FROM ledger WHERE invoice_no IS NULL OR NOT starts_with(upper(trim(invoice_no)), 'C')""",
                                    "ledger")
    q["dedupe_rows"] = with_ctes("""
SELECT DISTINCT * FROM ledger""", "ledger")
    q["ledger_headers"] = with_ctes("SELECT * FROM ledger", "ledger")
    q["dropped_rows"] = with_ctes("""
SELECT r.reason, COUNT(l.reason) AS rows
FROM (VALUES ('invoice_no'), ('product_id'), ('invoice_date'), ('quantity'), ('unit_price'), ('cancelled'),
             ('quantity_not_positive'), ('unit_price_not_positive')) r(reason)
LEFT JOIN ledger_judged l ON l.reason = r.reason GROUP BY r.reason""", "ledger_judged")
    q["validation_report_prepared"] = with_ctes("""
SELECT * FROM (
  SELECT 1 AS position, 'transaction_rows' AS metric, CAST(COUNT(*) AS VARCHAR) AS value FROM transactions
  UNION ALL SELECT 2, 'transaction_products', CAST(COUNT(DISTINCT product_id) AS VARCHAR) FROM transactions
  UNION ALL SELECT 3, 'catalog_products',
        CAST(COUNT(DISTINCT product_id) AS VARCHAR) FROM transactions WHERE description IS NOT NULL
  UNION ALL SELECT 4, 'inventory_products', CAST(COUNT(DISTINCT product_id) AS VARCHAR) FROM transactions
  UNION ALL SELECT 5, 'missing_from_catalog',
        CAST(COUNT(*) AS VARCHAR) FROM (SELECT product_id FROM transactions GROUP BY 1 HAVING COUNT(description) = 0)
  UNION ALL SELECT i, m, '0' FROM (VALUES (6, 'missing_from_inventory'), (7, 'duplicate_catalog_ids'),
        (8, 'duplicate_inventory_ids'), (9, 'negative_quantities'), (10, 'negative_unit_prices'),
        (11, 'negative_current_stock')) z(i, m)
  UNION ALL SELECT 12, 'validation', CASE WHEN COUNT(*) = 0 THEN 'SUCCESSFUL' ELSE 'FAILED' END
        FROM (SELECT product_id FROM transactions GROUP BY 1 HAVING COUNT(description) = 0)) r""", "transactions")
    q["build_catalog"] = with_ctes(f"""
SELECT product_id, product_name, {classify_sql('product_name')} AS category, selling_price
FROM (
  SELECT product_id,
         first(description ORDER BY invoice_date, invoice_no, description) AS product_name,
         CAST(median(unit_price) AS DOUBLE) AS selling_price
  FROM transactions WHERE product_id IS NOT NULL AND description IS NOT NULL
  GROUP BY product_id) c""", "transactions")
    q["classify_product"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, product_name,
       {classify_sql('product_name')} AS category FROM (SELECT *, {_NAMED} AS product_name FROM part) p"""
    q["lead_time"] = with_ctes(f"""
SELECT product_id, {lead_sql('product_id')} AS lead_time_days
FROM (SELECT DISTINCT product_id FROM transactions) t""", "transactions")
    q["historical_demand"] = with_ctes("SELECT * FROM hist", "hist")
    q["generate_inventory"] = with_ctes("""
SELECT product_id, initial_stock,
       CAST(greatest(initial_stock - total_quantity_sold, 0) AS INTEGER) AS current_stock,
       CAST(ceil(daily * lead_time_days + safety) AS INTEGER) AS reorder_level,
       lead_time_days
FROM (
  SELECT *, CAST(greatest(ceil(daily * CAST(30 AS DOUBLE) + safety), 1) AS INTEGER) AS initial_stock
  FROM (
    SELECT *, ceil(daily * lead_time_days * CAST(0.5 AS DOUBLE)) AS safety
    FROM (
      SELECT product_id, total_quantity_sold,
             greatest(COALESCE(CASE WHEN active_days <> 0
                                    THEN CAST(total_quantity_sold AS DOUBLE) / active_days END,
                               CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)) AS daily,
             """ + lead_sql("product_id") + """ AS lead_time_days
      FROM hist) a) b) c""", "hist")
    q["quality_report"] = with_ctes(f"""
  SELECT 'initial_rows' AS metric, CAST((SELECT COUNT(*) FROM ledger) AS VARCHAR) AS value
  UNION ALL SELECT 'final_transaction_rows', CAST(COUNT(*) AS VARCHAR) FROM transactions
  UNION ALL SELECT 'removed_rows', CAST((SELECT COUNT(*) FROM ledger) - (SELECT COUNT(*) FROM transactions) AS VARCHAR)
  UNION ALL SELECT 'unique_products', CAST(COUNT(DISTINCT product_id) AS VARCHAR) FROM transactions
  UNION ALL SELECT 'unique_customers', CAST(COUNT(DISTINCT customer_id) AS VARCHAR) FROM transactions
  UNION ALL SELECT 'unique_countries', CAST(COUNT(DISTINCT country) AS VARCHAR) FROM transactions
  UNION ALL SELECT 'total_quantity', CAST(COALESCE(SUM(quantity), 0) AS VARCHAR) FROM transactions
  UNION ALL SELECT 'total_revenue', CAST(CAST(COALESCE({MSUM('revenue')}, 0) AS DECIMAL(38,6)) AS VARCHAR)
        FROM transactions
  UNION ALL SELECT 'min_invoice_date', CAST(MIN(invoice_date) AS VARCHAR) FROM transactions
  UNION ALL SELECT 'max_invoice_date', CAST(MAX(invoice_date) AS VARCHAR) FROM transactions""",
                                    "ledger", "transactions")
    dup = ("COUNT(*) - COUNT(DISTINCT product_id) - "
           "COALESCE(MAX(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END), 0)")
    q["validation_report"] = with_ctes(f"""
, m AS (
  SELECT 'transaction_rows' AS metric, CAST(COUNT(*) AS BIGINT) AS v FROM transactions
  UNION ALL SELECT 'transaction_products', COUNT(DISTINCT product_id) + COALESCE(MAX(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END), 0) FROM transactions
  UNION ALL SELECT 'catalog_products', COUNT(DISTINCT product_id) + COALESCE(MAX(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END), 0) FROM product_catalog
  UNION ALL SELECT 'inventory_products', COUNT(DISTINCT product_id) + COALESCE(MAX(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END), 0) FROM inventory
  UNION ALL SELECT 'missing_from_catalog', COUNT(*) FROM
        (SELECT product_id FROM transactions EXCEPT SELECT product_id FROM product_catalog) a
  UNION ALL SELECT 'missing_from_inventory', COUNT(*) FROM
        (SELECT product_id FROM transactions EXCEPT SELECT product_id FROM inventory) b
  UNION ALL SELECT 'duplicate_catalog_ids', {dup} FROM product_catalog
  UNION ALL SELECT 'duplicate_inventory_ids', {dup} FROM inventory
  UNION ALL SELECT 'negative_quantities', COUNT(*) FILTER (WHERE quantity < 0) FROM transactions
  UNION ALL SELECT 'negative_unit_prices', COUNT(*) FILTER (WHERE unit_price < 0) FROM transactions
  UNION ALL SELECT 'negative_current_stock', COUNT(*) FILTER (WHERE TRY_CAST(current_stock AS DOUBLE) < 0) FROM inventory
), ordered AS (
  SELECT metric, CAST(v AS VARCHAR) AS value FROM m
  UNION ALL
  SELECT 'validation', CASE WHEN SUM(CASE WHEN metric IN ('missing_from_catalog',
      'missing_from_inventory', 'duplicate_catalog_ids', 'duplicate_inventory_ids',
      'negative_quantities', 'negative_unit_prices', 'negative_current_stock')
      THEN v ELSE 0 END) = 0 THEN 'SUCCESSFUL' ELSE 'FAILED' END FROM m
)
SELECT CAST(list_position(['transaction_rows', 'transaction_products', 'catalog_products',
       'inventory_products', 'missing_from_catalog', 'missing_from_inventory',
       'duplicate_catalog_ids', 'duplicate_inventory_ids', 'negative_quantities',
       'negative_unit_prices', 'negative_current_stock', 'validation'], metric) AS INTEGER)
       AS position, metric, value
FROM ordered""", "transactions", "product_catalog", "inventory")
    q["missing_from_catalog"] = with_ctes("""
SELECT DISTINCT product_id FROM transactions
EXCEPT SELECT product_id FROM product_catalog""", "transactions", "product_catalog")
    q["missing_from_inventory"] = with_ctes("""
SELECT DISTINCT product_id FROM transactions
EXCEPT SELECT product_id FROM inventory""", "transactions", "inventory")
    q["sales_quality"] = with_ctes("""
SELECT COUNT(*) FILTER (WHERE quantity <= 0) AS invalid_quantity,
       COUNT(*) FILTER (WHERE revenue <= 0) AS invalid_revenue,
       COUNT(*) AS row_count FROM master_sales""", "master_sales")
    ledger_types = [(c, "string") for c in ("invoice_no", "product_id", "description", "quantity",
                                            "invoice_date", "unit_price", "customer_id", "country")]
    q["profile_columns"] = with_ctes(" UNION ALL ".join(
        f"SELECT {i + 1} AS position, '{c}' AS column_name, '{t}' AS data_type, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM ledger"
        for i, (c, t) in enumerate(ledger_types)), "ledger")
    q["profile_table"] = with_ctes("""
SELECT CAST(SUM(n) AS BIGINT) AS row_count, 8 AS column_count,
       CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows,
       COUNT(DISTINCT product_id) AS unique_products,
       COUNT(DISTINCT customer_id) AS unique_customers,
       COUNT(DISTINCT country) AS unique_countries,
       MIN(ts) AS min_date, MAX(ts) AS max_date
FROM (SELECT *, TRY_STRPTIME(invoice_date, ['%Y-%m-%d %H:%M:%S', '%-m/%-d/%Y %-H:%M', '%Y/%m/%d %H:%M',
                                            '%Y-%m-%dT%H:%M:%S']) AS ts
      FROM (SELECT *, COUNT(*) AS n FROM ledger GROUP BY ALL) g) t""", "ledger")
    q["parse_clickstream"] = with_ctes("SELECT * FROM clicks_parsed", "clicks_parsed")
    q["parse_competitor"] = with_ctes("SELECT * FROM quotes_parsed", "quotes_parsed")
    q["clean_clickstream"] = with_ctes(f"""
SELECT *, {EVENT_TS} AS event_timestamp,
       {weight_sql('event_type')} AS demand_signal
FROM clicks_parsed
WHERE product_id IS NOT NULL AND event_type IS NOT NULL AND event_time IS NOT NULL""",
                                       "clicks_parsed")
    q["clean_competitor"] = with_ctes(f"""
SELECT *, {EVENT_TS} AS event_timestamp
FROM quotes_parsed
WHERE product_id IS NOT NULL AND competitor_price IS NOT NULL AND competitor IS NOT NULL""",
                                      "quotes_parsed")
    q["event_weight"] = with_ctes(f"""
SELECT event_time, session_id, product_id, event_type,
       {weight_sql('event_type')} AS demand_signal FROM clicks""", "clicks")
    click_fields = ["event_time", "session_id", "user_id", "product_id",
                    "product_description", "event_type", "device", "country"]
    q["events_to_json"] = with_ctes(
        "SELECT CAST(json_object(" + ", ".join(f"'{c}', {c}" for c in click_fields)
        + ") AS VARCHAR) AS value FROM clicks", "clicks")
    q["realtime_pricing"] = with_ctes(f"""
, cg AS (
  SELECT product_id, {weight_sql('event_type')} AS demand_score, COUNT(*) AS click_events
  FROM clicks_parsed WHERE product_id IS NOT NULL GROUP BY 1, 2
), qg AS (
  SELECT product_id, competitor, competitor_price, availability, COUNT(*) AS quote_events
  FROM quotes_parsed WHERE product_id IS NOT NULL GROUP BY 1, 2, 3, 4
)
SELECT cg.product_id, demand_score, competitor, competitor_price, availability,
       CASE WHEN demand_score >= 5 AND competitor_price > 0 THEN 'INCREASE_PRICE'
            WHEN demand_score <= 0 AND competitor_price > 0 THEN 'DECREASE_PRICE'
            ELSE 'MAINTAIN_PRICE' END AS pricing_action,
       click_events * quote_events AS pair_count
FROM cg JOIN qg ON cg.product_id = qg.product_id""",
                                      "clicks_parsed", "quotes_parsed")
    # Every near pair, listed and then counted by the window of its later event.
    q["realtime_pricing_near"] = with_ctes(f"""
, c AS (
  SELECT product_id, {weight_sql('event_type')} AS demand_score, {EVENT_TS} AS clicked
  FROM clicks_parsed WHERE product_id IS NOT NULL
), o AS (
  SELECT product_id, competitor, competitor_price, availability, {EVENT_TS} AS quoted
  FROM recent_parsed WHERE product_id IS NOT NULL
)
SELECT time_bucket(INTERVAL 6 HOURS, greatest(clicked, quoted), TIMESTAMP '2000-01-01') AS window_start,
       c.product_id, demand_score, competitor, competitor_price, availability,
       CASE WHEN demand_score >= 5 AND competitor_price > 0 THEN 'INCREASE_PRICE'
            WHEN demand_score <= 0 AND competitor_price > 0 THEN 'DECREASE_PRICE'
            ELSE 'MAINTAIN_PRICE' END AS pricing_action,
       COUNT(*) AS pair_count
FROM c JOIN o ON c.product_id = o.product_id AND clicked BETWEEN quoted - INTERVAL 6 HOURS AND quoted + INTERVAL 6 HOURS
GROUP BY ALL""", "clicks_parsed", "recent_parsed")
    return q


ORACLE_SQL: dict[str, str] = _q()
