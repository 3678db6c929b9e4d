"""Decision rules as native Column expressions (no Python UDF anywhere).

Each rule is a CASE chain: the first matching branch wins and a null
comparison never matches, exactly like ``when(...).when(...).otherwise``.
Thresholds are keyword arguments whose defaults are the reference values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# --------------------------------------------------------------------------

# Demand and click labels as written by the batch jobs.
LEVEL_LABELS = ("HIGH", "MEDIUM", "LOW")
# Labels the pricing job compares against ("legacy"): they never match the
# upper-case labels above, so demand_score is always 1 and two pricing
# branches never fire. "normalized" compares against LEVEL_LABELS instead.
LEGACY_LABELS = ("High", "Medium", "Low")

# Per-event demand weights of the clickstream jobs; other types weigh 0.
EVENT_WEIGHTS = {
    "purchase": 5,
    "add_to_cart": 3,
    "view": 1,
    "remove_from_cart": -1,
}

# Product categories: ordered rules, upper-cased substring match, first hit
# wins, no hit (or null text) gives OTHER.
CATEGORY_RULES = (
    ("BAG", ("BAG", "PURSE", "TOTE", "SHOPPER")),
    ("MUG", ("MUG", "CUP", "COFFEE CUP", "TEA CUP")),
    ("CANDLE", ("CANDLE", "VOTIVE", "TEALIGHT")),
    ("KITCHEN", ("KITCHEN", "PLATE", "BOWL", "SPOON", "FORK", "KNIFE",
                 "CUTLERY", "JUG", "TEAPOT")),
    ("DECORATION", ("FRAME", "MIRROR", "ORNAMENT", "DECORATION", "WALL",
                    "SIGN", "HANGING")),
    ("TOY", ("TOY", "GAME", "DOLL", "PUZZLE")),
    ("STATIONERY", ("PEN", "PENCIL", "NOTEBOOK", "PAPER", "CARD",
                    "STATIONERY")),
    ("TEXTILE", ("CUSHION", "PILLOW", "TOWEL", "BLANKET", "FABRIC")),
    ("GIFT", ("GIFT", "PRESENT", "WRAP")),
)
OTHER_CATEGORY = "OTHER"

# Pricing and restock constants.
DEMAND_HIGH = 10.0
DEMAND_MEDIUM = 3.0
CLICKS_HIGH = 100
CLICKS_MEDIUM = 30
OVERSTOCK_UNITS = 500
PRICE_STEPS = {
    "INCREASE_PRICE": 10.0,
    "DECREASE_PRICE": -10.0,
    "MATCH_COMPETITOR": -5.0,
}


def labels_for(mode: str) -> tuple[str, str, str]:
    if mode == "legacy":
        return LEGACY_LABELS
    if mode == "normalized":
        return LEVEL_LABELS
    raise ValueError(f"labels must be 'legacy' or 'normalized', not {mode!r}")


# --------------------------------------------------------------------------
# Demand
# --------------------------------------------------------------------------

def active_days(first_date: ColumnOrName, last_date: ColumnOrName) -> Column:
    """Calendar days between first and last sale, both ends included."""
    return F.datediff(_col(last_date), _col(first_date)) + F.lit(1)


def elapsed_days(first_ts: ColumnOrName, last_ts: ColumnOrName) -> Column:
    """Whole elapsed 24-hour periods + 1 (23:00 to 01:00 next day gives 1)."""
    return (F.timestamp_diff("DAY", _col(first_ts), _col(last_ts)) + 1).cast("int")


def average_daily_demand(quantity: ColumnOrName, days: ColumnOrName) -> Column:
    """quantity / days when days > 0, else 0 (unrounded)."""
    q, d = _col(quantity), _col(days)
    return F.when(d > 0, q / d).otherwise(F.lit(0.0))


def demand_level(daily: ColumnOrName, high: float = DEMAND_HIGH,
                 medium: float = DEMAND_MEDIUM) -> Column:
    d = _col(daily)
    hi, mid, lo = LEVEL_LABELS
    return F.when(d >= high, hi).when(d >= medium, mid).otherwise(lo)


def demand_score(level: ColumnOrName, labels: str = "legacy") -> Column:
    hi, mid, _ = labels_for(labels)
    lv = _col(level)
    return F.when(lv == hi, F.lit(3)).when(lv == mid, F.lit(2)).otherwise(F.lit(1))


# --------------------------------------------------------------------------
# Inventory
# --------------------------------------------------------------------------

def stock_coverage(current_stock: ColumnOrName, daily: ColumnOrName) -> Column:
    """Days of stock left; null when there is no demand."""
    d = _col(daily)
    return F.when(d > 0, _col(current_stock) / d).otherwise(F.lit(None).cast("double"))


def stockout_risk(current_stock: ColumnOrName, coverage: ColumnOrName,
                  lead_time: ColumnOrName, reorder_level: ColumnOrName) -> Column:
    stock = _col(current_stock)
    return (
        F.when(stock <= 0, "STOCKOUT")
        .when(_col(coverage) <= _col(lead_time), "HIGH")
        .when(stock <= _col(reorder_level), "MEDIUM")
        .otherwise("LOW")
    )


def reorder_quantity(current_stock: ColumnOrName, reorder_level: ColumnOrName) -> Column:
    stock, level = _col(current_stock), _col(reorder_level)
    return (
        F.when(stock < level, F.greatest(level - stock, F.lit(0)))
        .otherwise(F.lit(0))
    )


# --------------------------------------------------------------------------
# Signals and pricing
# --------------------------------------------------------------------------

def click_signal(clicks: ColumnOrName, high: int = CLICKS_HIGH,
                 medium: int = CLICKS_MEDIUM) -> Column:
    c = _col(clicks)
    hi, mid, lo = LEVEL_LABELS
    return F.when(c >= high, hi).when(c >= medium, mid).otherwise(lo)


def pricing_action(demand_level: ColumnOrName, stockout_risk: ColumnOrName,
                   signal: ColumnOrName, current_stock: ColumnOrName,
                   reorder_level: ColumnOrName, competitor_price: ColumnOrName,
                   own_price: ColumnOrName, labels: str = "legacy",
                   overstock: int = OVERSTOCK_UNITS) -> Column:
    hi, _, lo = labels_for(labels)
    level, stock = _col(demand_level), _col(current_stock)
    comp = _col(competitor_price)
    return (
        F.when((level == hi) & (_col(stockout_risk) == "HIGH"), "INCREASE_PRICE")
        .when((_col(signal) == "HIGH") & (stock <= _col(reorder_level)), "INCREASE_PRICE")
        .when((level == lo) & (stock > overstock), "DECREASE_PRICE")
        .when(comp.isNotNull() & (comp < _col(own_price)), "MATCH_COMPETITOR")
        .otherwise("KEEP_PRICE")
    )


def price_adjustment(action: ColumnOrName, steps: Mapping[str, float] = PRICE_STEPS) -> Column:
    a = _col(action)
    expr = None
    for name, pct in steps.items():
        expr = (F.when if expr is None else expr.when)(a == name, F.lit(float(pct)))
    return expr.otherwise(F.lit(0.0))


def recommended_price(price: ColumnOrName, pct: ColumnOrName) -> Column:
    return F.round(_col(price) * (F.lit(1.0) + _col(pct) / F.lit(100.0)), 2)


# --------------------------------------------------------------------------
# Replenishment
# --------------------------------------------------------------------------

def inventory_action(current_stock: ColumnOrName, reorder_level: ColumnOrName,
                     demand_status: ColumnOrName, risk: ColumnOrName,
                     overstock: int = OVERSTOCK_UNITS,
                     stockout_is_urgent: bool = False) -> Column:
    stock, r = _col(current_stock), _col(risk)
    urgent_risk = (r == "HIGH") | (r == "STOCKOUT") if stockout_is_urgent else (r == "HIGH")
    return (
        F.when((stock <= _col(reorder_level)) & (_col(demand_status) == "HIGH"),
               "URGENT_RESTOCK")
        .when(urgent_risk, "URGENT_RESTOCK")
        .when(r == "MEDIUM", "RESTOCK_SOON")
        .when(stock > overstock, "OVERSTOCK")
        .otherwise("NORMAL")
    )


def final_reorder(action: ColumnOrName, quantity: ColumnOrName) -> Column:
    a = _col(action)
    return (
        F.when(a.isin("URGENT_RESTOCK", "RESTOCK_SOON"), _col(quantity))
        .otherwise(F.lit(0))
    )


# --------------------------------------------------------------------------
# Streams
# --------------------------------------------------------------------------

def event_weight(event_type: ColumnOrName,
                 weights: Mapping[str, int] = EVENT_WEIGHTS) -> Column:
    t = _col(event_type)
    expr = None
    for name, w in weights.items():
        expr = (F.when if expr is None else expr.when)(t == name, F.lit(int(w)))
    return expr.otherwise(F.lit(0))


def realtime_action(weight: ColumnOrName, price: ColumnOrName) -> Column:
    w, p = _col(weight), _col(price)
    return (
        F.when((w >= 5) & (p > 0), "INCREASE_PRICE")
        .when((w <= 0) & (p > 0), "DECREASE_PRICE")
        .otherwise("MAINTAIN_PRICE")
    )


# --------------------------------------------------------------------------
# Preparation
# --------------------------------------------------------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def classify_product(text: ColumnOrName,
                     rules: Sequence[tuple[str, Sequence[str]]] = CATEGORY_RULES) -> Column:
    """Keyword category; kept in codegen as a CASE over ``contains``.

    For a column name the CASE is handed to Catalyst as one SQL expression
    (a single call into the JVM instead of ~20 per keyword); the
    expression is the same either way.
    """
    if isinstance(text, str):
        ref = "`" + text.replace("`", "``") + "`"
        branches = " ".join(
            "WHEN " + " OR ".join(f"contains(upper({ref}), {_sql_str(k)})"
                                  for k in dict.fromkeys(kws)) + f" THEN {_sql_str(cat)}"
            for cat, kws in rules)
        return F.expr(f"CASE {branches} ELSE {_sql_str(OTHER_CATEGORY)} END")
    upper = F.upper(_col(text))
    expr = None
    for category, keywords in rules:
        hit = None
        for kw in dict.fromkeys(keywords):
            cond = upper.contains(kw)
            hit = cond if hit is None else (hit | cond)
        expr = (F.when if expr is None else expr.when)(hit, F.lit(category))
    return F.coalesce(expr, F.lit(OTHER_CATEGORY))


def lead_time(product_id: ColumnOrName, modulus: int = 12, base: int = 3) -> Column:
    """(sum of the code points of the id) mod 12 + 3, range 3..14."""
    chars = F.split(_col(product_id).cast("string"), "")
    total = F.aggregate(F.transform(chars, lambda ch: F.ascii(ch)), F.lit(0),
                        lambda acc, x: acc + x)
    return (total % modulus + base).cast("int")
