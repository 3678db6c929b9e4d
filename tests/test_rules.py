"""Branch tables for the rule expressions: every branch, each threshold
exactly and one step either side, and nulls."""

from pyspark.sql import functions as F

from shelfwise.functions import rules


def one(spark, expr, data, schema):
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in df.select(expr.alias("r")).collect()]


def test_demand_level(spark):
    got = one(spark, rules.demand_level("d"),
              [(10.0,), (9.99,), (3.0,), (2.99,), (0.0,), (None,)], "d double")
    assert got == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "LOW"]
    got = one(spark, rules.demand_level("d", high=0.3, medium=0.2),
              [(0.3,), (0.2,), (0.19,)], "d double")
    assert got == ["HIGH", "MEDIUM", "LOW"]


def test_active_days_vs_elapsed(spark):
    df = spark.createDataFrame([("2024-01-01 23:00:00", "2024-01-02 01:00:00")], "a string, b string")
    df = df.select(F.col("a").cast("timestamp_ntz").alias("a"),
                   F.col("b").cast("timestamp_ntz").alias("b"))
    r = df.select(rules.active_days(F.to_date("a"), F.to_date("b")).alias("cal"),
                  rules.elapsed_days("a", "b").alias("el")).first()
    assert (r.cal, r.el) == (2, 1)


def test_average_daily_demand(spark):
    got = one(spark, rules.average_daily_demand("q", "d"),
              [(10, 5), (10, 0), (None, 3), (7, None)], "q bigint, d int")
    assert got == [2.0, 0.0, None, 0.0]


def test_stock_coverage_and_risk(spark):
    data = [  # stock, daily, lead, reorder
        (0, 1.0, 5, 10),     # STOCKOUT
        (-3, 1.0, 5, 10),    # STOCKOUT
        (5, 1.0, 5, 3),      # coverage == lead -> HIGH
        (6, 1.0, 5, 3),      # coverage > lead, stock > reorder -> LOW
        (6, 1.0, 5, 6),      # stock == reorder -> MEDIUM
        (6, 0.0, 5, 6),      # no demand: coverage null, stock == reorder -> MEDIUM
        (6, 0.0, 5, 5),      # no demand, above reorder -> LOW
        (None, 1.0, None, None),  # no inventory row -> LOW
    ]
    df = spark.createDataFrame(data, "s int, d double, l int, r int")
    df = df.withColumn("cov", rules.stock_coverage("s", "d"))
    got = [x[0] for x in df.select(rules.stockout_risk("s", "cov", "l", "r")).collect()]
    assert got == ["STOCKOUT", "STOCKOUT", "HIGH", "LOW", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    assert df.filter(F.col("d") == 0).select("cov").distinct().collect()[0][0] is None


def test_reorder_quantity(spark):
    got = one(spark, rules.reorder_quantity("s", "r"),
              [(3, 10), (10, 10), (11, 10), (None, 10), (-2, 5)], "s int, r int")
    assert got == [7, 0, 0, 0, 7]


def test_click_signal(spark):
    got = one(spark, rules.click_signal("c"),
              [(100,), (99,), (30,), (29,), (0,), (None,)], "c bigint")
    assert got == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "LOW"]


def test_demand_score_labels(spark):
    data = [("HIGH",), ("MEDIUM",), ("LOW",), ("High",), ("Medium",), (None,)]
    assert one(spark, rules.demand_score("l", "legacy"), data, "l string") == [1, 1, 1, 3, 2, 1]
    assert one(spark, rules.demand_score("l", "normalized"), data, "l string") == [3, 2, 1, 1, 1, 1]


def test_pricing_action_branches(spark):
    schema = "lvl string, risk string, sig string, s int, r int, comp double, own double"
    data = [
        ("HIGH", "HIGH", "LOW", 10, 5, None, 10.0),      # 1: high demand + high risk
        ("MEDIUM", "LOW", "HIGH", 5, 5, None, 10.0),     # 2: signal + stock == reorder
        ("MEDIUM", "LOW", "HIGH", 6, 5, None, 10.0),     # signal but stock above reorder
        ("LOW", "LOW", "LOW", 501, 5, None, 10.0),       # 3: low demand + overstock
        ("LOW", "LOW", "LOW", 500, 5, None, 10.0),       # exactly 500 is not overstock
        ("MEDIUM", "LOW", "LOW", 5, 1, 9.99, 10.0),      # 4: competitor cheaper
        ("MEDIUM", "LOW", "LOW", 5, 1, 10.0, 10.0),      # equal price: keep
        ("MEDIUM", None, None, None, None, None, None),  # all null: keep
    ]
    norm = one(spark, rules.pricing_action("lvl", "risk", "sig", "s", "r", "comp", "own",
                                           labels="normalized"), data, schema)
    assert norm == ["INCREASE_PRICE", "INCREASE_PRICE", "KEEP_PRICE", "DECREASE_PRICE",
                    "KEEP_PRICE", "MATCH_COMPETITOR", "KEEP_PRICE", "KEEP_PRICE"]
    legacy = one(spark, rules.pricing_action("lvl", "risk", "sig", "s", "r", "comp", "own"),
                 data, schema)
    # upper-case levels never match "High"/"Low": branches 1 and 3 are dead
    assert legacy == ["KEEP_PRICE", "INCREASE_PRICE", "KEEP_PRICE", "KEEP_PRICE",
                      "KEEP_PRICE", "MATCH_COMPETITOR", "KEEP_PRICE", "KEEP_PRICE"]


def test_price_adjustment_and_recommended(spark):
    data = [("INCREASE_PRICE", 10.0), ("DECREASE_PRICE", 10.0), ("MATCH_COMPETITOR", 1.005),
            ("KEEP_PRICE", 2.675), (None, None)]
    df = spark.createDataFrame(data, "a string, p double")
    df = df.withColumn("pct", rules.price_adjustment("a"))
    got = [(r.pct, r.rec) for r in df.select(
        "pct", rules.recommended_price("p", "pct").alias("rec")).collect()]
    assert got == [(10.0, 11.0), (-10.0, 9.0), (-5.0, 0.95), (0.0, 2.68), (0.0, None)]


def test_inventory_action_and_final_reorder(spark):
    schema = "s int, r int, st string, risk string, q int"
    data = [
        (5, 5, "HIGH", "LOW", 3),          # urgent by signal (stock == reorder)
        (6, 5, "HIGH", "LOW", 0),          # signal, stock above reorder -> LOW risk -> NORMAL
        (6, 5, "LOW", "HIGH", 4),          # urgent by risk
        (6, 5, "LOW", "MEDIUM", 2),        # restock soon
        (501, 5, "LOW", "LOW", 0),         # overstock
        (500, 5, "LOW", "LOW", 0),         # normal
        (0, 5, "LOW", "STOCKOUT", 5),      # stockout falls to NORMAL by default
    ]
    df = spark.createDataFrame(data, schema)
    act = df.withColumn("a", rules.inventory_action("s", "r", "st", "risk"))
    got = [(r.a, r.f) for r in act.select("a", rules.final_reorder("a", "q").alias("f")).collect()]
    assert got == [("URGENT_RESTOCK", 3), ("NORMAL", 0), ("URGENT_RESTOCK", 4),
                   ("RESTOCK_SOON", 2), ("OVERSTOCK", 0), ("NORMAL", 0), ("NORMAL", 0)]
    urgent = df.select(rules.inventory_action("s", "r", "st", "risk",
                                              stockout_is_urgent=True)).collect()
    assert urgent[-1][0] == "URGENT_RESTOCK"


def test_event_weight_and_realtime_action(spark):
    types = [("purchase",), ("add_to_cart",), ("view",), ("remove_from_cart",),
             ("search",), ("wishlist",), (None,)]
    assert one(spark, rules.event_weight("t"), types, "t string") == [5, 3, 1, -1, 0, 0, 0]
    data = [(5, 1.0), (5, 0.0), (3, 1.0), (0, 1.0), (-1, 2.0), (0, None), (5, None)]
    got = one(spark, rules.realtime_action("w", "p"), data, "w int, p double")
    assert got == ["INCREASE_PRICE", "MAINTAIN_PRICE", "MAINTAIN_PRICE", "DECREASE_PRICE",
                   "DECREASE_PRICE", "MAINTAIN_PRICE", "MAINTAIN_PRICE"]


def test_classify_product(spark):
    data = [("JUMBO BAG RED",), ("white mug",), ("TEALIGHT holder",), ("cake plate",),
            ("DESIGN poster",), ("toy car",), ("OPEN box",), ("cupboard",),
            ("silk cushion",), ("gift wrap",), ("zebra",), (None,), ("",),
            ("Shopper and mug",)]
    got = one(spark, rules.classify_product("t"), data, "t string")
    assert got == ["BAG", "MUG", "CANDLE", "KITCHEN", "DECORATION", "TOY",
                   "STATIONERY", "MUG", "TEXTILE", "GIFT", "OTHER", "OTHER", "OTHER", "BAG"]


def test_lead_time(spark):
    got = one(spark, rules.lead_time("p"), [("85123A",), ("1",), ("",), ("22423",)], "p string")
    expect = [sum(map(ord, s)) % 12 + 3 for s in ["85123A", "1", "", "22423"]]
    assert got == expect and got[0] == 3


def test_classify_product_column_and_name_agree(spark):
    data = [("JUMBO BAG RED",), ("tea cup",), ("it's a plate",), (None,), ("x\\y wall",)]
    df = spark.createDataFrame(data, "t string")
    by_name = [r[0] for r in df.select(rules.classify_product("t")).collect()]
    by_col = [r[0] for r in df.select(rules.classify_product(F.col("t"))).collect()]
    assert by_name == by_col == ["BAG", "MUG", "KITCHEN", "OTHER", "DECORATION"]
