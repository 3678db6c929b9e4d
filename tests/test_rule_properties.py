"""Randomised checks: Spark rule expressions against plain-Python
statements of the same rules (first matching branch wins; a comparison
with a missing value never matches)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfwise.functions import rules

CHARS = st.sampled_from(list("abcdefghijklmnopqrstuvwxyz ABGCUPENSIORTWLKDMFY") +
                        ["bag", "cup", "pen", "sign", "gift", "toy", "wall", "mug"])
TEXT = st.one_of(st.none(), st.lists(CHARS, max_size=12).map("".join))
SETTINGS = settings(max_examples=25, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_classify(text):
    if text is None:
        return "OTHER"
    up = text.upper()
    for cat, kws in rules.CATEGORY_RULES:
        if any(k in up for k in kws):
            return cat
    return "OTHER"


def lt(a, b):
    return a is not None and b is not None and a < b


def le(a, b):
    return a is not None and b is not None and a <= b


def py_risk(stock, cov, lead, reorder):
    if le(stock, 0):
        return "STOCKOUT"
    if le(cov, lead):
        return "HIGH"
    if le(stock, reorder):
        return "MEDIUM"
    return "LOW"


def py_action(level, risk, signal, stock, reorder, comp, own, labels):
    hi, _, lo = rules.labels_for(labels)
    if level == hi and risk == "HIGH":
        return "INCREASE_PRICE"
    if signal == "HIGH" and le(stock, reorder):
        return "INCREASE_PRICE"
    if level == lo and lt(500, stock):
        return "DECREASE_PRICE"
    if comp is not None and lt(comp, own):
        return "MATCH_COMPETITOR"
    return "KEEP_PRICE"


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_classify_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(rules.classify_product("t")).collect()]
    assert got == [py_classify(t) for t in texts]


@SETTINGS
@given(st.lists(st.text(alphabet="0123456789ABCDEFXYZ", max_size=10), min_size=1, max_size=40))
def test_lead_time_matches_python(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "p string")
    got = [r[0] for r in df.select(rules.lead_time("p")).collect()]
    assert got == [sum(map(ord, i)) % 12 + 3 for i in ids]


NUM = st.one_of(st.none(), st.integers(-3, 600))
LEVEL = st.sampled_from([None, "HIGH", "MEDIUM", "LOW", "High", "Low"])
RISK = st.sampled_from([None, "STOCKOUT", "HIGH", "MEDIUM", "LOW"])
PRICE = st.one_of(st.none(), st.sampled_from([0.5, 1.0, 9.99, 10.0, 10.01]))


@SETTINGS
@given(st.lists(st.tuples(NUM, st.one_of(st.none(), st.floats(0, 50)), NUM, NUM),
                min_size=1, max_size=40))
def test_stockout_risk_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "s int, c double, l int, r int")
    got = [x[0] for x in df.select(rules.stockout_risk("s", "c", "l", "r")).collect()]
    assert got == [py_risk(*r) for r in rows]


@SETTINGS
@given(st.lists(st.tuples(LEVEL, RISK, st.sampled_from([None, "HIGH", "LOW"]), NUM, NUM,
                          PRICE, PRICE), min_size=1, max_size=40),
       st.sampled_from(["legacy", "normalized"]))
def test_pricing_action_matches_python(spark, rows, labels):
    df = spark.createDataFrame(rows, "lv string, rk string, sg string, s int, r int, "
                                     "c double, o double")
    expr = rules.pricing_action("lv", "rk", "sg", "s", "r", "c", "o", labels=labels)
    got = [x[0] for x in df.select(expr).collect()]
    assert got == [py_action(*r, labels) for r in rows]
