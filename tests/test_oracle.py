"""Every registered query against its DuckDB oracle at sf0.001."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from shelfwise.plans.oracle import ORACLE_SQL
from shelfwise.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else repr(v)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted("|".join(_norm(r[c]) for c in cols) for r in pdf.to_dict("records"))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLE_SQL[name]).df()
    assert _rows(got) == _rows(want)


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "pricing_action" in df.columns
