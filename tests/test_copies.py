"""Copies of rows by hash first: equal to grouping whole rows, whatever the
values, and without shuffling rows that have no copy."""

import glob
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.operators import copies
from shelfwise.operators.prepare import dedupe_rows, prepare_transactions, sorted_by_time
from shelfwise.operators.quality import profile_table
from shelfwise.sources import testviews as tv


def _all(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def odd_rows(spark):
    rng = random.Random(3)
    values = [None, float("nan"), 0.0, -0.0, math.inf, 1.5]
    rows = [(rng.choice([None, "", "a", "b"]), rng.choice([None, "", "a", "b"]), rng.choice(values),
             rng.choice([None, [1], [1, None], []])) for _ in range(400)]
    return spark.createDataFrame(rows, "`a.b` string, _h1x string, v double, l array<int>")


@pytest.mark.parametrize("most", [10 ** 6, 3])
def test_equals_drop_duplicates(spark, most):
    df = odd_rows(spark)
    got, want = copies.drop_copies(df, most), df.dropDuplicates()
    assert got.columns == df.columns and got.count() == want.count()
    assert _all(got.select(*[F.col(f"`{c}`") for c in df.columns[:2]])) == _all(want.select("`a.b`", "_h1x"))
    text = lambda d: _all(d.select("`a.b`", "_h1x", (F.col("v") + 0.0).alias("v"), "l"))
    assert text(got) == text(want)


def test_shared_hash_is_no_copy(spark, monkeypatch):
    """Rows under one hash stay if their values differ."""
    df = spark.createDataFrame([(1, "x"), (2, "x"), (2, "x"), (3, "y")], "i int, s string")
    monkeypatch.setattr(copies, "with_row_hash", lambda d: d.withColumns({"_h1": F.lit(0).cast("long"), "_h2": F.lit(0).cast("long")}))
    assert _all(copies.drop_copies(df)) == _all(df.distinct())
    one = profile_table(df.withColumns({"product_id": F.col("i"), "customer_id": F.col("s"), "country": F.col("s"),
                                        "invoice_date": F.lit("2024-01-01")})).first()
    assert one["duplicate_rows"] == 1 and one["row_count"] == 4


@pytest.mark.parametrize("rows", [[], [(1, "a")], [(1, "a"), (2, "a")], [(1, "a")] * 5])
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, "i int, s string")
    assert _all(copies.drop_copies(df)) == _all(df.distinct())


def test_ledger_and_profile_agree_with_row_grouping(spark, monkeypatch):
    ledger = tv.ledger(spark, SF_SMALL)
    assert _all(dedupe_rows(ledger)) == _all(dedupe_rows(ledger, method="rows"))
    assert _all(prepare_transactions(ledger, dedupe_method="hashes")) == _all(prepare_transactions(ledger))
    by_hash, by_row = profile_table(ledger), profile_table(ledger, duplicates="rows")
    assert by_hash.collect() == by_row.collect() and by_hash.first()["duplicate_rows"] > 0
    monkeypatch.setattr(copies, "BROADCAST_HASHES", 0)
    assert copies.copied_rows(ledger, 0) is None


def _shuffled_bytes(folder, after):
    total = 0
    for path in glob.glob(f"{folder}/*"):
        for line in open(path):
            if '"SparkListenerTaskEnd"' in line:
                e = json.loads(line)
                if e["Task Info"]["Launch Time"] >= after:
                    total += (e.get("Task Metrics") or {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
    return total


def test_shuffle_carries_hashes_not_rows(tmp_dir):
    """Bytes from the event log of a session of its own."""
    import os
    import subprocess
    import sys
    os.makedirs(f"{tmp_dir}/events")
    code = f"""
import sys, time; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession, functions as F
from shelfwise.operators.copies import drop_copies
s = (SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.eventLog.enabled', 'true')
     .config('spark.eventLog.dir', 'file://{tmp_dir}/events').config('spark.sql.shuffle.partitions', '4')
     .config('spark.eventLog.compress', 'false').config('spark.eventLog.rolling.enabled', 'false').getOrCreate())
n = 40000
wide = [F.sha2(F.concat(F.col('id').cast('string'), F.lit(str(i))), 256).alias(f'c{{i}}') for i in range(8)]
rows = s.range(n).select('id', *wide)
rows.union(rows.where('id % 1000 = 0')).write.parquet('{tmp_dir}/rows')
rows = s.read.parquet('{tmp_dir}/rows')
t = [time.time()]
assert drop_copies(rows).count() == n
drop_copies(rows).write.format('noop').mode('overwrite').save(); t.append(time.time())
rows.dropDuplicates().write.format('noop').mode('overwrite').save(); t.append(time.time())
s.stop(); print('TIMES', *[int(x * 1000) for x in t])
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    t = [int(x) for x in out.stdout.split("TIMES")[1].split()]
    both, rows = _shuffled_bytes(f"{tmp_dir}/events", t[0]), _shuffled_bytes(f"{tmp_dir}/events", t[1])
    hashes = (both - rows) / 2  # the method ran twice
    assert 0 < hashes < 40_000 * 40 and rows > 10 * hashes


def test_transactions_in_order_over_all_files(spark, tmp_dir):
    """O3: files in name order hold rows in time order; a hot moment is cut
    between tasks by the further keys."""
    n = 20000
    tx = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.lit("2024-03-01 10:00:00")).otherwise(
            F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"), F.lit(" 09:30:00")))
        .cast("timestamp").alias("invoice_date"), F.col("id").cast("string").alias("invoice_no"), F.lit("p").alias("product_id"))
    sorted_by_time(tx, 6).write.parquet(f"{tmp_dir}/tx")
    files = sorted(glob.glob(f"{tmp_dir}/tx/part-*"))
    parts = [[(r[0], r[1]) for r in spark.read.parquet(f).select("invoice_date", "invoice_no").collect()] for f in files]
    assert len(files) >= 5 and max(map(len, parts)) < n / 3
    flat = [r for p in parts for r in p]
    assert len(flat) == n and flat == sorted(flat)
