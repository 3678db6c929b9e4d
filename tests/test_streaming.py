"""Streaming: file source + availableNow, parity with the batch transforms,
restart from the checkpoint, and the incremental real-time join."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.schemas import CLICKSTREAM_COLUMNS, COMPETITOR_COLUMNS
from shelfwise.sources import testviews as tv
from shelfwise.streaming import events as ev
from shelfwise.streaming.jobs import (
    land_clickstream,
    land_competitor_prices,
    land_realtime_pricing,
    read_topic,
)


def _write_lines(df, path, parts):
    # parts: list of predicates on _key; each becomes one text file folder
    for i, pred in enumerate(parts):
        tv.json_lines(df.filter(pred)).coalesce(1).write.mode("overwrite").text(f"{path}/p{i}")


def _sorted(df, cols):
    return sorted(repr(tuple(r)) for r in df.select(*cols).collect())  # as text: NaN equals NaN


def test_clickstream_landing_matches_batch_and_restarts(spark, tmp_dir):
    clicks = tv.clicks(spark, SF_SMALL, with_key=True)
    src = f"{tmp_dir}/src"
    _write_lines(clicks, src, [F.col("_key") % 2 == 0])
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    raw = read_topic(spark, fmt="text", path=f"{src}/*", maxFilesPerTrigger=1)
    land_clickstream(raw, out, ckpt, available_now=True).awaitTermination()
    landed = spark.read.parquet(out)
    assert landed.columns == CLICKSTREAM_COLUMNS
    cols = [c for c in CLICKSTREAM_COLUMNS if c != "processed_at"]
    batch = ev.clean_clickstream(ev.parse_clicks(tv.json_lines(clicks.filter(F.col("_key") % 2 == 0))),
                                 processed_at=False)
    assert _sorted(landed, cols) == _sorted(batch, cols)
    first = landed.count()
    # restart: same files again (no new data) and one new file
    tv.json_lines(clicks.filter(F.col("_key") % 2 == 1)).coalesce(1).write.text(f"{src}/p9")
    raw = read_topic(spark, fmt="text", path=f"{src}/*", maxFilesPerTrigger=1)
    land_clickstream(raw, out, ckpt, available_now=True).awaitTermination()
    everything = ev.clean_clickstream(ev.parse_clicks(tv.json_lines(clicks)), processed_at=False)
    assert spark.read.parquet(out).count() == everything.count() > first
    assert _sorted(spark.read.parquet(out), cols) == _sorted(everything, cols)


def test_competitor_landing(spark, tmp_dir):
    quotes = tv.competitor_quotes(spark, SF_SMALL, with_key=True)
    src = f"{tmp_dir}/q"
    _write_lines(quotes, src, [F.lit(True)])
    raw = read_topic(spark, fmt="text", path=f"{src}/*")
    land_competitor_prices(raw, f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True) \
        .awaitTermination()
    landed = spark.read.parquet(f"{tmp_dir}/out")
    assert landed.columns == COMPETITOR_COLUMNS
    assert landed.filter(F.col("competitor_price").isNull()).count() == 0
    batch = ev.clean_competitor(ev.parse_quotes(tv.json_lines(quotes)), processed_at=False)
    cols = [c for c in COMPETITOR_COLUMNS if c != "processed_at"]
    assert _sorted(landed, cols) == _sorted(batch, cols)


GAP = "1 hour"
KEYS = ["window_start", "product_id", "demand_score", "competitor", "competitor_price", "availability",
        "pricing_action", "pair_count"]


def _events(folder, name, rows, order=None):
    """One file; ``order`` pins its time, by which the stream takes files."""
    import json
    import os
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.json"
    with open(path, "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows) + "\n")
    if order is not None:
        os.utime(path, (1.7e9 + order, 1.7e9 + order))


def _feed(tmp_dir, batch, hours, quotes_at=None):
    """Clicks and quotes of some hours, in event-time order over the batches;
    the quotes may stand at another place in their source's order."""
    types = ["view", "purchase", "remove_from_cart", None]
    _events(f"{tmp_dir}/c", f"b{batch}", [
        {"event_time": f"2024-01-01T{h:02d}:{m:02d}:00", "product_id": f"P{m % 3}", "event_type": types[(h + m) % 4]}
        for h in hours for m in range(0, 60, 7)], batch)
    _events(f"{tmp_dir}/q", f"b{batch}", [
        {"event_time": f"2024-01-01T{h:02d}:{m:02d}:30", "product_id": f"P{m % 4}", "competitor": f"S{m % 2}",
         "competitor_price": None if m % 5 == 0 else 1.5 * m, "availability": m % 2 == 0}
        for h in hours for m in range(0, 60, 9)], batch if quotes_at is None else quotes_at)


def _run(spark, tmp_dir, fail=False):
    rc = read_topic(spark, fmt="text", path=f"{tmp_dir}/c", maxFilesPerTrigger=1)
    rq = read_topic(spark, fmt="text", path=f"{tmp_dir}/q", maxFilesPerTrigger=1)
    if fail:  # a task of a later micro-batch dies
        rc = rc.withColumn("value", F.when(F.col("value").contains("T06:"), F.raise_error(F.lit("lost task")))
                           .otherwise(F.col("value")))
    query = land_realtime_pricing(rc, rq, f"{tmp_dir}/rt", max_gap=GAP, lateness="5 minutes", available_now=True)
    query.awaitTermination()
    return query


def _closed(spark, tmp_dir, last_hour):
    batch = ev.realtime_pricing(ev.parse_clicks(spark.read.text(f"{tmp_dir}/c")),
                                ev.parse_quotes(spark.read.text(f"{tmp_dir}/q")), max_gap=GAP)
    return _sorted(batch.filter(F.hour("window_start") < last_hour), KEYS)


def test_realtime_stream_equals_batch_and_restarts(spark, tmp_dir):
    import pytest
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for b in range(4):
            _feed(tmp_dir, b, [2 * b, 2 * b + 1])
        with pytest.raises(Exception, match="lost task"):  # the first batches are committed, the fourth is not
            _run(spark, tmp_dir, fail=True)
        _run(spark, tmp_dir)
        landed = _sorted(spark.read.parquet(f"{tmp_dir}/rt"), KEYS)
        assert landed == _closed(spark, tmp_dir, 7) and landed
        # more data under the same checkpoint only adds rows; nothing new adds nothing
        _feed(tmp_dir, 9, [9, 10])
        _run(spark, tmp_dir)
        more = _sorted(spark.read.parquet(f"{tmp_dir}/rt"), KEYS)
        assert more == _closed(spark, tmp_dir, 10) and len(more) > len(landed)
        _run(spark, tmp_dir)
        assert _sorted(spark.read.parquet(f"{tmp_dir}/rt"), KEYS) == more
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_sources_out_of_step_across_a_restart(spark, tmp_dir):
    """The quotes of the third and fourth batch change places, and the run
    dies in its last batch: the watermark stays behind, nothing is dropped,
    and the windows come out whole with the next events."""
    import pytest
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for b, q in enumerate([0, 1, 3, 2]):
            _feed(tmp_dir, b, [2 * b, 2 * b + 1], quotes_at=q)
        with pytest.raises(Exception, match="lost task"):
            _run(spark, tmp_dir, fail=True)
        _run(spark, tmp_dir)
        landed = _sorted(spark.read.parquet(f"{tmp_dir}/rt"), KEYS)
        first = set(_closed(spark, tmp_dir, 8))
        # Whole windows only, from the first on; the last ones may still wait.
        windows = spark.read.parquet(f"{tmp_dir}/rt").select("window_start").distinct().count()
        assert landed and set(landed) <= first
        assert landed == _closed(spark, tmp_dir, windows)
        for b in (4, 5):
            _feed(tmp_dir, b, [2 * b, 2 * b + 1])
        query = _run(spark, tmp_dir)
        assert _sorted(spark.read.parquet(f"{tmp_dir}/rt"), KEYS) == _closed(spark, tmp_dir, 11)
        assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_repeated_batch_writes_the_same_rows(spark, tmp_dir):
    """A micro-batch that is repeated after a failure replaces its folder."""
    import shutil
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for b in range(3):
            _feed(tmp_dir, b, [2 * b, 2 * b + 1])
        _run(spark, tmp_dir)
        want = _sorted(spark.read.parquet(f"{tmp_dir}/rt"), KEYS)
        commits = f"{tmp_dir}/rt.checkpoint/commits"
        import os
        last = max(int(f) for f in os.listdir(commits) if f.isdigit())
        os.replace(f"{commits}/{last}", f"{tmp_dir}/commit-{last}")  # as if the driver died before the commit
        crc = f"{commits}/.{last}.crc"
        if os.path.exists(crc):
            os.replace(crc, f"{tmp_dir}/crc-{last}")
        _run(spark, tmp_dir)
        assert _sorted(spark.read.parquet(f"{tmp_dir}/rt"), KEYS) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_realtime_state_stays_small(spark, tmp_dir):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for b in range(10):
            _feed(tmp_dir, b, [2 * b, 2 * b + 1])
        query = _run(spark, tmp_dir)
        totals = [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
        assert len(totals) >= 10 and max(totals[5:]) <= 1.2 * max(totals[:5])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_stream_join_needs_bounds(spark, tmp_dir):
    import pytest
    _feed(tmp_dir, 0, [0])
    raw = read_topic(spark, fmt="text", path=f"{tmp_dir}/c")
    with pytest.raises(ValueError, match="max_gap"):
        ev.realtime_pricing(ev.parse_clicks(raw), ev.parse_quotes(raw))


def test_interval_trigger(spark, tmp_dir):
    _feed(tmp_dir, 0, [0])
    query = land_clickstream(read_topic(spark, fmt="text", path=f"{tmp_dir}/c"), f"{tmp_dir}/out", trigger="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{tmp_dir}/out").count() > 0
    import os
    assert os.path.isdir(f"{tmp_dir}/out.checkpoint")


def test_event_time_offsets(spark):
    import datetime as dt
    rows = [("2024-01-01T10:00:00+02:00",), ("2024-01-01T10:00:00",), ("2024-01-01 10:00:00.5Z",), ("2024-01-01",),
            ("soon",), (None,)]
    df = spark.createDataFrame(rows, "event_time string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r[0] for r in ev.with_event_timestamp(df).selectExpr("unix_millis(event_timestamp)").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    day = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()) * 1000
    assert got == [day + 8 * 3600_000, day + 10 * 3600_000, day + 36000_500, day, None, None]


def test_realtime_pairs_across_window_borders(spark, tmp_dir):
    import collections
    import datetime as dt
    import glob
    import os
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for b in range(3):
            _feed(tmp_dir, b, [2 * b, 2 * b + 1])
        _events(f"{tmp_dir}/c", "b0x", [{"event_time": "2024-01-01T02:59:00", "product_id": "X", "event_type": "view"},
                                        {"event_time": "2024-01-01T02:30:00", "product_id": "Y", "event_type": "view"}])
        _events(f"{tmp_dir}/q", "b0x", [
            {"event_time": f"2024-01-01T{t}", "product_id": p, "competitor": "S", "competitor_price": 2.0, "availability": True}
            for p, t in (("X", "03:01:00"), ("Y", "03:30:00"), ("Y", "03:30:01"), ("Y", "01:30:00"), ("Y", "01:29:59"))])
        for folder in "cq":  # files are read in the order of their times: b0, b0x, b1, b2
            for i, path in enumerate(sorted(glob.glob(f"{tmp_dir}/{folder}/*.json"))):
                os.utime(path, (1.7e9 + i, 1.7e9 + i))
        _run(spark, tmp_dir)
        clicks = ev.realtime_clicks(ev.with_event_timestamp(ev.parse_clicks(spark.read.text(f"{tmp_dir}/c")))).collect()
        quotes = ev.realtime_quotes(ev.with_event_timestamp(ev.parse_quotes(spark.read.text(f"{tmp_dir}/q")))).collect()
        want = collections.Counter()
        for c in clicks:
            for q in quotes:
                late = max(c["event_timestamp"], q["event_timestamp"])
                if c["product_id"] == q["product_id"] and late.hour < 5 \
                        and abs(c["event_timestamp"] - q["event_timestamp"]) <= dt.timedelta(hours=1):
                    want[late.replace(minute=0, second=0), c["product_id"], c["demand_score"], q["competitor"],
                         q["competitor_price"], q["availability"]] += 1
        landed = spark.read.parquet(f"{tmp_dir}/rt").select(*KEYS).collect()
        assert {tuple(r)[:6]: r["pair_count"] for r in landed} == want and len(landed) == len(want)
        assert sum(r["pair_count"] for r in landed if r["product_id"] == "X") == 1
        assert sum(r["pair_count"] for r in landed if r["product_id"] == "Y") == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
