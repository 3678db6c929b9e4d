"""Dated landings, compaction and the report of what streams drop."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from shelfwise.streaming import compaction
from shelfwise.streaming.jobs import land_clickstream, land_realtime_pricing, read_topic
from shelfwise.streaming.progress import StreamReport


def _clicks(folder, name, n, day, hour=10):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.txt", "w") as fh:
        for i in range(n):
            at = "soon" if i == 0 else f"2024-01-{day + i % 2:02d}T{hour:02d}:{i % 60:02d}:00"
            fh.write(json.dumps({"event_time": at, "product_id": f"P{i % 5}", "event_type": "view"}) + "\n")
    os.utime(f"{folder}/{name}.txt", (1.7e9 + len(os.listdir(folder)),) * 2)


def _all(df):
    return sorted(repr(tuple(r)) for r in df.select("event_time", "product_id", "event_date", "processed_at").collect())


@pytest.mark.parametrize("rejected", [False, True])
def test_compaction_keeps_every_row_once(spark, tmp_dir, rejected):
    src, out, target = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/packed"
    more = {"rejected": f"{tmp_dir}/bad"} if rejected else {}

    def land():
        raw = read_topic(spark, fmt="text", path=src, maxFilesPerTrigger=1)
        land_clickstream(raw, out, dated=True, available_now=True, **more).awaitTermination()

    for b in range(6):
        _clicks(src, f"a{b}", 40, 3)
    land()
    landed = spark.read.parquet(out)
    assert "event_date" in landed.columns and landed.count() == 240
    running = landed.select("event_time")  # a reader that has listed its files
    assert compaction.compact(spark, out, target) == 240
    assert running.count() == 240
    files = glob.glob(f"{target}/events/cut=*/event_date=2024-01-03/part-*")
    assert len(files) == 1 < len(glob.glob(f"{out}/**/part-*", recursive=True)) / 6
    assert _all(compaction.read_landed(spark, out, target)) == _all(spark.read.parquet(out))
    assert compaction.compact(spark, out, target) == 0  # nothing new
    for b in range(3):  # later files, with events of an old date too
        _clicks(src, f"b{b}", 30, 2)
    land()
    assert _all(compaction.read_landed(spark, out, target)) == _all(spark.read.parquet(out))
    # a run that died after its files and before its cut
    cuts = spark.read.parquet(f"{target}/cuts").collect()
    assert compaction.compact(spark, out, target) == 90
    spark.createDataFrame(cuts).coalesce(1).write.mode("overwrite").parquet(f"{tmp_dir}/old-cuts")
    os.rename(f"{target}/cuts", f"{tmp_dir}/lost-cuts")
    os.rename(f"{tmp_dir}/old-cuts", f"{target}/cuts")
    assert _all(compaction.read_landed(spark, out, target)) == _all(spark.read.parquet(out))
    _clicks(src, "c", 20, 4)
    land()
    assert compaction.compact(spark, out, target) == 110
    got = compaction.read_landed(spark, out, target)
    assert _all(got) == _all(spark.read.parquet(out)) and got.count() == 350
    assert len(glob.glob(f"{target}/cuts/part-*")) == 2


def test_compacted_dates_are_pruned(spark, tmp_dir):
    import io
    from contextlib import redirect_stdout
    src, out, target = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/packed"
    _clicks(src, "a", 40, 3)
    land_clickstream(read_topic(spark, fmt="text", path=src), out, dated=True, available_now=True).awaitTermination()
    compaction.compact(spark, out, target)
    df = compaction.read_landed(spark, out, target).where("event_date = date'2024-01-03'")
    with redirect_stdout(io.StringIO()) as text:
        df.explain("formatted")
    assert df.count() == 19 and text.getvalue().count("(event_date") >= 2 and "PartitionFilters: [" in text.getvalue()


def test_late_events_are_counted(spark, tmp_dir):
    """Two late clicks are dropped and reported; the events in time are not.
    (Lateness is judged by the watermark that the batch before worked with.)"""
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    report = StreamReport()
    spark.streams.addListener(report)
    try:
        for folder, extra in (("c", {"event_type": "view"}), ("q", {"competitor": "S", "competitor_price": 2.0, "availability": True})):
            os.makedirs(f"{tmp_dir}/{folder}")
            for i, times in enumerate((
                    ["10:00", "10:30"], ["15:00"], ["16:00"], ["17:00", "10:10", "10:11"] if folder == "c" else ["17:00"], ["20:00"])):
                path = f"{tmp_dir}/{folder}/{i}.txt"
                with open(path, "w") as fh:
                    fh.writelines(json.dumps({"event_time": f"2024-01-01T{t}:00", "product_id": "P", **extra}) + "\n" for t in times)
                os.utime(path, (1.7e9 + i,) * 2)
        streams = [read_topic(spark, fmt="text", path=f"{tmp_dir}/{f}", maxFilesPerTrigger=1) for f in "cq"]
        query = land_realtime_pricing(*streams, f"{tmp_dir}/rt", max_gap="1 hour", lateness="5 minutes", available_now=True,
                                      query_name="pricing")
        query.awaitTermination()
        from time import sleep
        for _ in range(50):  # events reach listeners a little later
            rows = report.rows(spark).where("name = 'pricing'").collect()
            if rows and rows[0]["input_rows"] == 14 and rows[0]["watermark"] > "2024-01-01T19":
                break
            sleep(0.2)
        got = rows[0]
        assert got["late_rows"] == 4 and got["input_rows"] == 14  # each late click was due in two windows
        assert got["watermark"].startswith("2024-01-01T19:55") and len(got["offsets"]) == 2 and got["batches"] >= 4
        assert spark.read.parquet(f"{tmp_dir}/rt").agg(F.sum("pair_count")).first()[0] == 4 + 1 + 3 + 3
    finally:
        spark.streams.removeListener(report)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
