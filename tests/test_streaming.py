"""Stream results against the same rows read as a batch."""

import pytest
from pyspark.sql import functions as F

from tallyframe.streaming import jobs as J

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{FOLDER}/events.parquet")


def batch_report(events):
    g = events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return {(str(r["day"]), r["event_type"]): r["n"] for r in g.collect()}


def test_append_mode_emits_closed_windows_once(spark, events):
    s = J.window_report(J.file_stream(spark, FOLDER, "events"), "ts", "value", "event_type")
    rows = J.run_to_end(s, "append-report", "append").collect()
    want = batch_report(events)
    got = {(str(r["start"].date()), r["event_type"]): r["n"] for r in rows}
    assert len(got) == len(rows) and all(want[k] == n for k, n in got.items())


def test_late_rows_are_dropped(spark, tmp_path):
    import datetime as dt

    at = lambda d, h: dt.datetime(2024, 1, d, h)
    write = lambda rows, i: spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, value double").coalesce(1).write.parquet(str(tmp_path / f"in/p{i}"))
    write([(at(1, 1), "a", 1.0), (at(3, 1), "a", 1.0)], 0)
    write([(at(5, 1), "a", 1.0)], 1)
    # rows are judged by the watermark of the batch before theirs: by now 3 January has passed
    write([(at(1, 2), "a", 9.0), (at(9, 1), "a", 1.0)], 2)
    write([(at(12, 1), "a", 1.0)], 3)
    schema = spark.read.parquet(str(tmp_path / "in/p0")).schema
    import os
    import shutil

    os.makedirs(tmp_path / "flat")
    for i in range(4):
        src = [f for f in os.listdir(tmp_path / f"in/p{i}") if f.endswith(".parquet")][0]
        shutil.copy(tmp_path / f"in/p{i}/{src}", tmp_path / f"flat/{i}.parquet")
        os.utime(tmp_path / f"flat/{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "flat"))
    rows = J.run_to_end(J.window_report(stream, "ts", "value", "event_type"), "late", "append").collect()
    first = [r for r in rows if r["start"].day == 1]
    assert [(r["n"], r["total"]) for r in first] == [(1, 1.0)]


def test_drift_report_of_the_reference_itself(spark, events):
    lo, hi, shares = J.reference_bins(events, "value")
    assert sum(shares) == pytest.approx(1, abs=1e-4)
    counts = events.select(F.lit(0).alias("start"), J.bin_of(F.col("value"), lo, hi, 10).alias("b")).groupBy("start", "b").agg(
        F.count(F.lit(1)).alias("n"))
    r = J.drift_report(counts, shares).first()
    assert r["psi"] == pytest.approx(0, abs=1e-9) and r["status"] == "stable"


def test_folder_table_in_batches_and_resumed(spark, events, tmp_path):
    folder, at = str(tmp_path), str(tmp_path / "job")
    events.where("event_id % 2 = 0").repartition(3).write.parquet(f"{folder}/events.parquet")
    run = lambda: J.run_to_end(J.window_report(J.file_stream(spark, folder, "events", files_per_batch=1), "ts", "value", "event_type", late="1000 days"),
                               "resumed", "complete", at=at)
    half = run().agg(F.sum("n")).first()[0]
    assert half == events.where("event_id % 2 = 0").count()
    events.where("event_id % 2 = 1").repartition(2).write.mode("append").parquet(f"{folder}/events.parquet")
    got = {(str(r["start"].date()), r["event_type"]): r["n"] for r in run().collect()}
    assert got == batch_report(events)


def test_no_input_gives_an_empty_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(str(tmp_path / "in"))
    assert J.run_to_end(J.window_report(stream, "ts", "value", "event_type"), "none", "complete").count() == 0
