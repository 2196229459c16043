from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import new_dir, reading, write_lines
from nimbus.operators.summary import Metric
from nimbus.streaming import dedup_stream, drain, hourly_stream, ingest_stream, read_latest, run_to_table


def _land(root, hour, rows, name):
    write_lines(Path(root) / f"year=2024/month=3/day=31/hour={hour}" / name, rows)


def test_ingest_rewrites_whole_touched_hours(spark):
    raw, out, ck = new_dir(), new_dir(), new_dir()
    _land(raw, 15, [reading(), reading(city="Buffalo")], "a.json")
    _land(raw, 16, [reading(city="Albany")], "a.json")
    drain(ingest_stream(spark, raw, out, ck, processed_at="p"))
    assert spark.read.parquet(out).count() == 3
    # a late file for hour 15 plus an invalid row: the hour is rebuilt from
    # everything landed for it, not from the new file alone
    _land(raw, 15, [reading(city="Trenton"), reading(city="Bad", temp_f=999.0)], "b.json")
    bad = new_dir()
    with pytest.raises(Exception, match="no quarantine_root"):
        drain(ingest_stream(spark, raw, out, ck, processed_at="p"))
    drain(ingest_stream(spark, raw, out, ck, processed_at="p", quarantine_root=bad))
    rejected = spark.read.json(bad).collect()
    assert [(r.city, r.reject_reasons) for r in rejected] == [("Bad", ["range:temp_f"])]
    got = spark.read.parquet(out)
    assert sorted(r.city for r in got.filter("hour = 15").collect()) == \
        ["Buffalo", "New York City", "Trenton"]
    assert got.filter("hour = 16").count() == 1
    # nothing new: no batch, output unchanged
    drain(ingest_stream(spark, raw, out, ck, processed_at="p", quarantine_root=bad))
    assert spark.read.parquet(out).count() == 4


def _events_stream(spark, sf_dir="/root/testdata/sf0.001"):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .parquet(sf_dir))


def test_hourly_stream_matches_batch(spark):
    out, ck = new_dir(), new_dir()
    s = hourly_stream(_events_stream(spark), ["user_id"], "ts",
                      [Metric("max_value", "max", "value")], label="event_type",
                      watermark="2 hours")
    drain(run_to_table(s, out, ck, mode="update"))
    got = read_latest(spark, out, ["window_start", "user_id"])
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    batch = ev.groupBy(F.date_trunc("hour", "ts").alias("h"), "user_id").agg(
        F.max("value").alias("m"), F.count(F.lit(1)).alias("n"))
    assert got.count() == batch.count()
    j = got.join(batch, (got.window_start == batch.h.cast("timestamp")) &
                 (got.user_id == batch.user_id))
    assert j.filter((F.col("max_value") != F.col("m")) | (F.col("reading_count") != F.col("n"))) \
        .count() == 0


def test_dedup_stream_drops_repeats(spark):
    src = new_dir()
    rows = [{"k": 1, "ts": "2024-01-01 00:00:00", "v": 1}, {"k": 1, "ts": "2024-01-01 00:00:00", "v": 2},
            {"k": 2, "ts": "2024-01-01 00:05:00", "v": 3}]
    write_lines(Path(src) / "a.json", rows)
    s = spark.readStream.schema("k int, ts timestamp, v int").json(src)
    out, ck = new_dir(), new_dir()
    drain(run_to_table(dedup_stream(s, ["k", "ts"], "ts", "1 hour"), out, ck))
    got = spark.read.parquet(out)
    assert got.count() == 2


def test_watermark_late_rows_across_batches(spark):
    src, out, ck = new_dir(), new_dir(), new_dir()
    first = [{"user_id": 1, "ts": f"2024-01-01 {h:02d}:10:00", "value": float(h), "event_type": "a"}
             for h in (10, 11, 12)]
    write_lines(Path(src) / "1.json", first)
    schema = "user_id long, ts timestamp, value double, event_type string"
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
    hs = hourly_stream(s, ["user_id"], "ts", [Metric("max_value", "max", "value")],
                       label="event_type", watermark="2 hours")
    q = run_to_table(hs, out, ck, mode="update", available_now=False)
    q.processAllAvailable()
    # batch 2: 10:40 is inside the watermark (12:10 - 2h = 10:10) -> updates 10:00;
    # 09:50 is older than the watermark -> dropped
    write_lines(Path(src) / "2.json", [
        {"user_id": 1, "ts": "2024-01-01 10:40:00", "value": 99.0, "event_type": "b"},
        {"user_id": 1, "ts": "2024-01-01 10:45:00", "value": 1.0, "event_type": "b"},
        {"user_id": 1, "ts": "2024-01-01 09:50:00", "value": 50.0, "event_type": "a"}])
    q.processAllAvailable()
    q.stop()
    got = {r.window_start.hour: (r.max_value, r.dominant, r.reading_count)
           for r in read_latest(spark, out, ["window_start", "user_id"]).collect()}
    assert got[10] == (99.0, "b", 3)
    assert 9 not in got
    assert got[12] == (12.0, "a", 1)


def test_dedup_across_batches(spark):
    src, out, ck = new_dir(), new_dir(), new_dir()
    row = {"k": 1, "ts": "2024-01-01 00:00:00", "v": 1}
    write_lines(Path(src) / "1.json", [row])
    s = spark.readStream.schema("k int, ts timestamp, v int").option("maxFilesPerTrigger", 1) \
        .json(src)
    q = run_to_table(dedup_stream(s, ["k", "ts"], "ts", "1 hour"), out, ck, available_now=False)
    q.processAllAvailable()
    write_lines(Path(src) / "2.json", [dict(row, v=2), {"k": 2, "ts": "2024-01-01 00:01:00", "v": 3}])
    q.processAllAvailable()
    q.stop()
    got = sorted((r.k, r.v) for r in spark.read.parquet(out).collect())
    assert got == [(1, 1), (2, 3)]


def test_ingest_keeps_summary_current(spark):
    from nimbus.plans.marts import stg_weather_raw, weather_hourly_summary
    raw, out, summ, ck = new_dir(), new_dir(), new_dir(), new_dir()
    _land(raw, 15, [reading(city="A", observed_at="2024-03-31T15:05:00+00:00", temp_f=50.0)], "a.json")
    drain(ingest_stream(spark, raw, out, ck, processed_at="p", summary_root=summ))
    # late reading for 15:00 lands with hour 16, plus a reading for 16:00
    _land(raw, 16, [reading(city="A", observed_at="2024-03-31T15:40:00+00:00", temp_f=54.0),
                    reading(city="A", observed_at="2024-03-31T16:05:00+00:00", temp_f=60.0)],
          "a.json")
    drain(ingest_stream(spark, raw, out, ck, processed_at="p", summary_root=summ))
    got = {r.observed_hour.hour: (r.avg_temp_f, r.reading_count)
           for r in spark.read.parquet(summ).collect()}
    assert got == {15: (52.0, 2), 16: (60.0, 1)}
    full = weather_hourly_summary(stg_weather_raw(spark.read.parquet(out)))
    assert full.count() == 2
