"""Quantiles of hot keys, ties by join, late rows and closed windows, layers
and marts that switch together."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import new_dir, reading, write_lines
from nimbus.operators.enrich import enrich
from nimbus.operators.latest import latest_per_key
from nimbus.operators.quality import MartChecks
from nimbus.operators.quantiles import exact_quantiles
from nimbus.operators.summary import Metric
from nimbus.plans import layers, marts
from nimbus.schemas import PROCESSED, READING
from nimbus.sources.sinks import register_table, write_partitions
from nimbus.streaming import LateRows, dedup_stream, dedup_to_table, deduplicated, drain, hourly_stream_closed, run_to_table

PROBS, NAMES = (0.0, 0.25, 0.5, 0.75, 1.0), ("a", "b", "c", "d", "e")


@pytest.mark.parametrize("hot", [0, 40, 10_000])
def test_quantiles_are_exact_in_pieces_too(spark, hot):
    rng = random.Random(hot)
    rows = [("hot", rng.choice([rng.random(), 0.5])) for _ in range(900)] + [(k, rng.randint(0, 9) / 4) for k in ("x", "y", None) for _ in range(30)]
    rows += [("one", 2.0), ("nulls", None), ("x", None), ("hot", None)]
    got = {r.k: r for r in exact_quantiles(spark.createDataFrame(rows, "k string, v double"), "k", "v", PROBS, NAMES, hot_rows=hot).collect()}
    for k in {k for k, _ in rows}:
        v = [x for y, x in rows if y == k and x is not None]
        want = np.quantile(v, PROBS) if v else [None] * 5
        assert k in got and all((a is None) == (b is None) and (a is None or abs(a - b) < 1e-12) for a, b in zip(got[k][1:], want, strict=True)), k


def test_a_hot_key_runs_in_even_pieces(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.rand(3).alias("v"))
    from nimbus.operators.quantiles import _in_pieces
    counted = df.groupBy("k", "v").agg(F.count("v").alias("_n")).withColumnRenamed("v", "_v")
    sizes = [r["count"] for r in _in_pieces(counted, "k", 4).groupBy(F.floor((F.col("_to") - 1) / 5000)).count().collect()]
    assert sizes == [5000] * 4


def test_ties_with_nulls(spark):
    rows = [(1, None, "a"), (1, None, "b"), (2, 5, "a"), (2, 5, "b"), (2, 4, "c"), (2, None, "d"), (None, 1, "a"), (None, 1, "b"), (None, 0, "c")]
    got = latest_per_key(spark.createDataFrame(rows, "k int, t int, v string"), "k", "t", keep_ties=True)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([r for r in rows if r[2] in "ab"], key=repr)
    with pytest.raises(ValueError):
        latest_per_key(got, "k", [F.col("t").desc()], keep_ties=True)


# ---------------------------------------------------------------- streams

def _land(src, name, rows):
    write_lines(Path(src) / name, [{"k": k, "ts": f"2024-01-0{d} {h:02d}:00:00", "v": v} for k, d, h, v in rows])


def test_copies_in_different_triggers_and_late_rows(spark):
    src, out, ck = new_dir(), new_dir(), new_dir()
    schema = spark.createDataFrame([], "k int, ts timestamp, v int").schema


    _land(src, "a.json", [(1, 1, 10, 1), (1, 1, 10, 1), (2, 1, 10, 2), (None, 1, 10, 9)])
    drain(dedup_to_table(spark.readStream.schema(schema).json(src), ["k", "ts"], "ts", out, ck, watermark_hours=6))
    accepted, late = (side.collect() for side in deduplicated(spark, out, schema))
    assert sorted(((r.k, r.v) for r in accepted), key=repr) == [(1, 1), (2, 2), (None, 9)] and late == []
    _land(src, "b.json", [(1, 1, 10, 1), (3, 1, 5, 3), (None, 1, 10, 9), (4, 2, 12, 4)])   # a copy, an early one within the watermark
    drain(dedup_to_table(spark.readStream.schema(schema).json(src), ["k", "ts"], "ts", out, ck, watermark_hours=6))
    _land(src, "c.json", [(5, 1, 9, 5), (2, 1, 10, 2), (4, 2, 12, 4), (6, 2, 7, 6)])       # late, a late copy, a copy, new
    drain(dedup_to_table(spark.readStream.schema(schema).json(src), ["k", "ts"], "ts", out, ck, watermark_hours=6))
    accepted, late = (side.collect() for side in deduplicated(spark, out, schema))
    assert sorted(((r.k, r.v) for r in accepted), key=repr) == [(1, 1), (2, 2), (3, 3), (4, 4), (6, 6), (None, 9)]
    assert sorted((r.k, r.v) for r in late) == [(2, 2), (5, 5)]


def test_late_rows_of_all_triggers_are_counted(spark):
    src, out, ck = new_dir(), new_dir(), new_dir()
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        for i, rows in enumerate(([(1, 3, 10, 1)], [(2, 1, 1, 2), (3, 1, 1, 3)], [(4, 1, 1, 4)])):
            _land(src, f"{i}.json", rows)
            q = run_to_table(dedup_stream(spark.readStream.schema("k int, ts timestamp, v int").json(src), ["k"], "ts"), out, ck)
            drain(q)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        end = dt.datetime.now() + dt.timedelta(seconds=20)
        while sum(listener.by_query.values()) < 3 and dt.datetime.now() < end:
            pass
        assert sum(listener.by_query.values()) == 3
    finally:
        spark.streams.removeListener(listener)


def test_closed_windows_hold_no_map_of_labels(spark):
    src, out, ck = new_dir(), new_dir(), new_dir()
    rng = random.Random(1)
    rows = [(k, f"2024-01-01 {h:02d}:{rng.randrange(60):02d}:00", rng.choice(["b", "a", "c", None]), rng.choice([None, 1.5, 2.0, 4.25])) for h in range(5) for k in (1, 2) for _ in range(9)]
    rows += [(3, "2024-01-01 01:00:00", None, None), (1, "2024-01-01 09:00:00", "a", 1.0)]
    schema = "k int, ts timestamp, label string, v double"
    for i in range(3):  # in three landings
        write_lines(Path(src) / f"{i}.json", [dict(zip(("k", "ts", "label", "v"), r, strict=True)) for r in rows[:-1][i::3] + (rows[-1:] if i == 2 else [])])
    metrics = [Metric("lo", "min", "v"), Metric("hi", "max", "v"), Metric("total", "sum", "v"), Metric("n", "count", "v"), Metric("mean", "avg", "v", 2)]
    s = hourly_stream_closed(spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).json(src), ["k"], "ts", metrics, "label", watermark="1 hours")
    drain(run_to_table(s, out, ck))
    write_lines(Path(src) / "end.json", [{"k": 1, "ts": "2024-01-01 12:00:00", "label": "a", "v": 1.0}])
    drain(run_to_table(hourly_stream_closed(spark.readStream.schema(schema).json(src), ["k"], "ts", metrics, "label", watermark="1 hours"), out, ck))
    got = {(r.window_start.hour, r.k): (r.lo, r.hi, r.total, r.n, r.mean, r.dominant, r.reading_count) for r in spark.read.parquet(out).collect()}
    for h, k in {(int(r[1][11:13]), r[0]) for r in rows}:
        own = [r for r in rows if (int(r[1][11:13]), r[0]) == (h, k)]
        v, labels = [r[3] for r in own if r[3] is not None], [r[2] for r in own if r[2]]
        best = min(set(labels), key=lambda x: (-labels.count(x), x)) if labels else None
        want = (min(v, default=None), max(v, default=None), sum(v) if v else None, len(v), round(sum(v) / len(v) + 1e-9, 2) if v else None, best, len(own))
        assert got[h, k][:4] + got[h, k][5:] == want[:4] + want[5:] and (want[4] is None) == (got[h, k][4] is None) and abs((want[4] or 0) - (got[h, k][4] or 0)) <= 0.01


# ---------------------------------------------------------------- layers

def _zone(spark, rows, name):
    root = new_dir()
    out = enrich(spark.createDataFrame([reading(**r) for r in rows], READING), run_hour="2024-03-31T15", processed_at="p")
    write_partitions(out.select(*PROCESSED.fieldNames()), root)
    register_table(spark, name, root, PROCESSED)
    return root


def test_layers_counts_and_report(spark):
    root = _zone(spark, [{}, dict(city="A", humidity_pct=101), dict(city="B", temp_f=None), dict(city="B", state="TX", observed_at="2024-03-31T15:50:00+00:00")], "layers_zone")
    counts, report = layers.refresh_layers(spark, "layers_zone", ["NY"], ["NY", "NJ"], "layers_staging", "layers_marts", min_cities=5, as_of="2024-03-31 16:00:30")
    assert counts == {"weather_current": 4, "weather_hourly_summary": 4}
    got = {(r.suite, r.test, r.column_name): r.failures for r in report.collect()}
    assert got["staging", "accepted_range", "humidity_pct"] == 1 and got["staging", "not_null", "temp_f"] == 1 and got["rows", "state_in_region", None] == 1
    assert got["current", "unique", "city_name"] == 1 and got["current", "not_null", "temp_f"] == 1 and got["summary", "not_null", "avg_temp_f"] == 1
    assert got["coverage", "missing_states", "state_code"] == 1 and got["coverage", "unexpected_states", "state_code"] == 1 and got["coverage", "too_few_cities", "city_name"] == 2
    assert got["freshness", "lag_minutes", "observed_at"] == 10 and got["coverage", "duplicate_slugs", None] == 0
    other = spark.newSession()
    assert other.table("layers_staging.stg_weather_raw").count() == 4 and other.table("layers_marts.weather_current").count() == 4
    write_partitions(enrich(spark.createDataFrame([reading(city="New")], READING), run_hour="2024-03-31T16", processed_at="p").select(*PROCESSED.fieldNames()), root)
    spark.sql("ALTER TABLE layers_zone RECOVER PARTITIONS")
    assert spark.table("layers_staging.stg_weather_raw").count() == 5  # a view: the zone as it is
    counts, _ = layers.refresh_layers(spark, "layers_zone", ["NY"], None, "layers_staging", "layers_marts")
    assert counts["weather_current"] == 5 and layers.current_mart(spark, "layers_marts", "weather_current").count() == 5


def test_marts_switch_together(spark):
    frame = lambda n, **more: spark.range(n).select(F.col("id"), *[F.lit(v).alias(k) for k, v in more.items()])
    seen = lambda s=spark: tuple(layers.current_mart(s, "switching", n).count() for n in ("a", "b", "c"))
    assert layers.refresh_together(spark, "switching", {n: frame(2) for n in "abc"}) == {"a": 2, "b": 2, "c": 2}
    version, counts = layers.write_version(spark, "switching", {n: frame(5) for n in "abc"})
    assert seen() == (2, 2, 2) and counts["b"] == 5
    # A refresh that dies is written over by the next.
    version2, _ = layers.write_version(spark, "switching", {"a": frame(3), "b": frame(0), "c": frame(4, note="x")})
    assert version2 == version and seen() == (2, 2, 2)
    layers.show_version(spark, "switching", version, {"a": ["id"], "b": ["id"], "c": ["id", "note"]})
    assert seen() == (3, 0, 4) and seen(spark.newSession()) == (3, 0, 4)
    assert layers.current_mart(spark, "switching", "c").columns == ["id", "note"]
    for n in range(3):
        layers.refresh_together(spark, "switching", {"a": frame(n)})
    assert [r[0] for r in spark.sql("SHOW PARTITIONS switching.a_rows").collect()] == ["_version=4", "_version=5"]


def test_checks_of_an_empty_zone(spark):
    stg = marts.stg_weather_raw(spark.createDataFrame([], PROCESSED))
    checks = MartChecks(["NY"], ["NY"], 1)
    checks.current(marts.weather_current(checks.staging(stg))).write.mode("overwrite").parquet(d := new_dir())
    got = {(r.suite, r.test): r.failures for r in checks.report(spark.read.schema(marts.weather_current(stg).schema).parquet(d)).collect()}
    assert got["coverage", "missing_states"] == 1 and got["freshness", "lag_minutes"] is None and got["rows", "humidity_range"] == 0
