"""Readers that lose nothing, the observed-hour index, atomic replacement and
catalog reconciliation."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import GOLDEN, new_dir, reading, write_lines
from nimbus.operators.enrich import enrich
from nimbus.operators.flatten import flatten_payload, to_landed
from nimbus.operators.validate import MALFORMED, REASONS
from nimbus.plans import dashboard, jobs, marts
from nimbus.schemas import PARTITION_COLS, PROCESSED, READING
from nimbus.sources import sinks, zone
from nimbus.sources.keyed import collect_keyed, payload_readings
from nimbus.sources.processed import processed_rejects, read_processed
from nimbus.sources.raw import read_mixed_json, read_payload, read_raw
from nimbus.sources.tolerant import CORRUPT, json_records, type_records


def processed(spark, rows, hour, **over):
    out = enrich(spark.createDataFrame([reading(**r) for r in rows], READING), run_hour=f"2024-03-31T{hour:02d}", processed_at="p")
    return out.withColumns({k: F.lit(v) for k, v in over.items()}).select(*PROCESSED.fieldNames())


# ---------------------------------------------------------------- readers

def test_every_leaf_is_typed_and_named(spark):
    d = new_dir()
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("s", T.StructType([T.StructField("1h", T.DoubleType()), T.StructField("l", T.ArrayType(T.IntegerType()))])),
                           T.StructField("r", T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])))])
    write_lines(Path(d) / "x.json", ['{"a": 45.0, "s": {"1h": "2.5", "l": [1, 2.0, "3"]}, "r": [{"id": 9007199254740993, "t": 7}]}',
                                     '{"a": 45.5, "s": {"1h": "x", "l": [1, 2.5, "y"]}, "r": [{"id": 1}, {"id": 1.5}, {"id": "z"}]}',
                                     '{"a": null, "s": null, "r": []}', '{"a": true}', '{"a": 1, "s": 5}', '[{"a": 1}, {"a": 2}]', '{"a": 1', "oops", "", "  "])
    got = type_records(json_records(spark.read, schema).json(d), schema).collect()
    said = sorted((r.a, r[MALFORMED]) for r in got if r[CORRUPT] is None and r.a is not None)
    assert said == [(1, ""), (2, ""), (45, "")]
    whole = next(r for r in got if r.a == 45)
    assert whole.s["1h"] == 2.5 and whole.s.l == [1, 2, 3] and whole.r[0].id == 9007199254740993 and whole.r[0].t == "7"
    bad = sorted(r[MALFORMED] for r in got if r[MALFORMED] and r[CORRUPT] is None)
    assert bad == ["a", "a,s.1h,s.l[],r[].id"]
    assert sorted(r[CORRUPT] for r in got if r[CORRUPT] is not None) == ['oops', '{"a": 1', '{"a": 1, "s": 5}']
    assert all("corrupt_record" in r[MALFORMED] for r in got if r[CORRUPT] is not None)


def test_integer_fields_written_as_decimals(spark):
    d = new_dir()
    write_lines(Path(d) / "p.json", [{**GOLDEN, "main": {**GOLDEN["main"], "humidity": h, "pressure": "1013"}} for h in (45.0, 45.5, "45")])
    got = sorted((r.humidity_pct or 0, r.pressure_hpa, r[MALFORMED]) for r in flatten_payload(read_payload(spark, d), "name", "base").collect())
    assert got == [(0, 1013, "main.humidity"), (45, 1013, ""), (45, 1013, "")]
    write_lines(Path(d) / "m/x.json", [[reading(humidity_pct=45.0), reading(humidity_pct=45.5)], '{"city": "bro'])
    rows = read_mixed_json(spark, f"{d}/m", READING).collect()
    assert sorted((r.humidity_pct or 0, r[MALFORMED], r[CORRUPT]) for r in rows) == [(0, "corrupt_record", '{"city": "bro'), (0, "humidity_pct", None), (45, "", None)]


def test_answer_that_does_not_fit_reaches_quarantine(spark):
    def transport(key):
        return {**GOLDEN, "clouds": {"all": 45.5}} if key["name"] == "Odd" else {**GOLDEN, "main": {**GOLDEN["main"], "humidity": 65.0}}

    cities = [("Odd", "NY", 1.0, 2.0), ("Even", "NY", 1.0, 2.0)]
    raw, out, bad = new_dir(), new_dir(), new_dir()
    jobs.fetch_to_raw(spark, transport, raw, "2024-03-31T15", cities=cities)
    res = jobs.process_hour(spark, raw, out, "2024-03-31T15", quarantine_root=bad, processed_at="p")
    assert (res.valid, res.invalid) == (1, 1)
    assert [r.city for r in read_processed(spark, out).collect()] == ["Even"]
    assert spark.read.json(bad).first()[REASONS] == ["malformed:clouds.all"]
    kept = [json.loads(r.value) for r in spark.read.text(raw).collect()]
    assert [json.loads(r["_document"])["clouds"]["all"] for r in kept if r["city"] == "Odd"] == [45.5]
    assert all("_document" not in r for r in kept if r["city"] == "Even")
    keys = spark.createDataFrame(cities, "name string, state string, lat double, lon double")
    flat = {r.city: r for r in payload_readings(collect_keyed(keys, transport)).collect()}
    assert flat["Odd"][MALFORMED] == "clouds.all" and flat["Even"].humidity_pct == 65 and flat["Even"][CORRUPT] is None
    assert to_landed(spark.createDataFrame([reading()], READING)).columns == READING.fieldNames()


def test_files_of_different_types_are_read_together(spark):
    d = new_dir()
    base = processed(spark, [{}], 15)
    for h, c in ((1, F.lit(45).cast("long")), (2, F.lit(45.0)), (3, F.lit(45.5)), (4, F.lit("45")), (5, F.lit("no")), (6, F.lit(45))):
        (base.withColumn("humidity_pct", c).withColumn("hour", F.lit(h)).withColumn("note", F.lit(h) if h % 2 else F.lit("x"))
         .write.mode("append").partitionBy(*PARTITION_COLS).parquet(d))
    with pytest.raises(Exception, match="(?i)parquet|convert"):
        read_processed(spark, d).collect()
    got = read_processed(spark, d, reconcile=True)
    assert got.schema.fieldNames() == PROCESSED.fieldNames() and got.schema["humidity_pct"].dataType == T.IntegerType()
    assert sorted((r.hour, r.humidity_pct) for r in got.collect()) == [(1, 45), (2, 45), (4, 45), (6, 45)]
    assert sorted((r.hour, r[MALFORMED]) for r in processed_rejects(spark, d, fmt="parquet").collect()) == [(3, "humidity_pct"), (5, "humidity_pct")]
    merged = {r.hour: r.note for r in read_processed(spark, d, reconcile=True, merge_schema=True).collect()}
    assert merged == {1: "1", 2: "x", 4: "x", 6: "x"}
    assert read_processed(spark, f"{d}/none", reconcile=True).count() == 0
    name = "zone_types"
    sinks.register_table(spark, name, d, PROCESSED)
    assert sorted((r.found, r.files) for r in sinks.type_conflicts(spark, name).collect()) == [("bigint", 1), ("double", 2), ("string", 2)]


def test_broken_lines_of_a_json_zone(spark):
    d = new_dir()
    sinks.write_partitions(processed(spark, [{}], 15), d, fmt="json")
    write_lines(Path(d) / "year=2024/month=03/day=31/hour=15/b.json", ['{"city": "bro', json.dumps({**reading(), "humidity_pct": 45.5})])
    assert [r.city for r in read_processed(spark, d, fmt="json").collect()] == ["New York City"]
    assert sorted(r[MALFORMED] for r in processed_rejects(spark, d).collect()) == ["corrupt_record", "humidity_pct"]


# ---------------------------------------------------------------- the index

def test_changes_are_found_whoever_made_them(spark):
    out, summary = new_dir(), f"{new_dir()}/summary"
    at = lambda h, m=5, **r: dict(observed_at=f"2024-03-31T{h:02d}:{m:02d}:00+00:00", **r)

    def counts():
        got = spark.read.parquet(summary)
        return {(r.observed_hour.hour, r.city_name): r.reading_count for r in got.collect()}

    def update():
        n = marts.update_hourly_summary(spark, out, summary)
        want = marts.weather_hourly_summary(marts.stg_weather_raw(read_processed(spark, out)))
        assert counts() == {(r.observed_hour.hour, r.city_name): r.reading_count for r in want.collect()}
        return n

    sinks.write_partitions(processed(spark, [at(10)], 10), out)
    assert update() == 1 and update() == 0
    sinks.write_partitions(processed(spark, [at(10, 20)], 11), out)      # not announced
    sinks.write_partitions(processed(spark, [at(10, 40), at(12)], 12), out)
    assert update() == 2 and counts()[10, "New York City"] == 3
    # A reading that lands before it was observed, in a padded folder.
    early = processed(spark, [at(14, 1, city="Early")], 9).withColumns({c: F.lpad(F.col(c).cast("string"), 2, "0") for c in ("month", "hour")})
    early.write.mode("append").partitionBy(*PARTITION_COLS).parquet(out)
    assert update() == 1 and (14, "Early") in counts()
    sinks.remove_hours(spark, out, [(2024, 3, 31, 12)])                  # an hour goes
    assert update() == 1 and (12, "New York City") not in counts()
    sinks.write_partitions(processed(spark, [at(13, city=None)], 11), out)  # no key: no summary
    assert update() == 1 and counts()[10, "New York City"] == 1
    versions = sorted(p.name for p in Path(f"{summary}_index").iterdir() if p.name.startswith("version"))
    assert len(versions) == 2


def test_a_run_that_dies_is_repeated(spark, monkeypatch):
    out, summary = new_dir(), f"{new_dir()}/summary"
    sinks.write_partitions(processed(spark, [{}], 15), out)
    monkeypatch.setattr(marts, "write_partitions", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("dies")))
    with pytest.raises(RuntimeError, match="dies"):
        marts.update_hourly_summary(spark, out, summary)
    monkeypatch.undo()
    assert zone.read_index(spark, f"{summary}_index").isEmpty()
    assert marts.update_hourly_summary(spark, out, summary) == 1 and spark.read.parquet(summary).count() == 1


def test_window_by_index_reads_only_its_partitions(spark):
    out, index = new_dir(), f"{new_dir()}/index"
    for hour, seen in ((9, "15:10"), (10, "10:05"), (15, "15:05"), (16, "15:59"), (20, "14:59")):
        sinks.write_partitions(processed(spark, [dict(observed_at=f"2024-03-31T{seen}:00+00:00")], hour), out)
    window = lambda: dashboard.load_window(spark, out, "2024-03-31 15:59:00", hours=1, index_root=index)
    assert sorted(r.observed_at.strftime("%H:%M") for r in window().collect()) == ["14:59", "15:05", "15:10", "15:59"]
    assert zone.window_partitions(spark, out, index, None, "2024-03-31 15:00:00", "2024-03-31 15:59:00") == [zone.datetime.datetime(2024, 3, 31, h) for h in (9, 15, 16)]
    sinks.write_partitions(processed(spark, [dict(observed_at="2024-03-31T15:30:00+00:00")], 21), out)
    assert window().count() == 5
    assert dashboard.load_window(spark, out, "2024-03-31 15:59:00", hours=1).count() == 5  # without: every partition is read


def test_zone_that_is_not_there(spark):
    assert zone.zone_files(spark, f"{new_dir()}/none").isEmpty() and zone.zone_files(spark, new_dir()).isEmpty()
    assert marts.update_hourly_summary(spark, f"{new_dir()}/none", f"{new_dir()}/s") == 0


# ---------------------------------------------------------------- writes and the catalog

def test_a_write_looks_only_at_its_own_hours(spark):
    out = new_dir()
    for h in (3, 4):
        sinks.write_partitions(processed(spark, [{}], h), out)
    padded = Path(out) / "year=2024/month=03/day=31"
    for h in ("03", "05"):
        (padded / f"hour={h}").mkdir(parents=True)
    assert sinks.write_partitions(processed(spark, [{}, {}], 3), out) == {(2024, 3, 31, 3)}
    assert not (padded / "hour=03").exists() and (padded / "hour=05").exists()
    found = sinks._folders(spark, out, [(2024, 3, 31, 4), (2024, 3, 31, 5), (2024, 3, 31, 6)])
    assert {k: len(v) for k, v in found.items()} == {(2024, 3, 31, 4): 1, (2024, 3, 31, 5): 1}
    assert sinks.write_partitions(processed(spark, [{}], 3).where("false"), out) == set()


def test_hours_switch_as_a_whole(spark):
    root, name = new_dir(), "zone_atomic"
    sinks.write_partitions(processed(spark, [dict(city="old")], 3).unionByName(processed(spark, [dict(city="old")], 4)), root)
    sinks.register_table(spark, name, root, PROCESSED)
    seen = lambda: sorted((r.hour, r.city) for r in spark.table(name).collect())
    new = processed(spark, [dict(city="new")], 4).unionByName(processed(spark, [dict(city="new")], 5))
    folder, hours = sinks.stage_hours(new, name)
    assert seen() == [(3, "old"), (4, "old")] and hours == {(2024, 3, 31, 4), (2024, 3, 31, 5)}
    before = sinks.publish_hours(spark, name, folder, hours)
    spark.catalog.refreshTable(name)
    assert seen() == [(3, "old"), (4, "new"), (5, "new")] and len(before) == 1 and before[0].endswith("hour=4")
    sinks.delete_folders(spark, before)
    assert sinks.replace_hours(processed(spark, [dict(city="newest")], 4), name) == {(2024, 3, 31, 4)}
    assert seen() == [(3, "old"), (4, "newest"), (5, "new")]
    assert sinks.catalog_diff(spark, name).count() == 0
    sinks.empty_hours(spark, name, ["2024-03-31T04", "2024-03-31T03"])
    assert seen() == [(5, "new")]
    assert [r.hour for r in sinks.expire_partitions(spark, name, "2025-01-01 00:00:00").collect()] == [5] and seen() == []


def test_atomic_jobs(spark):
    raw, out, bad, name = new_dir(), new_dir(), new_dir(), "zone_atomic_job"
    lines = Path(raw) / "year=2024/month=3/day=31/hour=15/a.json"
    write_lines(lines, [reading(), reading(temp_f=999)])
    run = lambda: jobs.process_hour(spark, raw, out, "2024-03-31T15", quarantine_root=bad, processed_at="p", table=name, atomic=True)
    for _ in range(2):
        assert (run().valid, spark.table(name).count(), spark.table(f"{name}_quarantine").count()) == (1, 1, 1)
    write_lines(lines, [reading(temp_f=999)])
    run()
    assert (spark.table(name).count(), spark.table(f"{name}_quarantine").count()) == (0, 1)
    write_lines(lines, [reading()])
    jobs.backfill(spark, raw, out, ["2024-03-31T15"], quarantine_root=bad, processed_at="p", table=name, atomic=True)
    assert (spark.table(name).count(), spark.table(f"{name}_quarantine").count()) == (1, 0)


def test_catalog_is_repaired_both_ways(spark):
    root, name = new_dir(), "zone_repair"
    for h in (3, 4):
        sinks.write_partitions(processed(spark, [{}], h), root)
    sinks.register_table(spark, name, root, PROCESSED)
    sinks.remove_hours(spark, root, [(2024, 3, 31, 3)])
    sinks.write_partitions(processed(spark, [{}], 5), root)
    padded = processed(spark, [{}, {}], 6).withColumn("month", F.lit("03")).withColumn("hour", F.lit("06"))
    padded.write.mode("append").partitionBy(*PARTITION_COLS).parquet(root)
    want = [(3, "vanished"), (5, "new"), (6, "new")]
    assert sorted((r.hour, r.status) for r in sinks.catalog_diff(spark, name).collect()) == want
    assert sorted((r.hour, r.status) for r in sinks.reconcile_table(spark, name).collect()) == want
    assert sorted(r.hour for r in spark.table(name).collect()) == [4, 5, 6, 6] and sinks.catalog_diff(spark, name).isEmpty()
    processed(spark, [{}], 4).withColumn("month", F.lit("03")).write.mode("append").partitionBy(*PARTITION_COLS).parquet(root)
    assert [(r.hour, r.status) for r in sinks.reconcile_table(spark, name).collect()] == [(4, "double")]
    assert read_raw(spark, f"{root}/none", run_hour="2024-03-31T15").count() == 0
