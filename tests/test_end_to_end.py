"""Fetch -> raw -> process -> marts -> dashboard/quality, for two hours of
all 19 cities with a replay transport (one city always fails)."""

from __future__ import annotations

import copy

from conftest import GOLDEN, new_dir
from nimbus.dims import CITIES
from nimbus.operators.quality import coverage_report, rule_failures
from nimbus.operators.validate import quality_rules
from nimbus.plans import dashboard
from nimbus.plans.jobs import fetch_to_raw, process_hour
from nimbus.plans.marts import build_marts, stg_weather_raw
from nimbus.sources.processed import read_processed
from nimbus.sources.raw import read_raw

HOUR_DT = {"2024-03-31T15": 1711898000, "2024-03-31T16": 1711901600}


def _transport_for(run_hour):
    def transport(key):
        if key["name"] == "Hartford":
            raise TimeoutError("no answer")
        doc = copy.deepcopy(GOLDEN)
        doc["coord"] = {"lat": key["lat"], "lon": key["lon"]}
        base = 40.0 + (len(key["name"]) % 7) * 5 + (1.5 if run_hour.endswith("16") else 0.0)
        doc["main"].update(temp=base, feels_like=base - 2, temp_min=base - 3, temp_max=base + 3)
        doc["weather"][0]["main"] = "Rain" if key["state"] == "NJ" else "Clear"
        doc["dt"] = HOUR_DT[run_hour]
        return doc
    return transport


def test_pipeline_end_to_end(spark):
    raw, out, quar = new_dir(), new_dir(), new_dir()
    for h in HOUR_DT:
        res = fetch_to_raw(spark, _transport_for(h), raw, h)
        assert (res.ok, res.failed) == (18, 1)
        p = process_hour(spark, raw, out, h, quarantine_root=quar, processed_at="p")
        assert (p.valid, p.invalid) == (18, 0)
    assert read_raw(spark, raw).count() == 36

    processed = read_processed(spark, out)
    counts = build_marts(processed, prefix="e2e_")
    assert counts == {"weather_current": 18, "weather_hourly_summary": 36}

    stg = stg_weather_raw(processed)
    cur = spark.table("e2e_weather_current")
    assert cur.filter("city_name = 'Hartford'").count() == 0
    nyc = cur.filter("city_name = 'New York City'").first()
    assert nyc.observed_at.hour == 16 and nyc.latitude == 40.7128

    snap = dashboard.regional_snapshot_with_delta(stg, "2024-03-31 16:00:00").first()
    assert snap.reading_count == 18 and snap.hour_delta == 1.5 and snap.delta_label == "+1.5°F"
    opts = [r.city_name for r in dashboard.city_options(cur, ["CT"]).collect()]
    assert opts == ["Bridgeport", "New Haven", "Norwalk", "Stamford", "Waterbury"]

    m = dashboard.weather_map(stg, hour="2024-03-31 16:00:00")
    assert m.count() == 18 and m.filter("radius = 5500").count() == 1
    assert m.filter("city_name = 'New York City'").first().color[3] == 240

    adv = {r.city_name: r for r in dashboard.advisor(cur, month=3).collect()}
    assert adv["Newark"].severity == "poor"
    assert adv["Newark"].activities[0].startswith("Newark Museum of Art")

    dist = {r.Condition: r.Count for r in dashboard.condition_distribution(stg).collect()}
    assert dist == {"Clear": 24, "Rain": 12}

    box, order = dashboard.city_comparison(spark.table("e2e_weather_hourly_summary"))
    assert box.count() == 18 and order.count() == 18

    q = {r.rule: r.failed_count for r in rule_failures(
        processed, quality_rules(observed=None, fetched=None)).collect()}
    assert all(v == 0 for v in q.values()), q
    cov = coverage_report(processed, "state", "city", "city_slug", ["NY", "NJ", "CT"], 15).first()
    assert cov.missing_states == [] and cov.n_cities == 18 and cov.duplicate_slugs == 0

    window = dashboard.window_24h(stg, "observed_at", as_of="2024-03-31 16:30:00")
    assert window.count() == 36
    cards = dashboard.cards(cur).collect()
    assert len(cards) == 18 and cards[0].title == "Albany, NY" and cards[0].value == "71.5 °F"
    assert len(CITIES) == 19


def test_incremental_marts_equal_full_refresh(spark):
    from pathlib import Path
    from conftest import reading, write_lines
    from nimbus.plans.marts import (update_current, update_hourly_summary, weather_current,
                                    weather_hourly_summary)
    raw, out, summ = new_dir(), new_dir(), new_dir()
    # readings observed in hour h land in processing hour h, or h+1 when fetched late
    landed = {
        14: [reading(city="A", observed_at="2024-03-31T14:05:00+00:00", temp_f=50.0),
             reading(city="B", observed_at="2024-03-31T14:10:00+00:00", temp_f=60.0)],
        15: [reading(city="A", observed_at="2024-03-31T14:50:00+00:00", temp_f=52.0,
                     condition_main="Rain"),
             reading(city="B", observed_at="2024-03-31T15:10:00+00:00", temp_f=61.0)],
        16: [reading(city="A", observed_at="2024-03-31T15:55:00+00:00", temp_f=55.0),
             reading(city="C", observed_at="2024-03-31T16:01:00+00:00", temp_f=40.0)],
    }
    table = "inc_current"
    for h, rows in landed.items():
        write_lines(Path(raw) / f"year=2024/month=3/day=31/hour={h}" / "a.json", rows)
        run = f"2024-03-31T{h}"
        process_hour(spark, raw, out, run, processed_at="p")
        this_hour = read_processed(spark, out).filter(f"hour = {h}")
        update_current(spark, table, this_hour)
        update_hourly_summary(spark, out, summ)
    full = stg_weather_raw(read_processed(spark, out))
    cols = sorted(spark.table(table).columns)
    assert sorted(map(tuple, spark.table(table).select(cols).collect())) == \
        sorted(map(tuple, weather_current(full).select(cols).collect()))
    inc = spark.read.parquet(summ).drop("year", "month", "day", "hour")
    want = weather_hourly_summary(full)
    cols = sorted(want.columns)
    assert sorted(map(tuple, inc.select(cols).collect())) == \
        sorted(map(tuple, want.select(cols).collect()))
    assert inc.count() == 5


def test_load_window_reads_only_window_folders(spark):
    import contextlib
    import io
    from pathlib import Path
    from conftest import reading, write_lines
    raw, out = new_dir(), new_dir()
    for h in range(10, 17):
        write_lines(Path(raw) / f"year=2024/month=3/day=31/hour={h}" / "a.json",
                    [reading(observed_at=f"2024-03-31T{h:02d}:05:00+00:00")])
        process_hour(spark, raw, out, f"2024-03-31T{h}", processed_at="p")
    w = dashboard.load_window(spark, out, "2024-03-31 15:30:00", hours=2, max_lag_hours=1, max_lead_hours=0)
    assert sorted(r.observed_at.hour for r in w.collect()) == [14, 15]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        w.explain(mode="formatted")
    location = [ln for ln in buf.getvalue().splitlines() if ln.startswith("Location:")][0]
    # the file index holds hour folders of the window (13..16), not the root
    assert "/day=31/hour=13" in location and "3 entries" in location, location


def test_update_current_ignores_older_late_readings(spark):
    from conftest import reading
    from nimbus.operators.enrich import enrich
    from nimbus.plans.marts import update_current
    from nimbus.schemas import READING

    def processed(rows):
        return enrich(spark.createDataFrame(rows, READING), run_hour="2024-03-31T16",
                      processed_at="p")
    table = "inc_current_late"
    update_current(spark, table, processed([reading(observed_at="2024-03-31T16:05:00+00:00",
                                                    temp_f=70.0)]))
    # a late reading observed earlier arrives afterwards: the mart keeps 16:05
    update_current(spark, table, processed([reading(observed_at="2024-03-31T15:30:00+00:00",
                                                    temp_f=10.0)]))
    rows = spark.table(table).collect()
    assert len(rows) == 1 and rows[0].temp_f == 70.0
    # a newer reading replaces it; a second city is added
    update_current(spark, table, processed([
        reading(observed_at="2024-03-31T16:45:00+00:00", temp_f=71.0),
        reading(city="Albany", observed_at="2024-03-31T16:40:00+00:00", temp_f=60.0)]))
    got = {r.city_name: r.temp_f for r in spark.table(table).collect()}
    assert got == {"New York City": 71.0, "Albany": 60.0}
