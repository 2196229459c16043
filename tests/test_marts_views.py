from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import reading
from nimbus.dims import activities_df, cities_df, populations_df
from nimbus.functions import exact, geo, text, timefn
from nimbus.operators.quality import coverage_report, freshness, model_tests, rule_failures
from nimbus.operators.snapshot import hour_over_hour, regional_snapshot
from nimbus.operators.summary import dominant_label
from nimbus.operators.validate import quality_rules
from nimbus.operators.views import city_advice, current_cards, map_layer, range_summary
from nimbus.plans import dashboard
from nimbus.plans.marts import (weather_current, weather_current_by_city,
                                weather_hourly_summary)
from nimbus.operators.flatten import stage
from nimbus.schemas import READING


def _stg(spark, rows):
    return stage(spark.createDataFrame(rows, READING))


def test_current_default_and_ties(spark):
    rows = [
        reading(fetched_at="2024-03-31T16:00:00+00:00", temp_f=70.0),
        reading(fetched_at="2024-03-31T16:30:00+00:00", temp_f=71.0),   # same observed_at
        reading(observed_at="2024-03-31T14:00:00+00:00", temp_f=60.0),
        reading(city="Newark", state="NJ"),
        reading(city="Newark", state="NY", observed_at="2024-03-31T17:00:00+00:00", temp_f=50.0),
    ]
    stg = _stg(spark, rows)
    cur = {(r.city_name, r.state_code): r.temp_f for r in weather_current(stg).collect()}
    assert cur == {("New York City", "NY"): 71.0, ("Newark", "NJ"): 72.5, ("Newark", "NY"): 50.0}
    ties = weather_current(stg, keep_ties=True).filter("city_name = 'New York City'")
    assert sorted(r.temp_f for r in ties.collect()) == [70.0, 71.0]
    by_city = {r.city_name: r.state_code for r in weather_current_by_city(stg).collect()}
    assert by_city["Newark"] == "NY"
    assert len(weather_current(stg).columns) == 18


def test_hourly_summary_profiles_and_tie(spark):
    rows = [
        reading(temp_f=70.0, temp_min_f=60.0, temp_max_f=80.0, condition_main="Rain",
                humidity_pct=50, wind_gust_mph=None),
        reading(temp_f=71.005, temp_min_f=65.0, temp_max_f=75.0, condition_main="Clouds",
                humidity_pct=51, observed_at="2024-03-31T15:10:00+00:00", wind_gust_mph=9.0),
        reading(observed_at="2024-03-31T16:10:00+00:00", condition_main="Snow"),
    ]
    stg = _stg(spark, rows)
    dbt = {r.observed_hour.hour: r for r in weather_hourly_summary(stg).collect()}
    h15 = dbt[15]
    assert h15.min_temp_f == 60.0 and h15.max_temp_f == 80.0       # reported extremes
    assert h15.dominant_condition == "Clouds"                       # tie -> smallest label
    assert h15.reading_count == 2 and h15.avg_humidity_pct == 50.5
    assert h15.max_wind_gust_mph == 9.0
    sync = {r.observed_hour.hour: r for r in weather_hourly_summary(stg, "sync").collect()}
    assert sync[15].min_temp_f == 70.0 and sync[15].max_temp_f == 71.005
    raw = weather_hourly_summary(stg, "raw")
    assert "max_wind_gust_mph" not in raw.columns


def test_dominant_label_total_order(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "z")],
                               "k int, label string")
    got = {r.k: (r.dominant, r.label_count) for r in dominant_label(df, "k", "label").collect()}
    assert got == {1: ("a", 2), 2: ("z", 1)}


def test_hour_over_hour_skips_gap(spark):
    rows = [
        reading(city="A", observed_at="2024-03-31T10:05:00+00:00", temp_f=50.0),
        reading(city="B", observed_at="2024-03-31T10:07:00+00:00", temp_f=61.0),
        # no readings at 11:00
        reading(city="A", observed_at="2024-03-31T12:05:00+00:00", temp_f=60.0),
        reading(city="A", observed_at="2024-03-31T12:35:00+00:00", temp_f=62.0),
    ]
    stg = _stg(spark, rows)
    out = {r.observed_hour.hour: r for r in
           hour_over_hour(stg, ["city_name"], "observed_at", "temp_f").collect()}
    assert out[10].hour_delta is None
    assert out[12].prev_hour.hour == 10
    assert out[12].hour_delta == 5.5          # 61.0 - mean(50.0, 61.0)
    exact_out = {r.observed_hour.hour: r for r in
                 hour_over_hour(stg, ["city_name"], "observed_at", "temp_f", scale=2).collect()}
    assert exact_out[12].hour_delta == 5.5


def test_regional_snapshot_argmax_ties(spark):
    rows = [reading(city="B", temp_f=80.0, wind_speed_mph=4.0),
            reading(city="A", temp_f=80.0, wind_speed_mph=6.0),
            reading(city="C", temp_f=40.0, wind_speed_mph=5.0)]
    stg = _stg(spark, rows)
    r = regional_snapshot(stg, "observed_at", "temp_f", "city_name", wind="wind_speed_mph",
                          hour="2024-03-31 15:00:00").first()
    assert (r.max_value, r.max_name, r.min_value, r.min_name) == (80.0, "A", 40.0, "C")
    assert abs(r.avg_value - 200.0 / 3) < 1e-9 and r.avg_wind == 5.0
    snap = dashboard.regional_snapshot_with_delta(stg, "2024-03-31 15:00:00").first()
    assert snap.hour_delta is None


def test_temp_colour_ramp(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 10.0, 20.0, 30.0, 55.0, 89.99, 90.0, 120.0,
                                               float("nan")]], "t double")
    got = [tuple(r.c) for r in df.select(geo.temp_rgb("t").alias("c")).collect()]

    def ref(t):
        a = geo.TEMP_ANCHORS
        if t <= a[0][0]:
            return tuple(a[0][1])
        if t >= a[-1][0]:
            return tuple(a[-1][1])
        for (t0, c0), (t1, c1) in zip(a, a[1:]):
            if t0 <= t <= t1:
                f = (t - t0) / (t1 - t0)
                return tuple(int(c0[j] + f * (c1[j] - c0[j])) for j in range(3))
        return tuple(a[-1][1])

    assert got == [ref(t) for t in [0.0, 10.0, 20.0, 30.0, 55.0, 89.99, 90.0, 120.0,
                                    float("nan")]]


def test_map_layer_population_default(spark):
    stg = _stg(spark, [reading(), reading(city="Nowhere"), reading(city="White Plains")])
    out = {r.city_name: (r.population, r.radius, r.alpha) for r in
           map_layer(stg, populations_df(spark)).collect()}
    hour_map = dashboard.weather_map(stg, hour="2024-03-31 15:00:00")
    assert hour_map.count() == 3
    assert out["New York City"] == (8336817, 5500, 240)
    assert out["White Plains"] == (58109, 3500, 140)
    assert out["Nowhere"][0] == 100000 and 3500 < out["Nowhere"][1] < 5500


def test_city_advice_rules_and_activities(spark):
    rows = [
        reading(city="New York City", condition_main="Clear", feels_like_f=70.0),
        reading(city="Buffalo", condition_main="Rain", feels_like_f=50.0),
        reading(city="Waterbury", condition_main="Snow", feels_like_f=20.0),
        reading(city="Paterson", condition_main="Clouds", feels_like_f=30.0, wind_speed_mph=3.0),
        reading(city="Nowhere", condition_main="Clear", feels_like_f=90.0, humidity_pct=90),
    ]
    cur = weather_current(_stg(spark, rows))
    adv = {r.city_name: r for r in city_advice(cur, activities_df(spark), month=7).collect()}
    ny = adv["New York City"]
    assert ny.severity == "ok" and ny.context_note is None
    assert ny.activities == ["Central Park (stroll, bike, or picnic)",
                             "Broadway show (world-class theater any night)"]
    assert ny.season == "summer" and ny.travel.startswith("Great day")
    bu = adv["Buffalo"]
    assert bu.severity == "poor" and bu.context_note.endswith("Rainy — indoor options shown")
    assert bu.activities[0].startswith("Albright-Knox")
    wb = adv["Waterbury"]
    assert wb.severity == "severe" and wb.dress.startswith("Heavy winter coat")
    assert all(not a.startswith("Lake") for a in wb.activities)
    # Paterson: cold -> poor; it has indoor options, so indoor only
    assert adv["Paterson"].activities[0].startswith("Paterson Museum")
    nowhere = adv["Nowhere"]
    assert nowhere.activities == [] and nowhere.activities_text.startswith("Check local")
    assert nowhere.severity == "poor" and "Muggy" in nowhere.context_note


def test_poor_falls_back_to_outdoor_when_no_indoor(spark):
    acts = spark.createDataFrame([("Town", 0, "Park", True, [7], "walk")],
                                 "city string, ord int, name string, outdoor boolean, "
                                 "months array<int>, tip string")
    rows = [reading(city="Town", condition_main="Rain"),
            reading(city="Town", state="NJ", condition_main="Thunderstorm")]
    out = {r.state_code: r.activities for r in
           city_advice(weather_current(_stg(spark, rows)), acts, month=7).collect()}
    assert out == {"NY": ["Park (walk)"], "NJ": []}


def test_cards_labels(spark):
    rows = [reading(temp_f=72.25, feels_like_f=70.05, condition_description=None,
                    condition_main="Haze")]
    c = current_cards(weather_current(_stg(spark, rows))).first()
    # by the exact binary value, ties to even: 72.25 is a tie, 70.05 lies below one
    assert c.title == "New York City, NY" and c.value == "72.2 °F" and c.delta == "Feels 70.0 °F"
    assert c.label == "🌫️ —"
    assert c.caption == "Humidity 65%  |  Wind 5.2 mph  |  Clouds 0%"


def test_range_summary_matches_linear_interpolation(spark):
    df = spark.createDataFrame([("A", 1.0, 2.0, 4.0), ("A", 3.0, 5.0, 10.0)],
                               "city_name string, lo double, mid double, hi double")
    r = range_summary(df, "city_name", ["lo", "mid", "hi"]).first()
    assert (r.min_v, r.q1, r.median, r.q3, r.max_v) == (1.0, 2.25, 3.5, 4.75, 10.0)


def test_value_counts_and_series(spark):
    stg = _stg(spark, [reading(condition_main="Rain"), reading(condition_main="Rain"),
                       reading(condition_main=None), reading(condition_main="Clear")])
    vc = [(r.Condition, r.Count) for r in dashboard.condition_distribution(stg).collect()]
    assert vc == [("Clear", 1), ("Rain", 2)]
    s = dashboard.temperature_series(stg, ["New York City"])
    assert s.count() == 8 and set(r.Metric for r in s.collect()) == {"Temp", "Feels Like"}


def test_quality_reports(spark):
    rows = [reading(), reading(city="Buffalo", humidity_pct=120), reading(city="Buffalo")]
    df = spark.createDataFrame(rows, READING)
    fails = {r.rule: r.failed_count for r in rule_failures(df, quality_rules()).collect()}
    assert fails["humidity_range"] == 1 and fails["temp_realistic"] == 0
    mt = {(r.test, r.column_name): r.failures for r in model_tests(
        stage(df), [("not_null", "city_name"), ("unique", "city_name"),
                    ("accepted_values", "state_code", ["NY", "NJ", "CT"]),
                    ("accepted_range", "humidity_pct", (0, 100))]).collect()}
    assert mt == {("not_null", "city_name"): 0, ("unique", "city_name"): 1,
                  ("accepted_values", "state_code"): 0, ("accepted_range", "humidity_pct"): 1}
    from nimbus.operators.quality import missing_columns
    assert missing_columns(df, ["city", "temp_f", "pressure_hpa"]) == []
    assert missing_columns(df.drop("temp_f"), ["city", "temp_f"]) == ["temp_f"]
    cities = cities_df(spark)
    cov = coverage_report(cities, "state", "name", "slug", ["NY", "NJ", "CT", "PA"], 15).first()
    assert cov.missing_states == ["PA"] and cov.n_cities == 19 and cov.meets_min_cities
    assert cov.duplicate_slugs == 0
    fr = freshness(stage(df), "observed_at", as_of="2024-03-31 16:46:40").first()
    assert fr.lag_minutes == 60


def test_functions_exact_and_labels(spark):
    df = spark.createDataFrame([(1.005,), (2.675,)], "v double")
    r = df.agg(exact.exact_mean("v", 2, 2).alias("m")).first()
    assert r.m == 1.84
    lab = spark.createDataFrame([(dt.datetime(2024, 3, 10, 6, 0), dt.datetime(2024, 3, 10, 8, 0))],
                                "a timestamp_ntz, b timestamp_ntz")
    a, b = lab.select(timefn.hour_label("a"), timefn.hour_label("b")).first()
    assert (a, b) == ("Mar 10, 01:00 AM ET", "Mar 10, 04:00 AM ET")   # DST starts at 07:00 UTC
    icons = spark.createDataFrame([("Rain",), ("Tornado",)], "c string").select(
        text.condition_icon("c")).collect()
    assert [i[0] for i in icons] == ["🌧️", "🌡️"]
    # as C's printf: exact binary halves go to the even digit
    got = spark.range(1).select(text.signed_one_decimal(F.lit(-0.25)),
                                text.signed_one_decimal(F.lit(0.25)),
                                text.signed_one_decimal(F.lit(-0.04))).first()
    assert tuple(got) == ("-0.2", "+0.2", "-0.0")


def test_summary_of_all_null_values_is_null(spark):
    rows = [reading(humidity_pct=None, wind_gust_mph=None), reading(humidity_pct=None)]
    r = weather_hourly_summary(_stg(spark, rows)).first()
    assert r.avg_humidity_pct is None and r.max_wind_gust_mph == 8.1 and r.reading_count == 2
    from nimbus.operators.summary import Metric, hourly_summary
    e = hourly_summary(_stg(spark, rows), metrics=[Metric("m", "exact_avg", "humidity_pct", 2, scale=2)],
                       label="condition_main").first()
    assert e.m is None


def test_time_parsing_functions(spark):
    r = spark.range(1).select(
        timefn.epoch_to_iso(F.lit(1711900000)).alias("d")).first()
    assert r.d == "2024-03-31T15:46:40+00:00"


def test_one_decimal_is_printf(spark):
    rng = random.Random(5)
    values = [0.05, 0.15, 0.25, 0.35, 72.25, 72.35, 99.95, 0.0, -0.04, -0.25, 1e11 + 0.05, 123456.05, 1e15, 0.95, 9.949999999999999]
    values += [round(rng.uniform(-200, 200), rng.choice([1, 2, 3])) for _ in range(3000)] + [rng.uniform(-50, 150) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", text.one_decimal("v").alias("p"), text.signed_one_decimal("v").alias("s")).collect()
    bad = [(r.v, r.p, r.s) for r in got if (r.p, r.s) != ("%.1f" % r.v, "%+.1f" % r.v)]
    assert not bad, bad[:5]


def test_json_fields_match_get_json_object(spark):
    rows = [('{"k": 87}',), ('{"k": "87"}',), ('{"k": 87.5}',), ('{"k": "abc"}',),
            ('{"k": {"a": 1}}',), ('[1, 2]',), ('not json',), (None,), ('{"x": 1}',),
            ('{"k": null}',), ('{"k": true}',)]
    df = spark.createDataFrame(rows, "props string")
    got = df.select(F.get_json_object("props", "$.k").try_cast("int").alias("ai")).collect()
    once = text.with_json_fields(df, "props", {"k": "int"}).collect()
    assert [r.k for r in once] == [r.ai for r in got]
    assert [r.ai for r in got][:4] == [87, 87, None, None]


def test_model_tests_single_kind(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, s string")
    only_rows = {(r.test, r.column_name): r.failures
                 for r in model_tests(df, [("not_null", "s")]).collect()}
    assert only_rows == {("not_null", "s"): 1}
    only_unique = {(r.test, r.column_name): r.failures
                   for r in model_tests(df, [("unique", "k"), ("unique", "s")]).collect()}
    assert only_unique == {("unique", "k"): 1, ("unique", "s"): 0}
