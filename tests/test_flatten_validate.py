from __future__ import annotations

import json

from pyspark.sql import functions as F

from conftest import GOLDEN, reading
from nimbus.operators.enrich import enrich
from nimbus.operators.flatten import flatten_payload, stage, to_json_lines
from nimbus.operators.validate import (REASONS, ingest_rules, quality_rules, split,
                                       split_counts, validate)
from nimbus.schemas import PAYLOAD, READING, REQUIRED_COLS


def _payload_df(spark, docs, city="New York City", state="NY"):
    rows = [(city, state, json.dumps(d)) for d in docs]
    raw = spark.createDataFrame(rows, "city string, state string, doc string")
    return raw.select("city", "state", F.from_json("doc", PAYLOAD).alias("d")).select(
        "city", "state", "d.*")


def test_golden_payload_flattens(spark):
    r = flatten_payload(_payload_df(spark, [GOLDEN]), fetched_at=F.lit("x")).first().asDict()
    assert r["city"] == "New York City" and r["state"] == "NY" and r["country"] == "US"
    assert r["lat"] == 40.7128 and r["lon"] == -74.006
    assert (r["temp_f"], r["feels_like_f"], r["temp_min_f"], r["temp_max_f"]) == (72.5, 70.1, 68.0, 75.0)
    assert (r["humidity_pct"], r["pressure_hpa"], r["visibility_m"]) == (65, 1013, 10000)
    assert (r["wind_speed_mph"], r["wind_deg"], r["wind_gust_mph"], r["clouds_pct"]) == (5.2, 180, 8.1, 0)
    assert (r["condition_main"], r["condition_description"], r["condition_icon"]) == ("Clear", "clear sky", "01d")
    assert r["observed_at"] == "2024-03-31T15:46:40+00:00"


def test_missing_gust_and_defaults(spark):
    doc = {**GOLDEN, "wind": {"speed": 3.0, "deg": 90}}
    doc.pop("visibility")
    doc.pop("clouds")
    doc["sys"] = {}
    r = flatten_payload(_payload_df(spark, [doc], "Albany")).first()
    assert r.wind_gust_mph is None
    assert r.visibility_m == 0 and r.clouds_pct == 0 and r.country == "US"
    assert r.sunrise == "1970-01-01T00:00:00+00:00"


def test_missing_main_is_rejected_not_fatal(spark):
    doc = {k: v for k, v in GOLDEN.items() if k not in ("main", "weather")}
    flat = flatten_payload(_payload_df(spark, [doc, GOLDEN]), fetched_at=F.lit("2024-03-31T16:00:00+00:00"))
    valid, invalid = split(flat, ingest_rules())
    assert valid.count() == 1
    reasons = invalid.first()[REASONS]
    assert "missing:temp_f" in reasons and "missing:condition_main" in reasons


def test_each_required_column_null_one_at_a_time(spark):
    rows = [reading()] + [reading(**{c: None}) for c in REQUIRED_COLS]
    df = spark.createDataFrame(rows, READING)
    out = {r.city or "": r[REASONS] for r in validate(df, ingest_rules()).collect()}
    c = split_counts(df, ingest_rules()).first()
    assert (c.total_count, c.valid_count, c.invalid_count) == (17, 1, 16)
    reasons = [r[REASONS] for r in validate(df, ingest_rules()).collect()]
    for col in REQUIRED_COLS:
        assert any(f"missing:{col}" in rs for rs in reasons)
    assert out


def test_closed_ranges_and_nan(spark):
    cases = [
        (-100.0, 50, 870, 0.0, True), (150.0, 100, 1085, 0.0, True),
        (-100.01, 50, 1000, 1.0, False), (150.01, 50, 1000, 1.0, False),
        (70.0, -1, 1000, 1.0, False), (70.0, 101, 1000, 1.0, False),
        (70.0, 0, 869, 1.0, False), (70.0, 0, 1086, 1.0, False),
        (70.0, 50, 1000, -0.1, False), (float("nan"), 50, 1000, 1.0, False),
        (70.0, 50, 1000, float("nan"), False),
    ]
    rows = [reading(temp_f=t, humidity_pct=h, pressure_hpa=p, wind_speed_mph=w)
            for t, h, p, w, _ in cases]
    got = [len(r[REASONS]) == 0 for r in validate(spark.createDataFrame(rows, READING),
                                                  ingest_rules()).collect()]
    assert got == [ok for *_, ok in cases]


def test_split_is_a_partition_of_rows(spark):
    rows = [reading(), reading(temp_f=None), reading(humidity_pct=500), reading(temp_f=float("nan"))]
    df = spark.createDataFrame(rows, READING)
    valid, invalid = split(df, ingest_rules())
    assert valid.count() + invalid.count() == df.count()


def test_enrich_units_and_slug(spark):
    df = spark.createDataFrame([reading(city="New   York  City", temp_f=212.0, feels_like_f=32.0,
                                        wind_speed_mph=10.0)], READING)
    r = enrich(df, run_hour="2024-03-31T15", processed_at="p").first()
    assert r.city_slug == "new_york_city_ny"
    assert (r.temp_c, r.feels_like_c, r.wind_speed_ms) == (100.0, 0.0, 4.47)
    assert (r.year, r.month, r.day, r.hour, r.processed_at) == (2024, 3, 31, 15, "p")


def test_stage_types_and_hour(spark):
    df = spark.createDataFrame([reading()], READING)
    s = stage(df)
    assert len(s.columns) == 22
    r = s.first()
    assert r.city_name == "New York City" and r.observed_hour.hour == 15
    assert dict(s.dtypes)["observed_at"] == "timestamp"


def test_json_lines_round_trip(spark):
    df = spark.createDataFrame([reading(wind_gust_mph=None)], READING)
    line = to_json_lines(df).first().value
    back = json.loads(line)
    assert back["city"] == "New York City" and "wind_gust_mph" not in back


def test_quality_rules_flag_bad_rows(spark):
    bad = reading(temp_f=130.0, temp_max_f=140.0, feels_like_f=60.0, lat=30.0,
                  condition_main="  ", state="PA",
                  observed_at="2024-03-31T17:00:00+00:00")
    v = validate(spark.createDataFrame([reading(), bad], READING), quality_rules()).collect()
    assert v[0][REASONS] == []
    assert set(v[1][REASONS]) == {"state_in_region", "temp_realistic", "feels_like_near_temp",
                                  "lat_in_bbox", "condition_not_blank",
                                  "observed_not_after_fetched"}


def test_declared_schemas(spark):
    from nimbus.dims import activities_df, cities_df, populations_df
    from nimbus.schemas import PARTITION_COLS, PROCESSED, RAW_ZONE
    assert len(READING.fields) == 24 and "wind_gust_mph" in READING.fieldNames()
    assert set(REQUIRED_COLS) <= set(READING.fieldNames())
    assert PROCESSED.fieldNames()[-4:] == PARTITION_COLS == RAW_ZONE.fieldNames()[-4:]
    assert len(PROCESSED.fields) == 24 + 5 + 4
    assert all(all(f.nullable for f in s.fields) for s in (READING, PROCESSED))
    # the payload keeps the API's `rain.1h` field name
    assert PAYLOAD["rain"].dataType.fieldNames() == ["1h"]
    assert (cities_df(spark).count(), populations_df(spark).count()) == (19, 19)
    acts = activities_df(spark)
    assert dict(acts.dtypes)["months"] == "array<int>" and acts.select("city").distinct().count() == 19
