from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from conftest import GOLDEN, new_dir, reading, write_lines
from nimbus.dims import cities_df
from nimbus.operators.flatten import flatten_payload, stage
from nimbus.operators.reshape import missing_keys, union_batches
from nimbus.operators.summary import row_count
from nimbus.plans import dashboard
from nimbus.plans.marts import build_marts, stg_weather_raw
from nimbus.schemas import READING
from nimbus.sources.processed import read_processed
from nimbus.sources.raw import read_mixed_json, read_payload
from nimbus.sources.sinks import write_partitions


def test_mixed_json_lines(spark):
    d = new_dir()
    write_lines(Path(d) / "x.json", [reading(), "", [reading(city="A"), reading(city="B")], "  "])
    df = read_mixed_json(spark, d, READING)
    assert sorted(r.city for r in df.collect()) == ["A", "B", "New York City"]


def test_payload_scan_and_flatten(spark):
    d = new_dir()
    write_lines(Path(d) / "p.json", [GOLDEN])
    p = read_payload(spark, d).withColumn("city", F.lit("New York City")) \
        .withColumn("state", F.lit("NY"))
    r = flatten_payload(p).first()
    assert r.temp_f == 72.5 and r.condition_main == "Clear"


def test_processed_json_flavour_and_union(spark):
    d = new_dir()
    old = spark.createDataFrame([reading()], READING).drop("wind_gust_mph") \
        .withColumns({"year": F.lit(2024), "month": F.lit(3), "day": F.lit(31), "hour": F.lit(15)})
    write_partitions(old, d, fmt="json")
    df = read_processed(spark, d, fmt="json")
    r = df.first()
    assert r.wind_gust_mph is None and r.city == "New York City" and r.hour == 15
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.5)], "id int, b double")
    u = union_batches([a, b]).orderBy("id").collect()
    assert [(r.id, r.a, r.b) for r in u] == [(1, "x", None), (2, None, 3.5)]


def test_build_marts_counts(spark):
    rows = [reading(), reading(city="Buffalo"),
            reading(observed_at="2024-03-31T16:46:40+00:00")]
    counts = build_marts(spark.createDataFrame(rows, READING), prefix="t_")
    assert counts == {"weather_current": 2, "weather_hourly_summary": 3}
    assert spark.table("t_weather_current").count() == 2
    assert row_count(spark.table("t_weather_hourly_summary")).first().row_count == 3


def test_missing_keys_and_window(spark):
    stg = stg_weather_raw(spark.createDataFrame(
        [reading(), reading(city="Buffalo", observed_at="2024-03-30T10:00:00+00:00")], READING))
    expected = cities_df(spark).select(F.col("name").alias("city_name"))
    miss = missing_keys(expected, stg, "city_name")
    assert miss.count() == 17
    w = dashboard.window_24h(stg, "observed_at", as_of="2024-03-31 16:00:00")
    assert [r.city_name for r in w.collect()] == ["New York City"]
    sel = dashboard.select_cities(stg, cities=None, states=["NY"])
    assert sel.count() == 2
    assert stage(spark.createDataFrame([reading()], READING)).count() == 1


def test_sync_tables_and_as_of_label(spark):
    from nimbus.operators.enrich import enrich
    from nimbus.plans.marts import build_sync_tables
    rows = [reading(fetched_at="2024-03-31T16:00:00+00:00", temp_f=70.0),
            reading(fetched_at="2024-03-31T16:20:00+00:00", temp_f=71.0),
            reading(city="Buffalo", observed_at="2024-03-31T17:10:00+00:00")]
    processed = enrich(spark.createDataFrame(rows, READING), run_hour="2024-03-31T16",
                       processed_at="2024-03-31T16:30:00+00:00")
    counts = build_sync_tables(processed, prefix="s_")
    assert counts == {"weather_processed": 3, "weather_current": 2, "weather_hourly_summary": 2}
    cur = {r.city_slug: r.temp_f for r in spark.table("s_weather_current").collect()}
    assert cur == {"new_york_city_ny": 71.0, "buffalo_ny": 72.5}
    assert len(spark.table("s_weather_current").columns) == 21
    hs = spark.table("s_weather_hourly_summary").filter("city_name = 'New York City'").first()
    assert (hs.min_temp_f, hs.max_temp_f, hs.avg_temp_f) == (70.0, 71.0, 70.5)
    lbl = dashboard.data_as_of(stg_weather_raw(spark.createDataFrame(rows, READING))).first()
    assert lbl.label == "Data as of: Mar 31, 2024 01:10 PM ET"


def test_approx_range_summary_and_partition_bounds(spark):
    from nimbus.operators.filters import partition_bounds
    from nimbus.operators.views import range_summary
    df = spark.createDataFrame([("A", float(i), float(i + 1), float(i + 2)) for i in range(50)],
                               "city_name string, lo double, mid double, hi double")
    exact_r = range_summary(df, "city_name", ["lo", "mid", "hi"]).first()
    approx_r = range_summary(df, "city_name", ["lo", "mid", "hi"], approx=True).first()
    assert (approx_r.min_v, approx_r.max_v) == (exact_r.min_v, exact_r.max_v) == (0.0, 51.0)
    assert abs(approx_r.median - exact_r.median) <= 1.0
    parts = spark.createDataFrame([(2024, 3, 31, h) for h in range(24)],
                                  "year int, month int, day int, hour int")
    both = parts.filter(partition_bounds("2024-03-31 05:30:00", "2024-03-31 08:00:00", 2, 0))
    assert [r.hour for r in both.orderBy("hour").collect()] == [5, 6, 7, 8, 9, 10]
    lower_only = parts.filter(partition_bounds("2024-03-31 20:10:00", max_lead_hours=0))
    assert [r.hour for r in lower_only.orderBy("hour").collect()] == [20, 21, 22, 23]


def test_processed_parquet_schema_evolution(spark):
    d = new_dir()
    base = spark.createDataFrame([reading()], READING).withColumns(
        {"year": F.lit(2024), "month": F.lit(3), "day": F.lit(31), "hour": F.lit(15)})
    write_partitions(base.drop("wind_gust_mph"), d)
    write_partitions(base.withColumn("hour", F.lit(16)).withColumn("heat_note", F.lit("x")), d)
    df = read_processed(spark, d, merge_schema=True)
    rows = {r.hour: (r.wind_gust_mph, r.heat_note) for r in df.collect()}
    assert rows == {15: (None, None), 16: (8.1, "x")}
