"""Registered queries of the shipped marts, jobs and dashboard compositions.

Each calls the library's own function on ``weather_rows`` (readings in which
every rule and band has rows on both sides); the oracle states the expected
rows independently, with literal values.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from nimbus.functions.timefn import as_of_label, hour_label
from nimbus.operators.filters import latest, trailing_window
from nimbus.operators.flatten import flatten_payload
from nimbus.operators.quality import quality_report
from nimbus.operators.summary import weather_metrics
from nimbus.operators.validate import MALFORMED, Rule, quality_rules, reason_text
from nimbus.operators.views import advice_columns
from nimbus.plans import dashboard, marts
from nimbus.plans.jobs import QUARANTINE, backfill, process_hour, processed_from_raw
from nimbus.plans.layers import current_mart, refresh_layers, refresh_together, show_version, staging_view, write_version
from nimbus.plans.standins import table
from nimbus.plans.weather_rows import WEATHER_SQL, weather_rows
from nimbus.schemas import PARTITION_COLS, PROCESSED, READING
from nimbus.session import work_dir
from nimbus.sources.keyed import collect_keyed, register_keyed_source
from nimbus.sources.processed import processed_rejects, read_processed
from nimbus.sources.raw import CORRUPT, read_mixed_json, read_payload, read_raw
from nimbus.sources.sinks import (catalog_diff, expire_partitions, publish_hours, reconcile_table, register_table,
                                  remove_hours, stage_hours, table_root, write_partitions, write_raw)
from nimbus.streaming import drain, ingest_stream

STAMP = "2024-12-31T00:00:00+00:00"


def _ntz(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields
                           if f.dataType.typeName() == "timestamp"})


def _stg(spark: SparkSession, sf: str) -> DataFrame:
    return marts.stg_weather_raw(weather_rows(spark, sf).drop("event_id"))


_STG_SQL = f"""
SELECT city AS city_name, state AS state_code, country AS country_code, lat AS latitude, lon AS longitude,
       seen AS observed_at, got AS fetched_at, temp_f, feels_like_f, temp_min_f, temp_max_f, humidity_pct,
       pressure_hpa, 10000 AS visibility_m, wind_speed_mph, 180 AS wind_deg, wind_gust_mph, clouds_pct,
       condition_main, condition_description, '01d' AS condition_icon, date_trunc('hour', seen) AS observed_hour
FROM ({WEATHER_SQL})
"""


def q_stg_weather_raw(spark, sf):
    return _ntz(_stg(spark, sf))


_CURRENT = """city_name, state_code, country_code, latitude, longitude, observed_at, temp_f, feels_like_f,
       temp_min_f, temp_max_f, humidity_pct, pressure_hpa, visibility_m, wind_speed_mph, wind_gust_mph,
       clouds_pct, condition_main, condition_description"""


def q_weather_current(spark, sf):
    return _ntz(marts.weather_current(_stg(spark, sf)))


SQL_WEATHER_CURRENT = f"""
SELECT {_CURRENT} FROM ({_STG_SQL})
WHERE city_name IS NOT NULL AND state_code IS NOT NULL AND observed_at IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY city_name, state_code ORDER BY observed_at DESC, fetched_at DESC) = 1
"""


def q_weather_current_ties(spark, sf):
    """Observed to the hour, so that readings tie; some have no city."""
    stg = _stg(spark, sf).withColumn("observed_at", F.col("observed_hour"))
    return _ntz(marts.weather_current(stg, keep_ties=True))


SQL_WEATHER_CURRENT_TIES = f"""
WITH s AS (SELECT * REPLACE (observed_hour AS observed_at) FROM ({_STG_SQL})),
m AS (SELECT city_name, state_code, max(observed_at) AS observed_at FROM s GROUP BY ALL)
SELECT {_CURRENT} FROM s JOIN m USING (city_name, state_code, observed_at)
"""


def _q_hourly(profile):
    def query(spark, sf):
        return _ntz(marts.weather_hourly_summary(_stg(spark, sf), profile))
    return query


def _sql_hourly(metrics: str, rows: str = _STG_SQL, drop_null: bool = True) -> str:
    where = "WHERE city_name IS NOT NULL AND state_code IS NOT NULL AND observed_at IS NOT NULL" if drop_null else ""
    return f"""
WITH s AS (SELECT * FROM ({rows}) {where}),
n AS (SELECT city_name, state_code, observed_hour, condition_main, count(*) AS n FROM s
      WHERE condition_main IS NOT NULL GROUP BY ALL),
d AS (SELECT city_name, state_code, observed_hour, condition_main AS dominant_condition FROM n
      QUALIFY row_number() OVER (PARTITION BY city_name, state_code, observed_hour ORDER BY n DESC, condition_main) = 1),
a AS (SELECT city_name, state_code, observed_hour, {metrics}, count(*) AS reading_count FROM s GROUP BY city_name, state_code, observed_hour)
SELECT a.*, d.dominant_condition FROM a LEFT JOIN d ON a.city_name IS NOT DISTINCT FROM d.city_name
  AND a.state_code IS NOT DISTINCT FROM d.state_code AND a.observed_hour IS NOT DISTINCT FROM d.observed_hour
"""


_DBT_METRICS = """round(avg(temp_f), 2) AS avg_temp_f, round(min(temp_min_f), 2) AS min_temp_f, round(max(temp_max_f), 2) AS max_temp_f,
  round(avg(feels_like_f), 2) AS avg_feels_like_f, round(avg(humidity_pct), 1) AS avg_humidity_pct,
  round(avg(pressure_hpa), 1) AS avg_pressure_hpa, round(avg(wind_speed_mph), 2) AS avg_wind_speed_mph,
  round(max(wind_gust_mph), 2) AS max_wind_gust_mph, round(avg(clouds_pct), 1) AS avg_clouds_pct"""
_SYNC_METRICS = """round(avg(temp_f), 2) AS avg_temp_f, min(temp_f) AS min_temp_f, max(temp_f) AS max_temp_f,
  round(avg(feels_like_f), 2) AS avg_feels_like_f, round(avg(humidity_pct), 2) AS avg_humidity_pct,
  round(avg(pressure_hpa), 2) AS avg_pressure_hpa, round(avg(wind_speed_mph), 2) AS avg_wind_speed_mph,
  max(wind_gust_mph) AS max_wind_gust_mph, round(avg(clouds_pct), 2) AS avg_clouds_pct"""
_RAW_METRICS = """min(temp_f) AS min_temp_f, avg(temp_f) AS avg_temp_f, max(temp_f) AS max_temp_f,
  avg(feels_like_f) AS avg_feels_like_f, avg(humidity_pct) AS avg_humidity_pct, avg(pressure_hpa) AS avg_pressure_hpa,
  avg(wind_speed_mph) AS avg_wind_speed_mph, avg(clouds_pct) AS avg_clouds_pct"""


def _activities(spark, sf) -> DataFrame:
    """Activities of the towns: parts, indoors or out, in some months."""
    p = table(spark, sf, "part")
    months = F.filter(F.sequence(F.lit(1), F.lit(12)), lambda m: (F.col("p_partkey") + m) % 3 == 0)
    return p.select(F.concat(F.lit("Town  "), (F.col("p_partkey") % 3).cast("string")).alias("city"), F.col("p_partkey").cast("int").alias("ord"),
                    F.col("p_name").alias("name"), (F.col("p_partkey") % 5 != 0).alias("outdoor"), months.alias("months"), F.col("p_brand").alias("tip"))


def q_city_advice(spark, sf):
    """Advice for the latest reading of each town, state and condition."""
    current = marts.weather_current(_stg(spark, sf), keys=("city_name", "state_code", "condition_main"))
    out = dashboard.advisor(current, _activities(spark, sf), month=1)
    return out.select("city_name", "state_code", "condition_main", "severity", "activities_text")


SQL_CITY_ADVICE = f"""
WITH c AS (SELECT * FROM ({_STG_SQL})
  WHERE city_name IS NOT NULL AND state_code IS NOT NULL AND condition_main IS NOT NULL AND observed_at IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY city_name, state_code, condition_main ORDER BY observed_at DESC, fetched_at DESC) = 1),
s AS (SELECT *, CASE WHEN condition_main IN ('Snow', 'Thunderstorm') THEN 'severe'
    WHEN coalesce(condition_main IN ('Rain', 'Drizzle') OR wind_speed_mph > 25 OR (humidity_pct > 85 AND feels_like_f > 78) OR feels_like_f < 40, false) THEN 'poor'
    ELSE 'ok' END AS severity FROM c),
p AS (SELECT 'Town  ' || (p_partkey % 3) AS city, p_partkey AS ord, p_partkey % 5 <> 0 AS outdoor, p_name || ' (' || p_brand || ')' AS label
      FROM part WHERE (p_partkey + 1) % 3 = 0),
j AS (SELECT s.city_name, s.state_code, s.condition_main, s.severity, p.ord, p.label
      FROM s LEFT JOIN p ON p.city = s.city_name AND (s.severity = 'ok' OR NOT p.outdoor
        OR (s.severity = 'poor' AND NOT EXISTS (SELECT 1 FROM p q WHERE q.city = s.city_name AND NOT q.outdoor)))
      QUALIFY row_number() OVER (PARTITION BY s.city_name, s.state_code, s.condition_main ORDER BY p.ord) <= 2)
SELECT city_name, state_code, condition_main, severity,
       coalesce(string_agg(label, '  ·  ' ORDER BY ord), 'Check local listings for options.') AS activities_text
FROM j GROUP BY ALL
"""


def q_snapshot_with_delta(spark, sf):
    stg = _stg(spark, sf)
    return _ntz(dashboard.regional_snapshot_with_delta(stg, latest(stg, "observed_at")))


SQL_SNAPSHOT_WITH_DELTA = f"""
WITH s AS ({_STG_SQL}),
t AS (SELECT * FROM s WHERE observed_hour = (SELECT max(observed_hour) FROM s)),
k AS (SELECT city_name, state_code, observed_hour, round(avg(temp_f), 2) AS km FROM s WHERE temp_f IS NOT NULL GROUP BY ALL),
prev AS (SELECT observed_hour AS prev_hour, avg(km) AS km FROM k WHERE observed_hour < (SELECT max(observed_hour) FROM s)
         GROUP BY ALL ORDER BY 1 DESC LIMIT 1),
a AS (SELECT any_value(observed_hour) AS observed_hour, max(temp_f) AS max_value,
             (SELECT min(city_name) FROM t WHERE temp_f = (SELECT max(temp_f) FROM t)) AS max_name, min(temp_f) AS min_value,
             (SELECT min(city_name) FROM t WHERE temp_f = (SELECT min(temp_f) FROM t)) AS min_name,
             avg(temp_f) AS avg_value, avg(wind_speed_mph) AS avg_wind, count(temp_f) AS reading_count FROM t)
SELECT a.*, prev.prev_hour, round(avg_value - km, 1) AS hour_delta, printf('%+.1f', round(avg_value - km, 1)) || '°F' AS delta_label
FROM a, prev
"""


def q_temperature_series(spark, sf):
    return _ntz(dashboard.temperature_series(_stg(spark, sf), ["Town  0", "Town  2"]))


SQL_TEMPERATURE_SERIES = f"""
WITH s AS (SELECT * FROM ({_STG_SQL}) WHERE city_name IN ('Town  0', 'Town  2'))
SELECT observed_at, city_name, 'Temp' AS "Metric", temp_f AS "°F", city_name || ' — Temp' AS label FROM s
UNION ALL SELECT observed_at, city_name, 'Feels Like', feels_like_f, city_name || ' — Feels Like' FROM s
"""


def q_weather_map(spark, sf):
    pops = table(spark, sf, "orders").groupBy(F.concat(F.lit("Town  "), (F.col("o_custkey") % 2).cast("string")).alias("city")).agg((F.count(F.lit(1)) * 40).alias("population"))
    out = dashboard.weather_map(_stg(spark, sf), pops)
    return out.select("city_name", "state_code", "temp_f", "condition_description", "population", "color_r", "color_g", "color_b", "alpha", "radius")


def _sql_ramp(a: str) -> str:
    """Literal anchors: temperature and one channel's value."""
    points = [tuple(map(int, p.split(":"))) for p in a.split()]
    parts = [f"WHEN temp_f <= {points[0][0]} THEN {points[0][1]}"]
    parts += [f"WHEN temp_f <= {t1} THEN CAST(trunc({v0} + (temp_f - {t0}) / {t1 - t0} * ({v1 - v0})) AS INTEGER)" for (t0, v0), (t1, v1) in zip(points, points[1:])]
    return f"CASE {' '.join(parts)} ELSE {points[-1][1]} END"


SQL_WEATHER_MAP = f"""
WITH s AS ({_STG_SQL}), t AS (SELECT * FROM s WHERE observed_hour = (SELECT max(observed_hour) FROM s)),
p AS (SELECT 'Town  ' || (o_custkey % 2) AS city, count(*) * 40 AS population FROM orders GROUP BY 1),
m AS (SELECT t.*, coalesce(p.population, 100000) AS population FROM t LEFT JOIN p ON p.city = t.city_name),
x AS (SELECT *, least(1.0, greatest(0.0, (log10(population) - log10(58109)) / (log10(8336817) - log10(58109)))) AS part FROM m)
SELECT city_name, state_code, temp_f, condition_description, population,
       {_sql_ramp('10:0 30:30 50:100 70:255 90:200')} AS color_r, {_sql_ramp('10:0 30:100 50:220 70:220 90:30')} AS color_g,
       {_sql_ramp('10:180 30:255 50:200 70:50 90:0')} AS color_b,
       CAST(trunc(140 + part * 100) AS INTEGER) AS alpha, CAST(trunc(3500 + part * 2000) AS INTEGER) AS radius
FROM x
"""


# ---------------------------------------------------------------- quality

_STATES = ["CT", "NJ", "NY"]


def q_weather_quality(spark, sf):
    stg = _stg(spark, sf)
    rules = quality_rules(lat="latitude", lon="longitude", observed="observed_at", fetched="fetched_at", state="state_code")
    return quality_report(stg, marts.weather_current(stg), marts.weather_hourly_summary(stg), rules, _STATES)


def _sql_fails(pred: str, source: str = "s") -> str:
    return f"(SELECT count(*) FROM {source} WHERE NOT coalesce({pred}, false))"


_QUALITY = {
    "state_in_region": "state_code IN ('NY', 'NJ', 'CT')",
    "temp_realistic": "temp_f BETWEEN -20 AND 120",
    "feels_like_near_temp": "abs(feels_like_f - temp_f) < 40",
    "min_le_temp_le_max": "temp_min_f <= temp_f AND temp_f <= temp_max_f",
    "humidity_range": "humidity_pct BETWEEN 0 AND 100",
    "pressure_range": "pressure_hpa BETWEEN 900 AND 1100",
    "wind_non_negative": "wind_speed_mph >= 0",
    "clouds_range": "clouds_pct BETWEEN 0 AND 100",
    "observed_not_after_fetched": "observed_at <= fetched_at",
    "lat_in_bbox": "latitude BETWEEN 38.5 AND 45.5",
    "lon_in_bbox": "longitude BETWEEN -80 AND -70",
    "condition_not_blank": "trim(condition_main) <> ''",
}
_SUITES = [
    *[("staging", "not_null", c, f"SELECT count(*) FROM s WHERE {c} IS NULL") for c in ("city_name", "state_code", "temp_f", "humidity_pct", "observed_at")],
    ("staging", "accepted_values", "state_code", "SELECT count(*) FROM s WHERE state_code NOT IN ('NY', 'NJ', 'CT')"),
    ("staging", "accepted_range", "humidity_pct", "SELECT count(*) FROM s WHERE humidity_pct < 0 OR humidity_pct > 100"),
    *[("current", "not_null", c, f"SELECT count(*) FROM c WHERE {c} IS NULL") for c in ("city_name", "temp_f", "observed_at")],
    ("current", "unique", "city_name", "SELECT count(*) FROM (SELECT 1 FROM c GROUP BY city_name HAVING count(*) > 1)"),
    *[("summary", "not_null", c, f"SELECT count(*) FROM h WHERE {c} IS NULL") for c in ("city_name", "state_code", "observed_hour", "avg_temp_f")],
]
SQL_WEATHER_QUALITY = (f"WITH s AS ({_STG_SQL}), c AS ({SQL_WEATHER_CURRENT}), h AS ({_sql_hourly(_DBT_METRICS)}) "
                       + " UNION ALL ".join([f"SELECT 'rows' AS suite, '{k}' AS test, CAST(NULL AS VARCHAR) AS column_name, {_sql_fails(p)} AS failures" for k, p in _QUALITY.items()]
                                            + [f"SELECT '{s}', '{t}', '{c}', ({q})" for s, t, c, q in _SUITES]))


# ---------------------------------------------------------------- jobs

_REQUIRED = ["city", "state", "country", "lat", "lon", "fetched_at", "observed_at", "temp_f", "feels_like_f", "temp_min_f",
             "temp_max_f", "humidity_pct", "pressure_hpa", "wind_speed_mph", "condition_main", "condition_description"]
_REASONS_SQL = "concat_ws(',', " + ", ".join(
    [f"CASE WHEN {c} IS NULL THEN 'missing:{c}' END" for c in _REQUIRED]
    + ["CASE WHEN NOT coalesce(temp_f BETWEEN -100 AND 150, false) THEN 'range:temp_f' END",
       "CASE WHEN NOT coalesce(humidity_pct BETWEEN 0 AND 100, false) THEN 'range:humidity_pct' END",
       "CASE WHEN NOT coalesce(pressure_hpa BETWEEN 870 AND 1085, false) THEN 'range:pressure_hpa' END",
       "CASE WHEN NOT coalesce(wind_speed_mph >= 0, false) THEN 'range:wind_speed_mph' END"]) + ")"
_JUDGED_SQL = f"SELECT *, {_REASONS_SQL} AS reasons FROM ({WEATHER_SQL})"
_REJECTS_SQL = f"SELECT city, state, observed_at, temp_f, reasons AS reject_reasons, year, month, day, hour FROM ({_JUDGED_SQL}) WHERE reasons <> ''"
_VALID_SQL = f"SELECT * FROM ({_JUDGED_SQL}) WHERE reasons = ''"


def _land(spark, sf, root: str, rows: DataFrame | None = None) -> DataFrame:
    rows = weather_rows(spark, sf) if rows is None else rows
    write_raw(rows.drop("event_id"), root)
    return rows


def _hours(rows: DataFrame) -> list[str]:
    """Hours of the rows (a few hundred partition names)."""
    parts = rows.select("year", "month", "day", "hour").distinct().collect()
    return sorted(f"{r.year}-{r.month:02d}-{r.day:02d}T{r.hour:02d}" for r in parts)


def _rejects(spark, root: str) -> DataFrame:
    return (spark.read.schema(QUARANTINE).json(root)
            .select("city", "state", "observed_at", "temp_f", reason_text().alias("reject_reasons"), "year", "month", "day", "hour"))


def q_process_hour_rejects(spark, sf):
    """One hour processed: its quarantine."""
    base = work_dir(spark, "process-hour")
    rows = _land(spark, sf, f"{base}/raw")
    process_hour(spark, f"{base}/raw", f"{base}/out", _hours(rows)[-1], quarantine_root=f"{base}/bad", processed_at=STAMP)
    return _rejects(spark, f"{base}/bad")


SQL_PROCESS_HOUR_REJECTS = f"""
WITH r AS ({_REJECTS_SQL}), last AS (SELECT max(land) AS h FROM ({WEATHER_SQL}))
SELECT r.* FROM r, last WHERE make_timestamp(year, month, day, hour, 0, 0) = h
"""


def q_backfill_rejects(spark, sf):
    """Every hour replayed in one job: the quarantine."""
    base = work_dir(spark, "backfill")
    rows = _land(spark, sf, f"{base}/raw")
    backfill(spark, f"{base}/raw", f"{base}/out", _hours(rows), quarantine_root=f"{base}/bad", processed_at=STAMP)
    return _rejects(spark, f"{base}/bad")


_OUT = ["city", "state", "observed_at", "temp_f", "humidity_pct", "city_slug", "temp_c", "wind_speed_ms", "processed_at", "year", "month", "day", "hour"]
_OUT_SQL = f"""
SELECT city, state, observed_at, temp_f, humidity_pct, lower(regexp_replace(city, '\\s+', '_', 'g')) || '_' || lower(state) AS city_slug,
       round((temp_f - 32) * 5 / 9, 2) AS temp_c, round(wind_speed_mph * 0.44704, 3) AS wind_speed_ms, '{STAMP}' AS processed_at, year, month, day, hour, land
FROM ({_VALID_SQL})
"""


def q_process_hour_valid(spark, sf):
    """The last hour processed into a table, replaced atomically: its readings."""
    base, name = work_dir(spark, "process-valid"), f"nimbus_hour_{uuid.uuid4().hex[:12]}"
    last = _hours(_land(spark, sf, f"{base}/raw"))[-1]
    for _ in range(2):
        process_hour(spark, f"{base}/raw", f"{base}/out", last, quarantine_root=f"{base}/bad", processed_at=STAMP, table=name, atomic=True)
    return spark.table(name).select(*_OUT)


SQL_PROCESS_HOUR_VALID = f"SELECT * EXCLUDE (land) FROM ({_OUT_SQL}) WHERE land = (SELECT max(land) FROM ({WEATHER_SQL}))"


def q_backfill_valid(spark, sf):
    """Every hour replayed into a table: its readings."""
    base, name = work_dir(spark, "backfill-valid"), f"nimbus_backfill_{uuid.uuid4().hex[:12]}"
    rows = _land(spark, sf, f"{base}/raw")
    backfill(spark, f"{base}/raw", f"{base}/out", _hours(rows), quarantine_root=f"{base}/bad", processed_at=STAMP, table=name)
    return spark.table(name).select(*_OUT)


def q_backfill_zone(spark, sf):
    """Every hour replayed into a path-based zone: its readings."""
    base = work_dir(spark, "backfill-zone")
    rows = _land(spark, sf, f"{base}/raw")
    backfill(spark, f"{base}/raw", f"{base}/out", _hours(rows), quarantine_root=f"{base}/bad", processed_at=STAMP)
    return read_processed(spark, f"{base}/out").select(*_OUT)


SQL_BACKFILL_VALID = f"SELECT * EXCLUDE (land) FROM ({_OUT_SQL})"


def _halves(spark, sf) -> list[DataFrame]:
    """Two landings: the second brings late rows into hours already processed."""
    rows = weather_rows(spark, sf)
    late = F.col("event_id") % 3 == 0
    return [rows.where(~late), rows.where(late)]


def _ingested(spark, sf, summary: bool = False) -> str:
    base = work_dir(spark, "ingest")
    for part in _halves(spark, sf):
        _land(spark, sf, f"{base}/raw", part)
        drain(ingest_stream(spark, f"{base}/raw", f"{base}/out", f"{base}/ck", processed_at=STAMP,
                            quarantine_root=f"{base}/bad", summary_root=f"{base}/summary" if summary else None))
    return base


def q_stream_ingest_rejects(spark, sf):
    return _rejects(spark, f"{_ingested(spark, sf)}/bad")


def q_incremental_summary(spark, sf):
    """The summary kept current over two landings, late readings included."""
    base = _ingested(spark, sf, summary=True)
    out = spark.read.parquet(f"{base}/summary").drop("year", "month", "day", "hour")
    return _ntz(out.select("city_name", "state_code", "observed_hour", *[m.name for m in weather_metrics("dbt")], "reading_count", "dominant_condition"))


_UNANNOUNCED_SQL = f"""
SELECT city AS city_name, state AS state_code, seen AS observed_at, date_trunc('hour', seen) AS observed_hour,
       temp_f, feels_like_f, temp_min_f, temp_max_f, humidity_pct, pressure_hpa, wind_speed_mph, wind_gust_mph,
       clouds_pct, condition_main FROM ({_VALID_SQL}) WHERE day <> 5 AND (hour = 12 OR event_id % 3 = 0)
"""
_VALID_STG_SQL = f"""
SELECT city AS city_name, state AS state_code, seen AS observed_at, date_trunc('hour', seen) AS observed_hour,
       temp_f, feels_like_f, temp_min_f, temp_max_f, humidity_pct, pressure_hpa, wind_speed_mph, wind_gust_mph,
       clouds_pct, condition_main FROM ({_VALID_SQL})
"""


def q_unannounced_summary(spark, sf):
    """A zone that changed behind the summary: a third of the readings were
    summarised; then the noon hours were written whole, and those of day 5
    removed, and nobody said so."""
    base = work_dir(spark, "unannounced")
    w = weather_rows(spark, sf)
    write_partitions(processed_from_raw(w.where("event_id % 3 = 0").drop("event_id"), STAMP), f"{base}/out")
    marts.update_hourly_summary(spark, f"{base}/out", f"{base}/summary")
    write_partitions(processed_from_raw(w.where("hour = 12").drop("event_id"), STAMP), f"{base}/out")
    remove_hours(spark, f"{base}/out", [tuple(r) for r in w.where("day = 5").select(*PARTITION_COLS).distinct().collect()])
    marts.update_hourly_summary(spark, f"{base}/out", f"{base}/summary")
    out = spark.read.parquet(f"{base}/summary").drop("year", "month", "day", "hour")
    return _ntz(out.select("city_name", "state_code", "observed_hour", *[m.name for m in weather_metrics("dbt")], "reading_count", "dominant_condition"))


def q_late_window(spark, sf):
    """The last 24 hours observed, whatever hour the readings landed in: most
    land up to 15 hours late, some before they were observed. By the index."""
    base = work_dir(spark, "late-window")
    early = F.date_trunc("hour", F.col("observed_at").cast("timestamp").cast("timestamp_ntz")).cast("timestamp_ntz") - F.make_dt_interval(hours=(F.col("event_id") % 70).cast("int"))
    w = weather_rows(spark, sf).withColumn("_early", F.when(F.col("event_id") % 6 == 0, early))
    w = w.withColumns({c: F.coalesce(f("_early"), F.col(c)) for c, f in (("year", F.year), ("month", F.month), ("day", F.dayofmonth), ("hour", F.hour))}).drop("_early", "event_id")
    write_partitions(processed_from_raw(w, STAMP), f"{base}/out")
    end = latest(_stg(spark, sf), "observed_at")
    return _ntz(dashboard.load_window(spark, f"{base}/out", end, index_root=f"{base}/index").select("city_name", "state_code", "observed_at", "fetched_at", "temp_f"))


SQL_LATE_WINDOW = f"""
SELECT city AS city_name, state AS state_code, seen AS observed_at, got AS fetched_at, temp_f FROM ({_VALID_SQL})
WHERE seen >= (SELECT max(seen) FROM ({WEATHER_SQL})) - INTERVAL 24 HOURS
"""


def q_float_integers(spark, sf):
    """Integer fields landed as decimals: whole ones are read, fractions are malformed."""
    base = work_dir(spark, "float-integers")
    rows = weather_rows(spark, sf).withColumns({
        "humidity_pct": F.col("humidity_pct").cast("double"),
        "pressure_hpa": F.col("pressure_hpa") + F.when(F.col("event_id") % 10 == 0, 0.5).otherwise(0.0)})
    _land(spark, sf, f"{base}/raw", rows)
    return read_raw(spark, f"{base}/raw").select("city", "observed_at", "humidity_pct", "pressure_hpa", F.col(MALFORMED).alias("malformed"))


SQL_FLOAT_INTEGERS = f"""
SELECT city, observed_at, humidity_pct, CASE WHEN event_id % 10 <> 0 THEN pressure_hpa END AS pressure_hpa,
       CASE WHEN event_id % 10 = 0 THEN 'pressure_hpa' ELSE '' END AS malformed FROM ({WEATHER_SQL})
"""


def q_padded_rerun(spark, sf):
    """Hours stored under zero-padded folders, then written again."""
    base = work_dir(spark, "padded")
    rows = processed_from_raw(weather_rows(spark, sf).drop("event_id"), STAMP)
    padded = rows.withColumns({c: F.lpad(F.col(c).cast("string"), 2, "0") for c in ("month", "day", "hour")})
    padded.hint("rebalance", "year", "month", "day", "hour").write.partitionBy("year", "month", "day", "hour").parquet(f"{base}/out")
    write_partitions(rows, f"{base}/out")
    return read_processed(spark, f"{base}/out").select("city", "state", "observed_at", "temp_f", "year", "month", "day", "hour")


SQL_PADDED_RERUN = f"SELECT city, state, observed_at, temp_f, year, month, day, hour FROM ({_VALID_SQL})"


def q_mixed_schema(spark, sf):
    """Parquet files with and without a column, and one with a column more."""
    base = work_dir(spark, "mixed-schema")
    first, second = ((processed_from_raw(x.drop("event_id"), STAMP)) for x in _halves(spark, sf))
    for df in (first.drop("wind_gust_mph"), second.withColumn("note", F.lit("late"))):
        df.hint("rebalance", "year", "month", "day", "hour").write.mode("append").partitionBy("year", "month", "day", "hour").parquet(f"{base}/out")
    out = read_processed(spark, f"{base}/out", merge_schema=True)
    return out.select("city", "state", "observed_at", "temp_f", "wind_gust_mph", "note")


SQL_MIXED_SCHEMA = f"""
SELECT city, state, observed_at, temp_f, CASE WHEN event_id % 3 = 0 THEN wind_gust_mph END AS wind_gust_mph,
       CASE WHEN event_id % 3 = 0 THEN 'late' END AS note FROM ({_VALID_SQL})
"""


def q_aware_as_of(spark, sf):
    """A window anchored at a time with an offset, on a column without one."""
    ev = table(spark, sf, "events")
    end = datetime.datetime(2024, 1, 20, 17, 30, tzinfo=datetime.timezone(datetime.timedelta(hours=5)))
    return trailing_window(ev, "ts", as_of=end, hours=24).select("event_id", "ts")


SQL_AWARE_AS_OF = "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-19 12:30:00'"

# ---------------------------------------------------------------- other sources and sinks

_READING = ["city", "state", "country", "lat", "lon", "observed_at", "temp_f", "feels_like_f", "humidity_pct", "wind_speed_mph",
            "wind_gust_mph", "clouds_pct", "condition_main", "condition_description"]


def _said() -> list[Column]:
    return [F.col(MALFORMED).alias("malformed"), F.col(CORRUPT).alias("corrupt")]


# What the readers must not lose: whole decimals are integers, fractions and broken lines are named.
_ODD_HUMIDITY = "CASE WHEN event_id % 10 <> 0 THEN humidity_pct END"
_ODD_SAID = "CASE WHEN event_id % 10 = 0 AND humidity_pct IS NOT NULL THEN 'humidity_pct' ELSE '' END"
_BROKEN_SQL = "'{\"city\": \"broken ' || event_id"


def _odd_humidity() -> Column:
    """``45.0`` for most readings, ``45.5`` for some."""
    return F.col("humidity_pct") + F.when(F.col("event_id") % 10 == 0, 0.5).otherwise(0.0)


def _broken() -> Column:
    return F.concat(F.lit('{"city": "broken '), F.col("event_id").cast("string"))


def q_payload_scan(spark, sf):
    """Nested documents written and read back, then flattened (S3, P1, P2):
    integers as decimals, fractions and text, one inside an array, and broken lines."""
    base = work_dir(spark, "payload")
    w = weather_rows(spark, sf)
    second = F.unix_seconds(F.col("observed_at").cast("timestamp"))
    code = F.col("condition_id") + F.when(F.col("event_id") % 11 == 0, 0.5).otherwise(0.0)
    docs = w.select(
        F.struct("lon", "lat").alias("coord"),
        F.array(F.struct(code.alias("id"), F.col("condition_main").alias("main"), F.col("condition_description").alias("description"))).alias("weather"),
        F.struct(F.col("temp_f").alias("temp"), F.col("feels_like_f").alias("feels_like"), F.col("temp_min_f").alias("temp_min"), F.col("temp_max_f").alias("temp_max"),
                 F.col("pressure_hpa").cast("string").alias("pressure"), _odd_humidity().alias("humidity")).alias("main"),
        F.struct(F.col("wind_speed_mph").alias("speed"), F.col("wind_gust_mph").alias("gust")).alias("wind"),
        F.when(F.col("event_id") % 5 != 0, F.struct("clouds_pct").withField("all", F.col("clouds_pct").cast("double"))).alias("clouds"),
        F.when(F.col("event_id") % 7 != 0, F.struct("country")).alias("sys"), second.alias("dt"), F.col("city").alias("name"), F.col("state").alias("base"))
    docs.write.json(f"{base}/docs")
    w.where("event_id % 13 = 0").select(_broken().alias("value")).write.mode("append").text(f"{base}/docs")
    flat = flatten_payload(read_payload(spark, f"{base}/docs"), city="name", state="base", fetched_at=F.lit(STAMP))
    return flat.select(*_READING, "pressure_hpa", *_said())


SQL_PAYLOAD_SCAN = f"""
SELECT city, state, CASE WHEN event_id % 7 <> 0 THEN country ELSE 'US' END AS country, lat, lon,
       strftime(date_trunc('second', seen), '%Y-%m-%dT%H:%M:%S+00:00') AS observed_at, temp_f, feels_like_f, {_ODD_HUMIDITY} AS humidity_pct, wind_speed_mph,
       wind_gust_mph, CASE WHEN event_id % 5 <> 0 THEN clouds_pct ELSE 0 END AS clouds_pct, condition_main, condition_description, pressure_hpa,
       concat_ws(',', CASE WHEN event_id % 11 = 0 THEN 'weather[].id' END, CASE WHEN event_id % 10 = 0 AND humidity_pct IS NOT NULL THEN 'main.humidity' END) AS malformed,
       CAST(NULL AS VARCHAR) AS corrupt
FROM ({WEATHER_SQL})
UNION ALL SELECT NULL, NULL, 'US', NULL, NULL, NULL, NULL, NULL, NULL, 0.0, NULL, 0, NULL, NULL, NULL, 'corrupt_record', {_BROKEN_SQL}
FROM ({WEATHER_SQL}) WHERE event_id % 13 = 0
"""


def q_mixed_json(spark, sf):
    """Lines that hold an object, lines that hold an array of objects, broken
    lines, and integers as decimals and fractions (S2)."""
    base = work_dir(spark, "mixed-json")
    w = weather_rows(spark, sf).withColumn("humidity_pct", _odd_humidity())
    one = F.struct(*[F.col(c) for c in _READING])
    single = w.where("event_id % 3 != 0").select(F.to_json(one).alias("value"))
    many = (w.where("event_id % 3 = 0").groupBy(F.floor(F.col("event_id") / 30)).agg(F.to_json(F.collect_list(one)).alias("value")).select("value"))
    broken = w.where("event_id % 13 = 0").select(_broken().alias("value"))
    single.unionByName(many).unionByName(broken).write.text(f"{base}/lines")
    return read_mixed_json(spark, f"{base}/lines", READING).select(*_READING, *_said())


SQL_MIXED_JSON = f"""
SELECT {', '.join(c if c != 'humidity_pct' else f'{_ODD_HUMIDITY} AS humidity_pct' for c in _READING)}, {_ODD_SAID} AS malformed, CAST(NULL AS VARCHAR) AS corrupt
FROM ({WEATHER_SQL})
UNION ALL SELECT {', '.join('NULL' for _ in _READING)}, 'corrupt_record', {_BROKEN_SQL} FROM ({WEATHER_SQL}) WHERE event_id % 13 = 0
"""

_ZONE = ["city", "state", "observed_at", "temp_f", "humidity_pct", "year", "month", "day", "hour"]


def q_ndjson_processed(spark, sf):
    """The processed zone in its JSON flavour (S5), with integers as decimals
    and fractions and with broken lines: what is read, and what is not."""
    base = work_dir(spark, "ndjson")
    w = weather_rows(spark, sf)
    valid = processed_from_raw(w, STAMP).join(w.where("event_id % 10 = 0").select("city", "state", "observed_at", "temp_f", "lat").distinct()
                                              .withColumn("half", F.lit(0.5)), ["city", "state", "observed_at", "temp_f", "lat"], "left")
    write_partitions(valid.withColumn("humidity_pct", F.col("humidity_pct") + F.coalesce("half", F.lit(0.0))).drop("half"), f"{base}/out", fmt="json")
    broken = w.where("event_id % 13 = 0").select(_broken().alias("value"), *PARTITION_COLS)
    broken.write.mode("append").partitionBy(*PARTITION_COLS).text(f"{base}/out")
    good = read_processed(spark, f"{base}/out", fmt="json").select(*_ZONE, F.lit("").alias("malformed"), F.lit(None).cast("string").alias("corrupt"))
    return good.unionByName(processed_rejects(spark, f"{base}/out").select(*_ZONE, *_said()))


SQL_NDJSON_PROCESSED = f"""
SELECT city, state, observed_at, temp_f, {_ODD_HUMIDITY} AS humidity_pct, year, month, day, hour, {_ODD_SAID} AS malformed, CAST(NULL AS VARCHAR) AS corrupt FROM ({_VALID_SQL})
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, year, month, day, hour, 'corrupt_record', {_BROKEN_SQL} FROM ({WEATHER_SQL}) WHERE event_id % 13 = 0
"""


def q_mixed_types(spark, sf):
    """Parquet files that hold a column as bigint, as double and as text (S4):
    what is read, and what does not fit."""
    base = work_dir(spark, "mixed-types")
    w = weather_rows(spark, sf)
    for i, humidity in enumerate((F.col("humidity_pct").cast("long"), _odd_humidity(), F.col("humidity_pct").cast("string"))):
        part = w.where(F.col("event_id") % 3 == (i + 1) % 3)
        rows = processed_from_raw(part, STAMP).drop("humidity_pct").join(
            part.select("city", "state", "observed_at", "temp_f", "lat", humidity.alias("humidity_pct")).distinct(), ["city", "state", "observed_at", "temp_f", "lat"])
        rows.hint("rebalance", *PARTITION_COLS).write.mode("append").partitionBy(*PARTITION_COLS).parquet(f"{base}/out")
    good = read_processed(spark, f"{base}/out", reconcile=True).select(*_ZONE, F.lit("").alias("malformed"))
    return good.unionByName(processed_rejects(spark, f"{base}/out", fmt="parquet").select(*_ZONE, _said()[0]))


SQL_MIXED_TYPES = f"""
SELECT city, state, observed_at, temp_f, CASE WHEN event_id % 10 <> 0 OR event_id % 3 <> 2 THEN humidity_pct END AS humidity_pct, year, month, day, hour,
       CASE WHEN event_id % 10 = 0 AND event_id % 3 = 2 THEN 'humidity_pct' ELSE '' END AS malformed FROM ({_VALID_SQL})
"""


# ---------------------------------------------------------------- catalog

def _table(prefix: str) -> str:
    return f"nimbus_{prefix}_{uuid.uuid4().hex[:12]}"


def _catalogued(spark, sf) -> str:
    """A registered zone that has moved on behind its catalog: the hours of
    day 3 are gone, those from day 20 on have come under padded names, and
    later files hold a column more. The catalog knows the rest."""
    base, name = work_dir(spark, "catalog"), _table("catalog")
    rows = processed_from_raw(weather_rows(spark, sf).drop("event_id"), STAMP)
    old = rows.where("day < 20").drop("wind_speed_ms")
    gone = write_partitions(old, f"{base}/out")
    register_table(spark, name, f"{base}/out", T.StructType([f for f in PROCESSED.fields if f.name != "wind_speed_ms"]))
    remove_hours(spark, f"{base}/out", [h for h in gone if h[2] == 3])
    padded = rows.where("day >= 20").withColumns({c: F.lpad(F.col(c).cast("string"), 2, "0") for c in ("month", "day", "hour")})
    padded.hint("rebalance", *PARTITION_COLS).write.mode("append").partitionBy(*PARTITION_COLS).parquet(f"{base}/out")
    return name


def q_catalog_diff(spark, sf):
    """Folders and catalog entries that differ."""
    return catalog_diff(spark, _catalogued(spark, sf)).select(*PARTITION_COLS, "status")


SQL_CATALOG_DIFF = f"""
SELECT year, month, day, hour, CASE WHEN day = 3 THEN 'vanished' ELSE 'new' END AS status FROM ({_VALID_SQL}) WHERE day = 3 OR day >= 20 GROUP BY ALL
"""


def q_catalog_repair(spark, sf):
    """The same table after its repair and a column added: read by the catalog."""
    name = _catalogued(spark, sf)
    root = table_root(spark, name)
    register_table(spark, name, root, PROCESSED)  # ADD COLUMNS
    reconcile_table(spark, name)
    return spark.table(name).select("city", "state", "observed_at", "temp_f", "wind_speed_ms", *PARTITION_COLS)


SQL_CATALOG_REPAIR = f"""
SELECT city, state, observed_at, temp_f, CASE WHEN day >= 20 THEN round(wind_speed_mph * 0.44704, 3) END AS wind_speed_ms, year, month, day, hour
FROM ({_VALID_SQL}) WHERE day <> 3
"""


def q_atomic_rerun(spark, sf):
    """Hours of a table replaced in two steps (S8): between them readers see
    every hour as it was, afterwards as it is."""
    base, name = work_dir(spark, "atomic"), _table("atomic")
    first, _ = (processed_from_raw(x.drop("event_id"), STAMP) for x in _halves(spark, sf))
    write_partitions(first, f"{base}/out")
    register_table(spark, name, f"{base}/out", PROCESSED)
    folder, hours = stage_hours(processed_from_raw(weather_rows(spark, sf).drop("event_id"), STAMP), name)
    cols = ["city", "state", "observed_at", "temp_f", *PARTITION_COLS]
    between = spark.table(name).select(F.lit("between").alias("step"), *cols).checkpoint()
    publish_hours(spark, name, folder, hours)
    spark.catalog.refreshTable(name)
    return between.unionByName(spark.table(name).select(F.lit("after").alias("step"), *cols))


SQL_ATOMIC_RERUN = f"""
SELECT 'between' AS step, city, state, observed_at, temp_f, year, month, day, hour FROM ({_VALID_SQL}) WHERE event_id % 3 <> 0
UNION ALL SELECT 'after', city, state, observed_at, temp_f, year, month, day, hour FROM ({_VALID_SQL})
"""


# ---------------------------------------------------------------- layers

def _registered_zone(spark, sf, base: str, rows: DataFrame) -> str:
    """``rows`` as a registered processed zone."""
    write_partitions(processed_from_raw(rows.drop("event_id"), STAMP, rules=[Rule("any", F.lit(True))]), f"{base}/out")
    name = _table("zone")
    register_table(spark, name, f"{base}/out", PROCESSED)
    return name


def _damaged(w: DataFrame) -> DataFrame:
    """Readings in which every kind of test fails somewhere (by the minute)."""
    minute = F.minute(F.col("observed_at").cast("timestamp"))
    return w.withColumns({
        "state": F.when(minute != 7, F.col("state")), "temp_f": F.when(minute % 11 != 0, F.col("temp_f")), "humidity_pct": F.when(minute != 13, F.col("humidity_pct")),
        "city": F.when(minute == 19, F.regexp_replace("city", "  ", " ")).otherwise(F.col("city")), "observed_at": F.when(minute != 17, F.col("observed_at"))})


_DAMAGED_SQL = f"""
SELECT * REPLACE (CASE WHEN minute(observed_at) <> 7 THEN state_code END AS state_code, CASE WHEN minute(observed_at) % 11 <> 0 THEN temp_f END AS temp_f,
                  CASE WHEN minute(observed_at) <> 13 THEN humidity_pct END AS humidity_pct,
                  CASE WHEN minute(observed_at) = 19 THEN replace(city_name, '  ', ' ') ELSE city_name END AS city_name,
                  CASE WHEN minute(observed_at) <> 17 THEN observed_at END AS observed_at, CASE WHEN minute(observed_at) <> 17 THEN observed_hour END AS observed_hour) FROM ({_STG_SQL})
"""


def q_marts_report(spark, sf):
    """Staging view and marts refreshed together, with the counts and the
    quality report taken from the rows as they are written (S10, S11, C13)."""
    base = work_dir(spark, "marts-report")
    zone, names = _registered_zone(spark, sf, base, _damaged(weather_rows(spark, sf))), [_table("staging"), _table("marts")]
    counts, report = refresh_layers(spark, zone, _STATES, [*_STATES, "MA"], *names, min_cities=15, as_of="2024-11-02 00:00:30", location=base)
    said = spark.createDataFrame([("counts", k, None, v) for k, v in counts.items()], "suite string, test string, column_name string, failures long")
    return report.unionByName(said)


SQL_MARTS_REPORT = (f"WITH s AS ({_DAMAGED_SQL}), c AS ({SQL_WEATHER_CURRENT.replace(_STG_SQL, 'SELECT * FROM s')}), h AS ({_sql_hourly(_DBT_METRICS, _DAMAGED_SQL)}) "
                    + " UNION ALL ".join([f"SELECT 'rows' AS suite, '{k}' AS test, CAST(NULL AS VARCHAR) AS column_name, {_sql_fails(p)} AS failures" for k, p in _QUALITY.items()]
                                         + [f"SELECT '{s}', '{t}', '{c}', ({q})" for s, t, c, q in _SUITES])
                    + """ UNION ALL SELECT 'coverage', 'missing_states', 'state_code', 1
UNION ALL SELECT 'coverage', 'unexpected_states', 'state_code', (SELECT count(DISTINCT state_code) FROM c WHERE state_code NOT IN ('CT', 'NJ', 'NY', 'MA'))
UNION ALL SELECT 'coverage', 'too_few_cities', 'city_name', 15 - (SELECT count(DISTINCT city_name) FROM c)
UNION ALL SELECT 'coverage', 'duplicate_slugs', NULL, (SELECT count(*) - count(DISTINCT lower(regexp_replace(city_name, '\\s+', '_', 'g')) || '_' || lower(state_code)) FROM c)
UNION ALL SELECT 'freshness', 'lag_minutes', 'observed_at', (SELECT CAST(floor(epoch_us(TIMESTAMP '2024-11-02 00:00:30') / 60000000.0 - epoch_us(max(observed_at)) / 60000000.0) AS BIGINT) FROM s)
UNION ALL SELECT 'counts', 'weather_current', NULL, (SELECT count(*) FROM c) UNION ALL SELECT 'counts', 'weather_hourly_summary', NULL, (SELECT count(*) FROM h)""")


def q_marts_switch(spark, sf):
    """Marts refreshed as one step (S11): what readers see after the new
    versions are written but before the switch, and after it."""
    base, schema = work_dir(spark, "marts-switch"), _table("marts")
    frames = []
    for rows in (_halves(spark, sf)[0], weather_rows(spark, sf)):
        stg = marts.stg_weather_raw(processed_from_raw(rows.drop("event_id"), STAMP))
        frames.append({"weather_current": marts.weather_current(stg), "weather_hourly_summary": marts.weather_hourly_summary(stg)})
    refresh_together(spark, schema, frames[0], f"{base}/marts")

    def seen(step: str) -> DataFrame:
        c, h = (current_mart(spark, schema, n) for n in ("weather_current", "weather_hourly_summary"))
        rows = c.select(F.lit("current").alias("mart"), "city_name", "state_code", F.col("observed_at").alias("at"), F.col("humidity_pct").cast("long").alias("n")).unionByName(
            h.select(F.lit("summary").alias("mart"), "city_name", "state_code", F.col("observed_hour").alias("at"), F.col("reading_count").alias("n")))
        return _ntz(rows.select(F.lit(step).alias("step"), "*")).checkpoint()

    version, _ = write_version(spark, schema, frames[1])
    between = seen("between")
    show_version(spark, schema, version, {n: df.columns for n, df in frames[1].items()})
    return between.unionByName(seen("after"))


def _sql_seen(step: str, where: str) -> str:
    stg = f"""SELECT city AS city_name, state AS state_code, seen AS observed_at, got AS fetched_at, date_trunc('hour', seen) AS observed_hour, humidity_pct
              FROM ({_VALID_SQL}) WHERE {where}"""
    return f"""
SELECT '{step}' AS step, 'current' AS mart, city_name, state_code, observed_at AS at, CAST(humidity_pct AS BIGINT) AS n FROM ({stg})
QUALIFY row_number() OVER (PARTITION BY city_name, state_code ORDER BY observed_at DESC, fetched_at DESC) = 1
UNION ALL SELECT '{step}', 'summary', city_name, state_code, observed_hour, count(*) FROM ({stg}) GROUP BY ALL"""


SQL_MARTS_SWITCH = f"{_sql_seen('between', 'event_id % 3 <> 0')} UNION ALL {_sql_seen('after', 'true')}"


def q_staging_view(spark, sf):
    """The staging layer as another session reads it (S10): a column that the
    zone's table does not have is NULL."""
    base, schema = work_dir(spark, "staging-view"), _table("staging")
    write_partitions(processed_from_raw(weather_rows(spark, sf).drop("event_id"), STAMP).drop("wind_gust_mph"), f"{base}/out")
    zone = _table("zone")
    register_table(spark, zone, f"{base}/out", T.StructType([f for f in PROCESSED.fields if f.name != "wind_gust_mph"]))
    staging_view(spark, zone, schema, location=f"{base}/staging")
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    return _ntz(other.table(f"{schema}.stg_weather_raw"))


SQL_STAGING_VIEW = f"""
SELECT city AS city_name, state AS state_code, country AS country_code, lat AS latitude, lon AS longitude,
       seen AS observed_at, got AS fetched_at, temp_f, feels_like_f, temp_min_f, temp_max_f, humidity_pct,
       pressure_hpa, 10000 AS visibility_m, wind_speed_mph, 180 AS wind_deg, CAST(NULL AS DOUBLE) AS wind_gust_mph, clouds_pct,
       condition_main, condition_description, '01d' AS condition_icon, date_trunc('hour', seen) AS observed_hour
FROM ({_VALID_SQL})
"""


def q_retention(spark, sf):
    """A registered zone after hours older than a date were dropped."""
    base = work_dir(spark, "retention")
    write_partitions(processed_from_raw(weather_rows(spark, sf).drop("event_id"), STAMP), f"{base}/out")
    name = f"nimbus_retention_{uuid.uuid4().hex[:12]}"
    register_table(spark, name, f"{base}/out", PROCESSED)
    try:
        expire_partitions(spark, name, "2024-07-01 00:00:00")
    finally:
        spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return read_processed(spark, f"{base}/out").select("city", "state", "observed_at", "temp_f", "year", "month", "day", "hour")


SQL_RETENTION = f"SELECT city, state, observed_at, temp_f, year, month, day, hour FROM ({_VALID_SQL}) WHERE land >= TIMESTAMP '2024-07-01 00:00:00'"


# ---------------------------------------------------------------- every branch of the rules

_CONDITIONS = ["Clear", "Clouds", "Rain", "Drizzle", "Thunderstorm", "Snow", "Mist", "Fog", None]


def q_advice_seasons(spark, sf):
    """Advice, notes and seasons over four seasons and all conditions."""
    w = weather_rows(spark, sf).withColumn("condition_main", F.element_at(F.array(*[F.lit(c) for c in _CONDITIONS]), (F.col("event_id") % 9 + 1).cast("int")))
    out = advice_columns(w.withColumn("seen", F.col("observed_at").cast("timestamp")), F.month("seen"))
    return out.select("event_id", "dress", "travel", "severity", "context_note", "season")


SQL_ADVICE_SEASONS = f"""
WITH w AS (SELECT * REPLACE (['Clear', 'Clouds', 'Rain', 'Drizzle', 'Thunderstorm', 'Snow', 'Mist', 'Fog', NULL][event_id % 9 + 1] AS condition_main) FROM ({WEATHER_SQL})),
s AS (SELECT *, CASE WHEN condition_main IN ('Thunderstorm', 'Snow') THEN 'severe'
  WHEN coalesce(condition_main IN ('Rain', 'Drizzle'), false) OR coalesce(wind_speed_mph > 25, false) OR coalesce(humidity_pct > 85 AND feels_like_f > 78, false) OR coalesce(feels_like_f < 40, false) THEN 'poor'
  ELSE 'ok' END AS severity FROM w)
SELECT event_id,
  CASE WHEN feels_like_f < 20 THEN 'Extreme cold — heavy parka, thermals, hat, gloves, and scarf essential.' WHEN feels_like_f < 32 THEN 'Heavy winter coat, warm hat, and gloves required.'
       WHEN feels_like_f < 45 THEN 'Warm jacket and layers recommended.' WHEN feels_like_f < 60 THEN 'Light-to-medium jacket advised.'
       WHEN feels_like_f < 75 THEN 'Comfortable light clothing — maybe a layer for the evening.' ELSE 'Light, breathable clothing; stay hydrated in the heat.' END AS dress,
  CASE WHEN condition_main = 'Thunderstorm' THEN 'Avoid outdoor travel — dangerous conditions.' WHEN condition_main = 'Snow' THEN 'Allow extra travel time; watch for icy roads.'
       WHEN condition_main IN ('Rain', 'Drizzle') THEN 'Bring an umbrella; good day for indoor plans.' WHEN wind_speed_mph > 25 THEN 'Very windy — secure loose items and expect delays.'
       WHEN condition_main = 'Clear' AND feels_like_f > 60 THEN 'Great day for outdoor activities or sightseeing.' WHEN condition_main = 'Clouds' THEN 'Overcast but manageable — outdoor plans should hold.'
       ELSE 'Conditions are reasonable — no special precautions needed.' END AS travel,
  severity,
  CASE WHEN severity = 'severe' THEN '⛔ Dangerous conditions — indoor only' WHEN severity = 'poor' AND condition_main IN ('Rain', 'Drizzle') THEN '🌂 Rainy — indoor options shown'
       WHEN severity = 'poor' AND wind_speed_mph > 25 THEN '💨 Very windy — indoor options shown' WHEN severity = 'poor' AND humidity_pct > 85 AND feels_like_f > 78 THEN '🥵 Muggy — indoor options shown'
       WHEN severity = 'poor' THEN '🧊 Cold — indoor options shown' END AS context_note,
  CASE WHEN month(seen) IN (12, 1, 2) THEN 'winter' WHEN month(seen) IN (3, 4, 5) THEN 'spring' WHEN month(seen) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season
FROM s
"""

# From January the 10th: to the days on which daylight time begins and ends, and to summer.
_SHIFTS = (0, 60, 182, 298)


def q_daylight_labels(spark, sf):
    """Labels in the display zone on both sides of daylight time (F16)."""
    ev = table(spark, sf, "events").select(F.explode(F.array(*[F.lit(d) for d in _SHIFTS])).alias("days"), "ts")
    hours = ev.select(F.date_trunc("hour", F.col("ts") + F.make_dt_interval(days=F.col("days"))).cast("timestamp_ntz").alias("observed_hour")).distinct()
    return hours.select("observed_hour", hour_label("observed_hour").alias("label"), as_of_label("observed_hour").alias("as_of"))


SQL_DAYLIGHT_LABELS = """
WITH h AS (SELECT DISTINCT date_trunc('hour', ts + to_days(CAST(d AS INTEGER))) AS observed_hour FROM events, (SELECT unnest([0, 60, 182, 298]) AS d)),
e AS (SELECT observed_hour, (observed_hour AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS here FROM h)
SELECT observed_hour, strftime(here, '%b %d, %I:%M %p ET') AS label, strftime(here, '%b %d, %Y %I:%M %p ET') AS as_of FROM e
"""


def q_ordered_views(spark, sf):
    """The order that views declare (O1, O2): each row's place as it comes out,
    within its city, the cities' places, and the places of the value counts."""
    stg = _stg(spark, sf).dropna(subset=["city_name", "state_code"])
    by = dashboard.detail(marts.weather_hourly_summary(stg)).withColumn("_at", F.monotonically_increasing_id())
    within = F.row_number().over(Window.partitionBy("City").orderBy("_at"))
    cities = by.groupBy("City").agg(F.min("_at").alias("_at")).select("City", F.row_number().over(Window.orderBy("_at")).alias("city_place"))
    # Of a city's hours, states share an hour: its place is the first one's.
    hours = by.withColumn("place", within).groupBy("City", "Hour").agg(F.min("place").alias("place")).join(cities, "City")
    counts = dashboard.condition_distribution(stg).withColumn("_at", F.monotonically_increasing_id())
    places = counts.select(F.lit("counts").alias("view"), F.col("Condition").alias("name"), F.lit(None).cast("timestamp").alias("hour"),
                           F.row_number().over(Window.orderBy("_at")).cast("long").alias("place"), F.col("Count").cast("long").alias("n"))
    return _ntz(hours.select(F.lit("detail").alias("view"), F.col("City").alias("name"), F.col("Hour").alias("hour"), F.col("place").cast("long").alias("place"), F.col("city_place").cast("long").alias("n")).unionByName(places))


SQL_ORDERED_VIEWS = f"""
WITH s AS (SELECT * FROM ({_STG_SQL}) WHERE city_name IS NOT NULL AND state_code IS NOT NULL),
g AS (SELECT DISTINCT city_name, state_code, observed_hour FROM s),
p AS (SELECT *, row_number() OVER (PARTITION BY city_name ORDER BY observed_hour) AS place FROM g),
c AS (SELECT city_name, row_number() OVER (ORDER BY city_name) AS n FROM (SELECT DISTINCT city_name FROM g)),
v AS (SELECT condition_main, count(*) AS n FROM s WHERE condition_main IS NOT NULL GROUP BY ALL)
SELECT 'detail' AS view, city_name AS name, observed_hour AS hour, min(place) AS place, any_value(c.n) AS n FROM p JOIN c USING (city_name) GROUP BY city_name, observed_hour
UNION ALL SELECT 'counts', condition_main, NULL, row_number() OVER (ORDER BY n, condition_main), n FROM v
"""


def q_empty_hours(spark, sf):
    """Hours with and without raw data (S14): processed, or refused."""
    base = work_dir(spark, "empty-hours")
    hours = _hours(_land(spark, sf, f"{base}/raw"))
    out = []
    for h in (hours[0], "1999-01-01T00", hours[-1], hours[-1][:-2] + "05"):
        try:
            r = process_hour(spark, f"{base}/raw", f"{base}/out", h, quarantine_root=f"{base}/bad", processed_at=STAMP)
            out.append((h, r.total, "processed"))
        except RuntimeError as exc:
            out.append((h, 0, str(exc)))
    return spark.createDataFrame(out, "run_hour string, total long, said string")


SQL_EMPTY_HOURS = f"""
WITH w AS ({WEATHER_SQL}), m AS (SELECT min(land) AS a, max(land) AS b FROM w)
SELECT strftime(land, '%Y-%m-%dT%H') AS run_hour, count(*) AS total, 'processed' AS said FROM w, m WHERE land IN (a, b) GROUP BY ALL
UNION ALL SELECT '1999-01-01T00', 0, 'No raw data to process for 1999-01-01T00'
UNION ALL SELECT strftime(b, '%Y-%m-%dT') || '05', 0, 'No raw data to process for ' || strftime(b, '%Y-%m-%dT') || '05' FROM m
"""


def q_keyed_source(spark, sf):
    """The Data Source with a partition for each key of a small dimension."""
    keys = [tuple(r) for r in table(spark, sf, "nation").select("n_nationkey", "n_name").collect()]
    name = register_keyed_source(spark, keys, "n_nationkey int, n_name string", _nation_answer, name="nimbus_nations")
    return spark.read.format(name).load().select("n_nationkey", "status", "error", "payload")


def _nation_answer(key: dict) -> dict | None:
    if key["n_nationkey"] % 5 == 0:
        raise KeyError(key["n_name"])
    return None if key["n_nationkey"] % 5 == 1 else {"name": key["n_name"], "n": key["n_nationkey"]}


SQL_KEYED_SOURCE = """
SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, CASE WHEN n_nationkey % 5 < 2 THEN 'error' ELSE 'ok' END AS status,
       CASE n_nationkey % 5 WHEN 0 THEN 'KeyError: ''' || n_name || '''' WHEN 1 THEN 'empty response' END AS error,
       CASE WHEN n_nationkey % 5 > 1 THEN '{"name": "' || n_name || '", "n": ' || n_nationkey || '}' END AS payload
FROM nation
"""


def _answer(key: dict) -> dict:
    """A transport in place of the API: some keys fail."""
    if key["c_custkey"] % 7 == 0:
        raise ValueError("no answer for " + "x" * (key["c_custkey"] % 1500))
    return {"name": key["c_name"], "n": key["c_custkey"]}


def q_keyed_collect(spark, sf):
    """A call for each key of a table, failures kept as rows."""
    keys = table(spark, sf, "customer").select("c_custkey", "c_name")
    return collect_keyed(keys, _answer).select("c_custkey", "status", "error", "payload")


SQL_KEYED_COLLECT = """
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN c_custkey % 7 = 0 THEN 'ValueError: no answer for ' || repeat('x', CAST(c_custkey % 1500 AS INTEGER)) END AS error,
       CASE WHEN c_custkey % 7 <> 0 THEN '{"name": "' || c_name || '", "n": ' || c_custkey || '}' END AS payload
FROM customer
"""

QUERIES = {
    "payload_scan": q_payload_scan, "mixed_json": q_mixed_json, "ndjson_processed": q_ndjson_processed,
    "retention": q_retention, "keyed_collect": q_keyed_collect,
    "stg_weather_raw": q_stg_weather_raw, "weather_current": q_weather_current, "weather_current_ties": q_weather_current_ties,
    "weather_hourly_dbt": _q_hourly("dbt"), "weather_hourly_sync": _q_hourly("sync"), "weather_hourly_raw": _q_hourly("raw"),
    "city_advice": q_city_advice, "snapshot_with_delta": q_snapshot_with_delta, "temperature_series": q_temperature_series,
    "weather_map": q_weather_map, "weather_quality": q_weather_quality, "process_hour_rejects": q_process_hour_rejects,
    "backfill_rejects": q_backfill_rejects, "stream_ingest_rejects": q_stream_ingest_rejects,
    "incremental_summary": q_incremental_summary, "late_window": q_late_window, "float_integers": q_float_integers,
    "process_hour_valid": q_process_hour_valid, "backfill_valid": q_backfill_valid, "backfill_zone": q_backfill_zone,
    "unannounced_summary": q_unannounced_summary, "mixed_types": q_mixed_types, "catalog_diff": q_catalog_diff,
    "catalog_repair": q_catalog_repair, "atomic_rerun": q_atomic_rerun,
    "advice_seasons": q_advice_seasons, "daylight_labels": q_daylight_labels, "ordered_views": q_ordered_views,
    "empty_hours": q_empty_hours, "keyed_source": q_keyed_source, "marts_report": q_marts_report, "marts_switch": q_marts_switch, "staging_view": q_staging_view,
    "padded_rerun": q_padded_rerun, "mixed_schema": q_mixed_schema, "aware_as_of": q_aware_as_of,
}
ORACLE_SQL = {
    "payload_scan": SQL_PAYLOAD_SCAN, "mixed_json": SQL_MIXED_JSON, "ndjson_processed": SQL_NDJSON_PROCESSED,
    "retention": SQL_RETENTION, "keyed_collect": SQL_KEYED_COLLECT,
    "stg_weather_raw": _STG_SQL, "weather_current": SQL_WEATHER_CURRENT, "weather_current_ties": SQL_WEATHER_CURRENT_TIES,
    "weather_hourly_dbt": _sql_hourly(_DBT_METRICS), "weather_hourly_sync": _sql_hourly(_SYNC_METRICS, drop_null=False),
    "weather_hourly_raw": _sql_hourly(_RAW_METRICS, drop_null=False), "city_advice": SQL_CITY_ADVICE,
    "snapshot_with_delta": SQL_SNAPSHOT_WITH_DELTA, "temperature_series": SQL_TEMPERATURE_SERIES, "weather_map": SQL_WEATHER_MAP,
    "weather_quality": SQL_WEATHER_QUALITY, "process_hour_rejects": SQL_PROCESS_HOUR_REJECTS,
    "backfill_rejects": _REJECTS_SQL, "stream_ingest_rejects": _REJECTS_SQL,
    "incremental_summary": _sql_hourly(_DBT_METRICS, _VALID_STG_SQL), "late_window": SQL_LATE_WINDOW,
    "process_hour_valid": SQL_PROCESS_HOUR_VALID, "backfill_valid": SQL_BACKFILL_VALID, "backfill_zone": SQL_BACKFILL_VALID,
    "unannounced_summary": _sql_hourly(_DBT_METRICS, _UNANNOUNCED_SQL), "mixed_types": SQL_MIXED_TYPES, "catalog_diff": SQL_CATALOG_DIFF,
    "catalog_repair": SQL_CATALOG_REPAIR, "atomic_rerun": SQL_ATOMIC_RERUN,
    "advice_seasons": SQL_ADVICE_SEASONS, "daylight_labels": SQL_DAYLIGHT_LABELS, "ordered_views": SQL_ORDERED_VIEWS,
    "empty_hours": SQL_EMPTY_HOURS, "keyed_source": SQL_KEYED_SOURCE, "marts_report": SQL_MARTS_REPORT, "marts_switch": SQL_MARTS_SWITCH, "staging_view": SQL_STAGING_VIEW,
    "float_integers": SQL_FLOAT_INTEGERS, "padded_rerun": SQL_PADDED_RERUN, "mixed_schema": SQL_MIXED_SCHEMA,
    "aware_as_of": SQL_AWARE_AS_OF,
}
