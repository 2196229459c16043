"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads whole tables (or data Spark derives from them) and runs
the library operators; nothing is capped or sampled except ``sample_limit``
whose limit is the feature. Means use exact integer-unit sums and
the same floor-based half-away-from-zero rounding on both sides so values
match bit for bit
(see ``nimbus.functions.exact``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.functions import advice as adv
from nimbus.functions import exact, geo, text, timefn, units
from nimbus.operators import filters, latest, quality, reshape, snapshot, summary, validate, views
from nimbus.operators.enrich import enrich
from nimbus.operators.summary import Metric
from nimbus.plans import io_queries, stream_queries, weather_queries
from nimbus.plans.standins import K_SQL, READINGS_SQL, events_k, readings, table

Query = Callable[[SparkSession, str], DataFrame]

PROCESSED_AT = "2024-01-31T00:00:00+00:00"

# ---------------------------------------------------------------------------
# helpers shared by Spark and SQL sides
# ---------------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_double(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _sql_units_sum(c: str) -> str:
    return f"sum(CAST(round({c} * 100) AS BIGINT))"


def _sql_round_mean(c: str, digits: int = 2) -> str:
    step = 10 ** (2 - digits)
    mean = f"CAST({_sql_units_sum(c)} AS DOUBLE) / (count({c}) * {step})"
    return f"{exact.sql_half_away(mean)} / {10 ** digits}"


def _sql_mean(c: str) -> str:
    return f"CAST({_sql_units_sum(c)} AS DOUBLE) / (count({c}) * 100)"


def _hour(df: DataFrame, ts: str = "ts") -> F.Column:
    return summary.time_bucket(ts, "hour", df)


def _event_rules() -> list[validate.Rule]:
    """Ingest rules mapped onto ``events``: required fields, temperature
    range on ``value``, humidity range on ``props.k``."""
    return validate.ingest_rules(
        required=("event_id", "ts", "user_id", "event_type", "value"),
        temp="value", humidity="k", pressure=None, wind=None)


_EVENT_REQUIRED = ("event_id", "ts", "user_id", "event_type", "value")


def _sql_event_reasons() -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN 'missing:{c}' END" for c in _EVENT_REQUIRED]
    lo, hi = validate.INGEST_TEMP
    parts.append(f"CASE WHEN NOT coalesce(value BETWEEN {lo} AND {hi} AND NOT isnan(value), false)"
                 f" THEN 'range:value' END")
    lo, hi = validate.INGEST_HUMIDITY
    parts.append(f"CASE WHEN NOT coalesce(k BETWEEN {lo} AND {hi}, false) THEN 'range:k' END")
    return "concat_ws(',', " + ", ".join(parts) + ")"


EVENTS_K_SQL = f"SELECT *, {K_SQL} AS k FROM events"

# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------

_EVENT_METRICS = [
    Metric("avg_value", "exact_avg", "value", 2, scale=2),
    Metric("min_value", "min", "value"),
    Metric("max_value", "max", "value"),
]


def q_hourly_summary(spark, sf):
    ev = table(spark, sf, "events")
    return summary.hourly_summary(ev, keys=["user_id"], ts="ts", metrics=_EVENT_METRICS,
                                  label="event_type", label_col="dominant_type",
                                  bucket_col="observed_hour", profile="dbt")


SQL_HOURLY_SUMMARY = f"""
WITH base AS (
  SELECT user_id, date_trunc('hour', ts) AS observed_hour, value, event_type
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
cc AS (
  SELECT user_id, observed_hour, event_type, count(*) AS n FROM base
  WHERE event_type IS NOT NULL GROUP BY user_id, observed_hour, event_type),
dom AS (
  SELECT user_id, observed_hour, event_type AS dominant_type FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, observed_hour
                                 ORDER BY n DESC, event_type ASC) AS rn FROM cc) WHERE rn = 1)
SELECT b.user_id, b.observed_hour, {_sql_round_mean('b.value')} AS avg_value,
       min(b.value) AS min_value, max(b.value) AS max_value,
       d.dominant_type, count(*) AS reading_count
FROM base b JOIN dom d ON b.user_id = d.user_id AND b.observed_hour = d.observed_hour
GROUP BY b.user_id, b.observed_hour, d.dominant_type
"""


def q_daily_summary_raw(spark, sf):
    ev = table(spark, sf, "events")
    metrics = [Metric("min_value", "min", "value"),
               Metric("avg_value", "exact_avg", "value", None, scale=2),
               Metric("max_value", "max", "value")]
    return summary.hourly_summary(ev, keys=["user_id"], ts="ts", metrics=metrics,
                                  label="event_type", label_col="dominant_type",
                                  bucket_col="observed_day", grain="day", profile="raw")


SQL_DAILY_SUMMARY_RAW = f"""
WITH base AS (SELECT user_id, date_trunc('day', ts) AS observed_day, value, event_type FROM events),
cc AS (SELECT user_id, observed_day, event_type, count(*) AS n FROM base
       WHERE event_type IS NOT NULL GROUP BY ALL),
dom AS (SELECT user_id, observed_day, event_type AS dominant_type FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, observed_day
                                       ORDER BY n DESC, event_type ASC) AS rn FROM cc) WHERE rn = 1),
agg AS (SELECT user_id, observed_day, min(value) AS min_value, {_sql_mean('value')} AS avg_value,
               max(value) AS max_value, count(*) AS reading_count FROM base GROUP BY ALL)
SELECT a.user_id, a.observed_day, a.min_value, a.avg_value, a.max_value, d.dominant_type,
       a.reading_count
FROM agg a LEFT JOIN dom d ON a.user_id IS NOT DISTINCT FROM d.user_id
                           AND a.observed_day IS NOT DISTINCT FROM d.observed_day
"""


def q_latest_per_user(spark, sf):
    ev = table(spark, sf, "events")
    out = latest.latest_per_key(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return out.select("user_id", "ts", "event_id", "event_type", "value")


SQL_LATEST_PER_USER = """
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
"""


def q_latest_keep_ties(spark, sf):
    o = table(spark, sf, "orders")
    out = latest.latest_per_key(o, ["o_custkey"], ["o_orderdate"], keep_ties=True)
    return out.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")


SQL_LATEST_KEEP_TIES = """
WITH latest AS (
  SELECT o_custkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rn
  FROM orders)
SELECT o.o_custkey, o.o_orderdate, o.o_orderkey, o.o_orderstatus
FROM orders o JOIN latest l ON o.o_custkey = l.o_custkey AND o.o_orderdate = l.o_orderdate
WHERE l.rn = 1
"""


def _current(spark, sf) -> DataFrame:
    """Latest reading per city and state. A city's newest reading is the newest
    of one of its users, so events shrink to a row a user before any join."""
    newest = latest.latest_per_key(events_k(spark, sf), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return latest.latest_per_key(readings(spark, sf, newest), ["city_name", "state_code"],
                                 [F.col("observed_at").desc(), F.col("event_id").desc()])


def q_current_readings(spark, sf):
    return _current(spark, sf).select("city_name", "state_code", "country_code", "observed_at", "temp_f",
                      "humidity_pct", "condition_main", "condition_description")


SQL_CURRENT_READINGS = f"""
WITH r AS ({READINGS_SQL})
SELECT city_name, state_code, country_code, observed_at, temp_f, humidity_pct,
       condition_main, condition_description FROM (
  SELECT *, row_number() OVER (PARTITION BY city_name, state_code
                               ORDER BY observed_at DESC, event_id DESC) AS rn FROM r)
WHERE rn = 1
"""


def q_dominant_type(spark, sf):
    ev = table(spark, sf, "events")
    return summary.dominant_label(ev, ["user_id"], "event_type", "dominant_type", "type_count")


SQL_DOMINANT_TYPE = """
WITH cc AS (SELECT user_id, event_type, count(*) AS n FROM events
            WHERE event_type IS NOT NULL GROUP BY user_id, event_type)
SELECT user_id, event_type AS dominant_type, n AS type_count FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type ASC) AS rn
  FROM cc) WHERE rn = 1
"""


def q_validate_split_counts(spark, sf):
    return validate.split_counts(events_k(spark, sf), _event_rules())


SQL_VALIDATE_SPLIT_COUNTS = f"""
WITH v AS (SELECT {_sql_event_reasons()} = '' AS ok FROM ({EVENTS_K_SQL}))
SELECT count(*) AS total_count, CAST(count_if(ok) AS BIGINT) AS valid_count,
       CAST(count_if(NOT ok) AS BIGINT) AS invalid_count
FROM v
"""


def q_valid_rows(spark, sf):
    valid, _ = validate.split(events_k(spark, sf), _event_rules())
    return valid.select("event_id", "user_id", "ts", "value", "k")


SQL_VALID_ROWS = f"""
SELECT event_id, user_id, ts, value, k FROM ({EVENTS_K_SQL})
WHERE {_sql_event_reasons()} = ''
"""


def q_rejected_rows(spark, sf):
    _, invalid = validate.split(events_k(spark, sf), _event_rules())
    return invalid.select("event_id", "value", "k",
                          validate.reason_text(",").alias("reject_reason"))


SQL_REJECTED_ROWS = f"""
SELECT event_id, value, k, reason AS reject_reason FROM (
  SELECT *, {_sql_event_reasons()} AS reason FROM ({EVENTS_K_SQL})) WHERE reason <> ''
"""


def q_enriched(spark, sf):
    r = readings(spark, sf)
    rules = validate.ingest_rules(
        required=("event_id", "city_name", "state_code", "observed_at", "temp_f"),
        temp="temp_f", humidity="humidity_pct", pressure=None, wind="wind_speed_mph")
    valid, _ = validate.split(r, rules)
    out = enrich_readings(valid)
    return out.select("event_id", "city_slug", "temp_c", "feels_like_c", "wind_speed_ms")


def enrich_readings(valid: DataFrame) -> DataFrame:
    return enrich(valid, processed_at=PROCESSED_AT, city="city_name", state="state_code")


SQL_ENRICHED = f"""
WITH r AS ({READINGS_SQL})
SELECT event_id,
       concat_ws('_', lower(regexp_replace(city_name, '\\s+', '_', 'g')), lower(state_code)) AS city_slug,
       round((temp_f - 32) * 5 / 9, {units.TEMP_DIGITS}) AS temp_c,
       round((feels_like_f - 32) * 5 / 9, {units.TEMP_DIGITS}) AS feels_like_c,
       round(wind_speed_mph * {units.MPH_TO_MS}, {units.WIND_DIGITS}) AS wind_speed_ms
FROM r
WHERE event_id IS NOT NULL AND city_name IS NOT NULL AND state_code IS NOT NULL
  AND observed_at IS NOT NULL AND temp_f IS NOT NULL
  AND coalesce(temp_f BETWEEN -100 AND 150 AND NOT isnan(temp_f), false)
  AND coalesce(humidity_pct BETWEEN 0 AND 100, false)
  AND coalesce(wind_speed_mph >= 0 AND NOT isnan(wind_speed_mph), false)
"""


def q_props_json(spark, sf):
    ev = events_k(spark, sf)
    return ev.select("event_id", "k", F.to_json(F.struct(
        F.col("event_id").alias("id"), F.col("event_type").alias("type"), "k")).alias("payload"))


SQL_PROPS_JSON = f"""
SELECT event_id, k, to_json({{'id': event_id, 'type': event_type, 'k': k}})::VARCHAR AS payload
FROM ({EVENTS_K_SQL})
"""


def q_staged(spark, sf):
    ev = events_k(spark, sf)
    return ev.select(
        "event_id", "user_id", F.col("ts").alias("observed_at"),
        timefn.hour_floor("ts", ntz=True).alias("observed_hour"),
        F.col("value").cast("double").alias("temp_f"),
        F.col("k").alias("humidity_pct"),
        F.col("event_type").alias("condition_main"))


SQL_STAGED = f"""
SELECT event_id, user_id, ts AS observed_at, date_trunc('hour', ts) AS observed_hour,
       CAST(value AS DOUBLE) AS temp_f, {K_SQL} AS humidity_pct, event_type AS condition_main
FROM events
"""


def q_trailing_24h(spark, sf):
    ev = table(spark, sf, "events")
    return filters.trailing_window(ev, "ts", hours=24).select("event_id", "ts", "user_id", "value")


SQL_TRAILING_24H = """
SELECT event_id, ts, user_id, value FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS
"""


def q_hour_slice(spark, sf):
    ev = table(spark, sf, "events")
    return filters.hour_slice(ev, "ts").select("event_id", "ts", "user_id", "value")


SQL_HOUR_SLICE = """
WITH h AS (SELECT date_trunc('hour', max(ts)) AS h FROM events)
SELECT event_id, ts, user_id, value FROM events, h
WHERE ts >= h.h AND ts < h.h + INTERVAL 1 HOUR
"""

IN_LIST_TYPES = ["click", "purchase"]


def q_in_list(spark, sf):
    ev = table(spark, sf, "events")
    return filters.filter_in(ev, "event_type", IN_LIST_TYPES).select("event_id", "event_type",
                                                                    "value")


SQL_IN_LIST = f"""
SELECT event_id, event_type, value FROM events
WHERE event_type IN ({', '.join(_q(t) for t in IN_LIST_TYPES)})
"""


def q_value_counts(spark, sf):
    return summary.value_counts(table(spark, sf, "events"), "event_type", "event_count")


SQL_VALUE_COUNTS = """
SELECT event_type, count(*) AS event_count FROM events WHERE event_type IS NOT NULL
GROUP BY event_type
"""


def q_regional_snapshot(spark, sf):
    ev = table(spark, sf, "events")
    return snapshot.regional_snapshot(ev, "ts", "value", "user_id", per_hour=True, scale=2)


SQL_REGIONAL_SNAPSHOT = f"""
WITH b AS (SELECT date_trunc('hour', ts) AS observed_hour, value, user_id FROM events),
a AS (SELECT observed_hour, max(value) AS max_value, min(value) AS min_value,
             {_sql_mean('value')} AS avg_value, count(value) AS reading_count
      FROM b GROUP BY observed_hour)
SELECT a.observed_hour, a.max_value,
       (SELECT min(user_id) FROM b WHERE b.observed_hour = a.observed_hour
                                     AND b.value = a.max_value) AS max_name,
       a.min_value,
       (SELECT min(user_id) FROM b WHERE b.observed_hour = a.observed_hour
                                     AND b.value = a.min_value) AS min_name,
       a.avg_value, a.reading_count
FROM a
"""


def q_hour_over_hour(spark, sf):
    ev = table(spark, sf, "events")
    return snapshot.hour_over_hour(ev, ["user_id"], "ts", "value", digits=1, key_digits=2,
                                   scale=2)


SQL_HOUR_OVER_HOUR = f"""
WITH pk AS (
  SELECT user_id, date_trunc('hour', ts) AS observed_hour,
         sum(CAST(round(value * 100) AS BIGINT)) AS s, count(value) AS n
  FROM events WHERE value IS NOT NULL GROUP BY user_id, observed_hour),
ph AS (
  SELECT observed_hour, sum(s) AS s_all, sum(n) AS n_all,
         sum({exact.sql_half_away("CAST(s AS DOUBLE) / (n * 1)")}) AS k_all, count(*) AS m
  FROM pk GROUP BY observed_hour),
h AS (
  SELECT observed_hour, CAST(s_all AS DOUBLE) / (n_all * 100) AS now_v,
         CAST(k_all AS DOUBLE) / (m * 100) AS km,
         {exact.sql_half_away("CAST(s_all AS DOUBLE) / (n_all * 1)")} / 100 AS hour_avg
  FROM ph)
SELECT observed_hour, hour_avg,
       lag(observed_hour) OVER (ORDER BY observed_hour) AS prev_hour,
       {exact.sql_half_away("(now_v - lag(km) OVER (ORDER BY observed_hour)) * 10")} / 10 AS hour_delta
FROM h
"""


def q_one_decimal(spark, sf):
    """The printed form of every event's value."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", text.one_decimal("value").alias("plain"),
                     text.signed_one_decimal(F.col("value") / 8 - 30).alias("signed"))


SQL_ONE_DECIMAL = "SELECT event_id, printf('%.1f', value) AS plain, printf('%+.1f', value / 8 - 30) AS signed FROM events"


def q_series_long(spark, sf):
    ev = events_k(spark, sf)
    return reshape.series_long(ev, ["event_id", "user_id", "ts"],
                               {"value": "temp", "k": "humidity"}, "metric", "reading")


SQL_SERIES_LONG = f"""
SELECT event_id, user_id, ts, 'temp' AS metric, CAST(value AS DOUBLE) AS reading FROM events
UNION ALL
SELECT event_id, user_id, ts, 'humidity' AS metric, CAST({K_SQL} AS DOUBLE) AS reading FROM events
"""


def _hourly_cents(spark, sf) -> DataFrame:
    """Per (user, hour): min / rounded-mean / max of ``value`` in exact cents."""
    ev = table(spark, sf, "events")
    return (ev.filter(F.col("value").isNotNull())
              .groupBy("user_id", _hour(ev).alias("observed_hour"))
              .agg(F.min(exact.units("value", 2)).alias("min_c"),
                   exact.round_units_mean_units(exact.sum_units("value", 2), F.count("value"), 2, 2)
                    .alias("avg_c"),
                   F.max(exact.units("value", 2)).alias("max_c")))


_HOURLY_CENTS_SQL = f"""
SELECT user_id, date_trunc('hour', ts) AS observed_hour,
       min(CAST(round(value * 100) AS BIGINT)) AS min_c,
       {exact.sql_half_away("CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / (count(value) * 1)")} AS avg_c,
       max(CAST(round(value * 100) AS BIGINT)) AS max_c
FROM events WHERE value IS NOT NULL GROUP BY user_id, observed_hour
"""

_RANGE_NAMES = ("min_v", "q1", "median", "q3", "max_v")


def q_range_summary_hot(spark, sf):
    """Exact quantiles where one key holds a third of the rows, ordered in pieces."""
    ev = table(spark, sf, "events").withColumns({"k": F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise((F.col("user_id") % 50).cast("int")),
                                                 "cents": F.round(F.col("value") * 100), "again": F.round(F.col("value") * 10)})
    rs = views.range_summary(ev, "k", ["cents", "again"], names=_RANGE_NAMES, hot_rows=300)
    return rs.select("k", *[(F.col(n) / 100).alias(n) for n in _RANGE_NAMES])


SQL_RANGE_SUMMARY_HOT = """
WITH e AS (SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE CAST(user_id % 50 AS INTEGER) END AS k, round(value * 100) AS c, round(value * 10) AS d FROM events),
l AS (SELECT k, c AS v FROM e UNION ALL SELECT k, d FROM e)
SELECT k, quantile_cont(v, 0.0) / 100 AS min_v, quantile_cont(v, 0.25) / 100 AS q1, quantile_cont(v, 0.5) / 100 AS median,
       quantile_cont(v, 0.75) / 100 AS q3, quantile_cont(v, 1.0) / 100 AS max_v
FROM l GROUP BY k
"""


def q_range_summary(spark, sf):
    rs = views.range_summary(_hourly_cents(spark, sf), "user_id", ["min_c", "avg_c", "max_c"],
                             names=_RANGE_NAMES)
    return rs.select("user_id", *[(F.col(n) / 100).alias(n) for n in _RANGE_NAMES])


SQL_RANGE_SUMMARY = f"""
WITH h AS ({_HOURLY_CENTS_SQL}),
l AS (SELECT user_id, CAST(min_c AS DOUBLE) AS v FROM h
      UNION ALL SELECT user_id, CAST(avg_c AS DOUBLE) FROM h
      UNION ALL SELECT user_id, CAST(max_c AS DOUBLE) FROM h)
SELECT user_id,
       quantile_cont(v, 0.0) / 100 AS min_v, quantile_cont(v, 0.25) / 100 AS q1,
       quantile_cont(v, 0.5) / 100 AS median, quantile_cont(v, 0.75) / 100 AS q3,
       quantile_cont(v, 1.0) / 100 AS max_v
FROM l GROUP BY user_id
"""


def q_mean_order(spark, sf):
    m = summary.mean_order(_hourly_cents(spark, sf), "user_id", "avg_c", out="mean_c")
    return m.select("user_id", (F.col("mean_c") / 100).alias("mean_value"))


SQL_MEAN_ORDER = f"""
WITH h AS ({_HOURLY_CENTS_SQL})
SELECT user_id, avg(avg_c) / 100 AS mean_value FROM h GROUP BY user_id
"""


def q_dimension_default(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"))
    return views.lookup_with_default(cust, counts, "c_custkey", "o_custkey", "n_orders", 0)


SQL_DIMENSION_DEFAULT = """
SELECT c.c_custkey, c.c_name, c.c_nationkey, coalesce(o.n_orders, 0) AS n_orders
FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) o
  ON c.c_custkey = o.o_custkey
"""


def q_first_k_per_group(spark, sf):
    ev = table(spark, sf, "events")
    out = latest.first_k_per_group(ev, "user_id", ["ts", "event_id"], 2, "rank")
    return out.select("user_id", F.col("rank").cast("bigint").alias("rank"), "event_id",
                      "event_type")


SQL_FIRST_K_PER_GROUP = """
SELECT user_id, rank, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rank FROM events)
WHERE rank <= 2
"""

POP_PER_ORDER = 10000


def _order_populations(spark, sf) -> DataFrame:
    """Population stand-in per customer: 10 000 per order placed."""
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        (F.count(F.lit(1)) * POP_PER_ORDER).alias("population"))


def q_map_layer(spark, sf):
    ev = table(spark, sf, "events")
    out = views.map_layer(ev, _order_populations(spark, sf), city="user_id", temp="value",
                          pop_city="o_custkey", pop="population")
    return out.select("event_id", "population", "color_r", "color_g", "color_b", "alpha",
                      "radius")


def _sql_channel(t: str, j: int) -> str:
    lo_t, lo_c = geo.TEMP_ANCHORS[0]
    hi_t, hi_c = geo.TEMP_ANCHORS[-1]
    parts = [f"WHEN {t} <= {lo_t} THEN {lo_c[j]}", f"WHEN {t} >= {hi_t} THEN {hi_c[j]}"]
    for (t0, c0), (t1, c1) in zip(geo.TEMP_ANCHORS, geo.TEMP_ANCHORS[1:]):
        parts.append(f"WHEN {t} <= {t1} THEN "
                     f"CAST(trunc({c0[j]} + (({t} - {t0}) / {t1 - t0}) * {c1[j] - c0[j]}) AS INTEGER)")
    return "CASE " + " ".join(parts) + f" ELSE {hi_c[j]} END"


SQL_MAP_LAYER = f"""
WITH p AS (SELECT o_custkey, count(*) * {POP_PER_ORDER} AS population FROM orders GROUP BY o_custkey),
m AS (SELECT e.event_id, e.value AS t, coalesce(p.population, 100000) AS population
      FROM events e LEFT JOIN p ON e.user_id = p.o_custkey),
s AS (SELECT *, least(1.0, greatest(0.0,
        (log10(CAST(population AS DOUBLE)) - {_sql_double(geo.LOG_POP_MIN)})
        / {_sql_double(geo.LOG_POP_MAX - geo.LOG_POP_MIN)})) AS pt FROM m)
SELECT event_id, population,
       {_sql_channel('t', 0)} AS color_r, {_sql_channel('t', 1)} AS color_g,
       {_sql_channel('t', 2)} AS color_b,
       CAST(trunc({geo.ALPHA_BASE} + pt * {geo.ALPHA_BOOST}) AS INTEGER) AS alpha,
       CAST(trunc({geo.RADIUS_BASE} + pt * {geo.RADIUS_BOOST}) AS INTEGER) AS radius
FROM s
"""


def q_advice_bands(spark, sf):
    r = readings(spark, sf)
    out = views.advice_columns(r, F.month("observed_at"))
    return out.select("event_id", "dress", "travel", "severity", "context_note", "season")


def _sql_dress(fl: str) -> str:
    parts = [f"WHEN {fl} < {lim} THEN {_q(txt)}" for lim, txt in adv.DRESS_BANDS]
    return "CASE " + " ".join(parts) + f" ELSE {_q(adv.DRESS_HOT)} END"


def _sql_wet(c: str) -> str:
    return f"{c} IN ({', '.join(_q(x) for x in adv.WET_CONDITIONS)})"


def _sql_muggy(h: str, fl: str) -> str:
    return f"({h} > {adv.MUGGY_HUMIDITY} AND {fl} > {adv.MUGGY_FEELS_LIKE})"


SQL_ADVICE_BANDS = f"""
WITH r AS ({READINGS_SQL}),
s AS (
  SELECT *,
    CASE WHEN condition_main IN ({', '.join(_q(x) for x in adv.SEVERE_CONDITIONS)}) THEN 'severe'
         WHEN coalesce({_sql_wet('condition_main')} OR wind_speed_mph > {adv.WINDY_MPH}
                       OR {_sql_muggy('humidity_pct', 'feels_like_f')}
                       OR feels_like_f < {adv.COLD_FEELS_LIKE}, false) THEN 'poor'
         ELSE 'ok' END AS severity
  FROM r)
SELECT event_id,
  {_sql_dress('feels_like_f')} AS dress,
  CASE WHEN condition_main = 'Thunderstorm' THEN {_q(adv.TRAVEL_STORM)}
       WHEN condition_main = 'Snow' THEN {_q(adv.TRAVEL_SNOW)}
       WHEN {_sql_wet('condition_main')} THEN {_q(adv.TRAVEL_RAIN)}
       WHEN wind_speed_mph > {adv.WINDY_MPH} THEN {_q(adv.TRAVEL_WIND)}
       WHEN condition_main = 'Clear' AND feels_like_f > {adv.CLEAR_WARM_FEELS_LIKE}
            THEN {_q(adv.TRAVEL_CLEAR)}
       WHEN condition_main = 'Clouds' THEN {_q(adv.TRAVEL_CLOUDS)}
       ELSE {_q(adv.TRAVEL_DEFAULT)} END AS travel,
  severity,
  CASE WHEN severity = 'severe' THEN {_q(adv.NOTE_SEVERE)}
       WHEN severity = 'poor' AND {_sql_wet('condition_main')} THEN {_q(adv.NOTE_RAIN)}
       WHEN severity = 'poor' AND wind_speed_mph > {adv.WINDY_MPH} THEN {_q(adv.NOTE_WIND)}
       WHEN severity = 'poor' AND {_sql_muggy('humidity_pct', 'feels_like_f')}
            THEN {_q(adv.NOTE_MUGGY)}
       WHEN severity = 'poor' THEN {_q(adv.NOTE_COLD)} END AS context_note,
  CASE WHEN month(observed_at) IN (12, 1, 2) THEN 'winter'
       WHEN month(observed_at) IN (3, 4, 5) THEN 'spring'
       WHEN month(observed_at) IN (6, 7, 8) THEN 'summer'
       WHEN month(observed_at) IN (9, 10, 11) THEN 'fall' END AS season
FROM s
"""


def q_current_cards(spark, sf):
    return views.current_cards(_current(spark, sf))


SQL_CURRENT_CARDS = f"""
WITH r AS ({READINGS_SQL}),
c AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY city_name, state_code
                                     ORDER BY observed_at DESC, event_id DESC) AS rn FROM r)
      WHERE rn = 1)
SELECT concat_ws(', ', city_name, state_code) AS title,
       concat_ws(' ', coalesce(CASE condition_main
           {' '.join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in text.CONDITION_ICONS.items())}
           END, {_q(text.DEFAULT_ICON)}),
         coalesce(initcap_s, {_q(text.MISSING_TEXT)})) AS label,
       printf('%.1f', temp_f) || ' °F' AS value,
       'Feels ' || printf('%.1f', feels_like_f) || ' °F' AS delta,
       'Humidity ' || printf('%.0f', CAST(humidity_pct AS DOUBLE)) || '%  |  Wind '
         || printf('%.1f', wind_speed_mph) || ' mph  |  Clouds '
         || printf('%.0f', CAST(clouds_pct AS DOUBLE)) || '%' AS caption,
       city_name, state_code
FROM (SELECT *, upper(substr(condition_description, 1, 1))
                || lower(substr(condition_description, 2)) AS initcap_s FROM c)
"""


def q_et_labels(spark, sf):
    ev = table(spark, sf, "events")
    hours = ev.select(timefn.hour_floor("ts", ntz=True).alias("observed_hour")).distinct()
    return hours.withColumn("label", timefn.hour_label("observed_hour"))


SQL_ET_LABELS = """
SELECT observed_hour,
       strftime((observed_hour AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York',
                '%b %d, %I:%M %p ET') AS label
FROM (SELECT DISTINCT date_trunc('hour', ts) AS observed_hour FROM events)
"""


def _event_quality_rules() -> list[validate.Rule]:
    return validate.quality_rules(
        temp="temp_f", feels_like="feels_like_f", temp_min=None, temp_max=None,
        humidity="humidity_pct", pressure=None, wind="wind_speed_mph", clouds="clouds_pct",
        observed=None, fetched=None, lat=None, lon=None, condition="condition_main",
        state=None)


def q_quality_report(spark, sf):
    return quality.rule_failures(readings(spark, sf), _event_quality_rules())


def _sql_fail(pred: str) -> str:
    return f"CAST(count_if(NOT coalesce({pred}, false)) AS BIGINT)"


SQL_QUALITY_REPORT = f"""
WITH r AS ({READINGS_SQL})
SELECT rule, failed_count, total_count FROM (
  SELECT {_sql_fail(f"temp_f BETWEEN {validate.QUALITY_TEMP[0]} AND {validate.QUALITY_TEMP[1]} AND NOT isnan(temp_f)")} AS temp_realistic,
         {_sql_fail(f"abs(feels_like_f - temp_f) < {validate.QUALITY_FEELS_LIKE_GAP}")} AS feels_like_near_temp,
         {_sql_fail("humidity_pct BETWEEN 0 AND 100")} AS humidity_range,
         {_sql_fail("wind_speed_mph >= 0 AND NOT isnan(wind_speed_mph)")} AS wind_non_negative,
         {_sql_fail("clouds_pct BETWEEN 0 AND 100")} AS clouds_range,
         {_sql_fail("trim(condition_main) <> ''")} AS condition_not_blank,
         count(*) AS total_count
  FROM r)
UNPIVOT (failed_count FOR rule IN (temp_realistic, feels_like_near_temp, humidity_range,
                                   wind_non_negative, clouds_range, condition_not_blank))
"""

MODEL_TESTS = [
    ("not_null", "city_name"),
    ("not_null", "temp_f"),
    ("unique", "event_id"),
    ("unique", "city_name"),
    ("accepted_values", "country_code", ["AFRICA", "AMERICA", "ASIA", "EUROPE"]),
    ("accepted_range", "humidity_pct", (0, 100)),
]


def q_model_tests(spark, sf):
    return quality.model_tests(readings(spark, sf), MODEL_TESTS)


SQL_MODEL_TESTS = f"""
WITH r AS ({READINGS_SQL})
SELECT 'not_null' AS test, 'city_name' AS column_name, CAST(count_if(city_name IS NULL) AS BIGINT) AS failures FROM r
UNION ALL SELECT 'not_null', 'temp_f', CAST(count_if(temp_f IS NULL) AS BIGINT) FROM r
UNION ALL SELECT 'accepted_values', 'country_code',
   CAST(count_if(country_code IS NOT NULL AND country_code NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')) AS BIGINT) FROM r
UNION ALL SELECT 'accepted_range', 'humidity_pct',
   CAST(count_if(humidity_pct IS NOT NULL AND (humidity_pct < 0 OR humidity_pct > 100)) AS BIGINT) FROM r
UNION ALL SELECT 'unique', 'event_id', CAST(count_if(n > 1) AS BIGINT) FROM (
   SELECT event_id, count(*) AS n FROM r WHERE event_id IS NOT NULL GROUP BY event_id)
UNION ALL SELECT 'unique', 'city_name', CAST(count_if(n > 1) AS BIGINT) FROM (
   SELECT city_name, count(*) AS n FROM r WHERE city_name IS NOT NULL GROUP BY city_name)
"""

COVERAGE_EXPECTED = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "OCEANIA"]
COVERAGE_MIN_CITIES = 15


def q_coverage(spark, sf):
    r = readings(spark, sf).withColumn("city_slug", units.slug("city_name", "state_code"))
    rep = quality.coverage_report(r, "country_code", "city_name", "city_slug",
                                  COVERAGE_EXPECTED, COVERAGE_MIN_CITIES)
    return rep.withColumn("missing_states", F.array_join("missing_states", ","))


SQL_COVERAGE = f"""
WITH r AS ({READINGS_SQL}),
s AS (SELECT *, concat_ws('_', lower(regexp_replace(city_name, '\\s+', '_', 'g')),
                          lower(state_code)) AS city_slug FROM r),
p AS (SELECT DISTINCT city_name, country_code, city_slug FROM s),
a AS (SELECT {', '.join(f"bool_or(coalesce(country_code = {_q(s)}, false)) AS p{i}" for i, s in enumerate(COVERAGE_EXPECTED))},
             count(DISTINCT CASE WHEN country_code NOT IN ({', '.join(_q(x) for x in COVERAGE_EXPECTED)}) THEN country_code END) AS unexpected_states,
             count(DISTINCT city_name) AS n_cities,
             count(city_slug) - count(DISTINCT city_slug) AS duplicate_slugs FROM p)
SELECT concat_ws(',', {', '.join(f"CASE WHEN NOT p{i} THEN {_q(s)} END" for i, s in enumerate(COVERAGE_EXPECTED))}) AS missing_states,
       unexpected_states, n_cities, n_cities >= {COVERAGE_MIN_CITIES} AS meets_min_cities, duplicate_slugs
FROM a
"""


def q_freshness(spark, sf):
    return quality.freshness(table(spark, sf, "events"), "ts", keys=["user_id"])


SQL_FRESHNESS = """
SELECT user_id, max(ts) AS last_seen,
       CAST(floor((epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts))) / 60000000) AS BIGINT)
         AS lag_minutes
FROM events GROUP BY user_id
"""


def q_union_by_name(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value",
                                           F.lit("event").alias("source"))
    o = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ts"),
        F.col("o_totalprice").alias("amount"), F.lit("order").alias("source"))
    return reshape.union_batches([ev, o])


SQL_UNION_BY_NAME = """
SELECT event_id, user_id, ts, value, 'event' AS source FROM events
UNION ALL BY NAME
SELECT o_orderkey AS event_id, o_custkey AS user_id, CAST(o_orderdate AS TIMESTAMP) AS ts,
       o_totalprice AS amount, 'order' AS source FROM orders
"""


def q_epoch_roundtrip(spark, sf):
    ev = table(spark, sf, "events")
    e = ev.select("event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch_s"))
    return e.select("event_id", "epoch_s",
                    timefn.epoch_to_ts("epoch_s").cast("timestamp_ntz").alias("ts_back"),
                    timefn.epoch_to_iso("epoch_s").alias("iso"))


SQL_EPOCH_ROUNDTRIP = """
WITH e AS (SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch_s FROM events)
SELECT event_id, epoch_s, make_timestamp(epoch_s * 1000000) AS ts_back,
       strftime(make_timestamp(epoch_s * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS iso
FROM e
"""


def q_distinct_hours(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(_hour(ev).alias("observed_hour")).distinct()


SQL_DISTINCT_HOURS = "SELECT DISTINCT date_trunc('hour', ts) AS observed_hour FROM events"


def q_sample_limit(spark, sf):
    ev = table(spark, sf, "events")
    return ev.orderBy("ts", "event_id").limit(10).select("event_id", "ts", "user_id",
                                                        "event_type")


SQL_SAMPLE_LIMIT = """
SELECT event_id, ts, user_id, event_type FROM events ORDER BY ts, event_id LIMIT 10
"""

DETAIL_NAMES = {"user_id": "User", "observed_hour": "Hour", "avg_value": "Avg Value",
                "min_value": "Min Value", "max_value": "Max Value",
                "dominant_type": "Type", "reading_count": "Readings"}


def q_hourly_detail(spark, sf):
    return views.hourly_detail(q_hourly_summary(spark, sf), DETAIL_NAMES)


SQL_HOURLY_DETAIL = ("SELECT " + ", ".join(f'{c} AS "{n}"' for c, n in DETAIL_NAMES.items())
                     + f" FROM ({SQL_HOURLY_SUMMARY})")


def q_missing_keys(spark, sf):
    """Customers without any event (U4): expected keys minus observed keys."""
    expected = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    actual = table(spark, sf, "events").select(F.col("user_id").alias("key"))
    return reshape.missing_keys(expected, actual, "key")


SQL_MISSING_KEYS = """
SELECT DISTINCT c.c_custkey AS key FROM customer c
WHERE c.c_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)
"""


def q_row_count(spark, sf):
    """Row count of a table as a DataFrame."""
    return summary.row_count(table(spark, sf, "events"), "row_count")


SQL_ROW_COUNT = "SELECT count(*) AS row_count FROM events"


QUERIES: dict[str, Query] = {
    "hourly_summary": q_hourly_summary,
    "daily_summary_raw": q_daily_summary_raw,
    "latest_per_user": q_latest_per_user,
    "latest_keep_ties": q_latest_keep_ties,
    "current_readings": q_current_readings,
    "dominant_type": q_dominant_type,
    "validate_split_counts": q_validate_split_counts,
    "valid_rows": q_valid_rows,
    "rejected_rows": q_rejected_rows,
    "enriched": q_enriched,
    "props_json": q_props_json,
    "staged": q_staged,
    "trailing_24h": q_trailing_24h,
    "hour_slice": q_hour_slice,
    "in_list": q_in_list,
    "value_counts": q_value_counts,
    "regional_snapshot": q_regional_snapshot,
    "hour_over_hour": q_hour_over_hour,
    "one_decimal": q_one_decimal,
    "series_long": q_series_long,
    "range_summary": q_range_summary,
    "range_summary_hot": q_range_summary_hot,
    "mean_order": q_mean_order,
    "dimension_default": q_dimension_default,
    "first_k_per_group": q_first_k_per_group,
    "map_layer": q_map_layer,
    "advice_bands": q_advice_bands,
    "current_cards": q_current_cards,
    "et_labels": q_et_labels,
    "quality_report": q_quality_report,
    "model_tests": q_model_tests,
    "coverage": q_coverage,
    "freshness": q_freshness,
    "union_by_name": q_union_by_name,
    "epoch_roundtrip": q_epoch_roundtrip,
    "distinct_hours": q_distinct_hours,
    "sample_limit": q_sample_limit,
    "hourly_detail": q_hourly_detail,
    "missing_keys": q_missing_keys,
    "row_count": q_row_count,
}

ORACLE_SQL: dict[str, str] = {
    "hourly_summary": SQL_HOURLY_SUMMARY,
    "daily_summary_raw": SQL_DAILY_SUMMARY_RAW,
    "latest_per_user": SQL_LATEST_PER_USER,
    "latest_keep_ties": SQL_LATEST_KEEP_TIES,
    "current_readings": SQL_CURRENT_READINGS,
    "dominant_type": SQL_DOMINANT_TYPE,
    "validate_split_counts": SQL_VALIDATE_SPLIT_COUNTS,
    "valid_rows": SQL_VALID_ROWS,
    "rejected_rows": SQL_REJECTED_ROWS,
    "enriched": SQL_ENRICHED,
    "props_json": SQL_PROPS_JSON,
    "staged": SQL_STAGED,
    "trailing_24h": SQL_TRAILING_24H,
    "hour_slice": SQL_HOUR_SLICE,
    "in_list": SQL_IN_LIST,
    "value_counts": SQL_VALUE_COUNTS,
    "regional_snapshot": SQL_REGIONAL_SNAPSHOT,
    "hour_over_hour": SQL_HOUR_OVER_HOUR,
    "one_decimal": SQL_ONE_DECIMAL,
    "series_long": SQL_SERIES_LONG,
    "range_summary": SQL_RANGE_SUMMARY,
    "range_summary_hot": SQL_RANGE_SUMMARY_HOT,
    "mean_order": SQL_MEAN_ORDER,
    "dimension_default": SQL_DIMENSION_DEFAULT,
    "first_k_per_group": SQL_FIRST_K_PER_GROUP,
    "map_layer": SQL_MAP_LAYER,
    "advice_bands": SQL_ADVICE_BANDS,
    "current_cards": SQL_CURRENT_CARDS,
    "et_labels": SQL_ET_LABELS,
    "quality_report": SQL_QUALITY_REPORT,
    "model_tests": SQL_MODEL_TESTS,
    "coverage": SQL_COVERAGE,
    "freshness": SQL_FRESHNESS,
    "union_by_name": SQL_UNION_BY_NAME,
    "epoch_roundtrip": SQL_EPOCH_ROUNDTRIP,
    "distinct_hours": SQL_DISTINCT_HOURS,
    "sample_limit": SQL_SAMPLE_LIMIT,
    "hourly_detail": SQL_HOURLY_DETAIL,
    "missing_keys": SQL_MISSING_KEYS,
    "row_count": SQL_ROW_COUNT,
}


for _mod in (io_queries, stream_queries, weather_queries):   # marts, jobs, storage
    QUERIES.update(_mod.QUERIES)
    ORACLE_SQL.update(_mod.ORACLE_SQL)
