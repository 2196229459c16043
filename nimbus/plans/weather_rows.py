"""Full weather readings over the driver's tables, in which every rule, band
and reason has rows that meet it and rows that do not.

Each column comes from a source of its own:

| column                          | from                                            |
| ------------------------------- | ----------------------------------------------- |
| city (with a run of spaces)     | events.user_id, three towns; NULL for some       |
| state                           | three valid codes and one other, from the nation |
| country                         | region                                           |
| lat, lon                        | customer account balance                         |
| observed_at                     | events.ts, moved on by 0, 3, 6 or 9 months by day|
| fetched_at                      | observed_at plus 0 to 3 hours, sometimes before  |
| temp_f                          | events.value in quarters (sums are exact)        |
| feels_like_f                    | temp_f less twice the day of the order           |
| temp_min_f, temp_max_f          | around temp_f, sometimes beyond it               |
| humidity_pct                    | events.props.k, beyond 100 for some              |
| pressure_hpa, clouds_pct        | order price and day                              |
| wind_speed_mph, wind_gust_mph   | order price                                      |
| condition                       | event_type; blank for some                       |

The order is the one whose key is the event's number (an equi-join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.plans.standins import CONDITION_SQL, K_SQL, condition_of, events_k, table

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def weather_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Flat readings (raw-zone columns, ISO times) with ``event_id`` and the
    partition ints of the hour they landed in: collectors deliver twice a day,
    so a reading lands 1 to 15 hours after it was observed."""
    e = events_k(spark, sf).alias("e")
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.dayofmonth("o_orderdate").alias("o_day"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf, "region")
    j = (e.join(c, F.col("user_id") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")).join(o, F.col("event_id") == F.col("o_orderkey"), "left"))
    price = F.coalesce(F.col("o_totalprice"), F.lit(1000.0))
    day = F.coalesce(F.col("o_day"), F.lit(1))
    seen = F.col("ts") + F.make_ym_interval(F.lit(0), (F.dayofmonth("ts") % 4 * 3).cast("int"))
    fetched = seen + F.make_dt_interval(hours=(F.col("event_id") % 4).cast("int"), mins=F.when(F.col("event_id") % 50 == 0, F.lit(-300)).otherwise(F.lit(0)))
    j = j.select("*", price.alias("price"), day.alias("oday"), seen.alias("seen"), fetched.alias("got"))
    ready = F.col("seen") + F.make_dt_interval(hours=(F.col("event_id") % 4).cast("int"))
    half_day = F.make_dt_interval(hours=(F.floor(F.hour(ready) / 12) * 12 + 12).cast("int"))
    j = j.withColumn("land", F.date_trunc("day", ready).cast("timestamp_ntz") + half_day)
    iso = lambda x: F.date_format(x, ISO)
    temp = F.floor(F.col("value") * 4) / 4
    wind = F.floor(F.col("price") / 10000) - F.when(F.col("event_id") % 29 == 0, 60).otherwise(0)
    return j.select(
        "event_id",
        F.when(F.col("event_id") % 97 != 0, F.concat(F.lit("Town  "), (F.col("user_id") % 3).cast("string"))).alias("city"),
        F.element_at(F.array(*[F.lit(s) for s in ("NY", "NJ", "CT", "TX")]), (F.col("c_nationkey") % 4 + 1).cast("int")).alias("state"),
        F.col("r_name").alias("country"),
        (37 + F.col("c_acctbal") / 1000).alias("lat"), (-82 + F.col("c_acctbal") / 800).alias("lon"),
        iso("got").alias("fetched_at"), iso("seen").alias("observed_at"),
        temp.alias("temp_f"), (temp - 2 * F.col("oday")).alias("feels_like_f"),
        (temp - F.col("oday") + 2).alias("temp_min_f"), (temp + F.col("oday") - 3).alias("temp_max_f"),
        (F.col("k") + F.when(F.col("event_id") % 31 == 0, 40).otherwise(0)).alias("humidity_pct"),
        (F.lit(830) + F.floor(F.col("price") / 1600)).cast("int").alias("pressure_hpa"),
        F.lit(10000).alias("visibility_m"), wind.cast("double").alias("wind_speed_mph"),
        F.lit(180).alias("wind_deg"), F.when(F.col("event_id") % 3 == 0, wind.cast("double") + 5).alias("wind_gust_mph"),
        (F.col("oday") * 4 - 5).cast("int").alias("clouds_pct"), F.lit(800).alias("condition_id"),
        F.when(F.col("event_id") % 41 == 0, F.lit("  ")).otherwise(condition_of("event_type")).alias("condition_main"),
        F.when(F.col("event_id") % 43 == 0, F.lit("")).otherwise(F.col("event_type")).alias("condition_description"),
        F.lit("01d").alias("condition_icon"), F.lit("2024-01-01T11:00:00+00:00").alias("sunrise"), F.lit("2024-01-01T22:00:00+00:00").alias("sunset"),
        F.year("land").alias("year"), F.month("land").alias("month"), F.dayofmonth("land").alias("day"), F.hour("land").alias("hour"))


# The same rows in the oracle's dialect; ``seen`` and ``got`` are the times as timestamps.
WEATHER_SQL = f"""
  SELECT *, CAST(year(land) AS INTEGER) AS year, CAST(month(land) AS INTEGER) AS month,
         CAST(day(land) AS INTEGER) AS day, CAST(hour(land) AS INTEGER) AS hour,
         strftime(got, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS fetched_at,
         strftime(seen, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS observed_at
  FROM (
    SELECT *, seen + to_hours(CAST(event_id % 4 AS INTEGER))
              + to_minutes(CASE WHEN event_id % 50 = 0 THEN -300 ELSE 0 END) AS got,
           date_trunc('day', seen + to_hours(CAST(event_id % 4 AS INTEGER)))
             + to_hours(CAST(hour(seen + to_hours(CAST(event_id % 4 AS INTEGER))) // 12 * 12 + 12 AS INTEGER)) AS land
    FROM (
      SELECT e.event_id, e.ts + to_months(CAST(day(e.ts) % 4 * 3 AS INTEGER)) AS seen,
        CASE WHEN e.event_id % 97 <> 0 THEN 'Town  ' || (e.user_id % 3) END AS city,
        ['NY', 'NJ', 'CT', 'TX'][c.c_nationkey % 4 + 1] AS state, r.r_name AS country,
        37 + c.c_acctbal / 1000 AS lat, -82 + c.c_acctbal / 800 AS lon,
        floor(e.value * 4) / 4 AS temp_f, floor(e.value * 4) / 4 - 2 * coalesce(day(o.o_orderdate), 1) AS feels_like_f,
        floor(e.value * 4) / 4 - coalesce(day(o.o_orderdate), 1) + 2 AS temp_min_f,
        floor(e.value * 4) / 4 + coalesce(day(o.o_orderdate), 1) - 3 AS temp_max_f,
        {K_SQL} + CASE WHEN e.event_id % 31 = 0 THEN 40 ELSE 0 END AS humidity_pct,
        CAST(830 + floor(coalesce(o.o_totalprice, 1000.0) / 1600) AS INTEGER) AS pressure_hpa,
        CAST(floor(coalesce(o.o_totalprice, 1000.0) / 10000) - CASE WHEN e.event_id % 29 = 0 THEN 60 ELSE 0 END AS DOUBLE) AS wind_speed_mph,
        CASE WHEN e.event_id % 3 = 0 THEN floor(coalesce(o.o_totalprice, 1000.0) / 10000)
             - CASE WHEN e.event_id % 29 = 0 THEN 60 ELSE 0 END + 5.0 END AS wind_gust_mph,
        CAST(coalesce(day(o.o_orderdate), 1) * 4 - 5 AS INTEGER) AS clouds_pct,
        CASE WHEN e.event_id % 41 = 0 THEN '  ' ELSE {CONDITION_SQL} END AS condition_main,
        CASE WHEN e.event_id % 43 = 0 THEN '' ELSE e.event_type END AS condition_description
      FROM events e JOIN customer c ON e.user_id = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
      LEFT JOIN orders o ON e.event_id = o.o_orderkey))
"""
