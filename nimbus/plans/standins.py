"""Weather-shaped readings over the driver's tables.

The operators take column names, so most driver queries run on ``events``
directly. Queries that need the full reading shape (city, state, the
advice inputs) use ``readings()``:

| reading column          | from                                              |
| ----------------------- | ------------------------------------------------- |
| city_name               | customer.c_name (events.user_id = c_custkey)      |
| state_code              | nation.n_name                                     |
| country_code            | region.r_name                                     |
| observed_at             | events.ts                                         |
| temp_f, feels_like_f    | events.value                                      |
| humidity_pct, clouds_pct| props.k                                           |
| wind_speed_mph          | props.k as double                                 |
| condition_main          | event_type through ``CONDITION_OF_TYPE``          |
| condition_description   | event_type                                        |

``CONDITION_OF_TYPE`` is this library's own choice (not source data): it
gives the five event types five weather conditions so every branch of
the advice rules is exercised.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.functions.text import with_json_fields

CONDITION_OF_TYPE = {
    "click": "Clear",
    "view": "Clouds",
    "purchase": "Rain",
    "signup": "Snow",
    "error": "Thunderstorm",
}


# Declared schemas of the driver tables the queries read (the same at every
# scale factor). Reading with a declared schema skips footer-based schema
# inference, which on a large table is a job of its own.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(path)


def events_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` plus the JSON property ``k`` as an int (NULL if malformed),
    parsed once per row however many predicates use it."""
    return with_json_fields(table(spark, sf_dir, "events"), "props", {"k": "int"})


def condition_of(c) -> F.Column:
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(CONDITION_OF_TYPE.items())])
    return F.try_element_at(m, F.col(c) if isinstance(c, str) else c)


def readings(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Events (all, or those given) joined to customer -> nation -> region, in
    the staging shape.

    nation (25 rows) and region (5 rows) fall under Spark's size-checked
    broadcast threshold; customer grows with the data, so its join is left
    to the planner (broadcast when small, sort-merge with AQE skew
    splitting when large).
    """
    ev = events_k(spark, sf_dir) if events is None else events
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (ev.join(cust, ev.user_id == cust.c_custkey)
           .join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
           .join(reg, F.col("n_regionkey") == F.col("r_regionkey")))
    return j.select(
        "event_id", "user_id",
        F.col("c_name").alias("city_name"),
        F.col("n_name").alias("state_code"),
        F.col("r_name").alias("country_code"),
        F.col("ts").alias("observed_at"),
        F.col("value").alias("temp_f"),
        F.col("value").alias("feels_like_f"),
        F.col("k").alias("humidity_pct"),
        F.col("k").cast("double").alias("wind_speed_mph"),
        F.col("k").alias("clouds_pct"),
        condition_of("event_type").alias("condition_main"),
        F.col("event_type").alias("condition_description"),
    )


ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def readings_as_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``readings()`` in the raw-zone record shape (ISO strings) with hive
    partition ints of the observation hour. Fields the driver tables do not
    carry are filled with fixed values: pressure 1013 hPa, the first city's
    coordinates, observation time as fetch time, temperature as min/max."""
    r = readings(spark, sf_dir)
    iso = F.date_format("observed_at", ISO_MICROS)
    return r.select(
        F.col("city_name").alias("city"), F.col("state_code").alias("state"),
        F.col("country_code").alias("country"),
        F.lit(40.7128).alias("lat"), F.lit(-74.006).alias("lon"),
        iso.alias("fetched_at"), iso.alias("observed_at"),
        "temp_f", "feels_like_f",
        F.col("temp_f").alias("temp_min_f"), F.col("temp_f").alias("temp_max_f"),
        "humidity_pct", F.lit(1013).alias("pressure_hpa"), "wind_speed_mph", "clouds_pct",
        "condition_main", "condition_description",
        F.year("observed_at").alias("year"), F.month("observed_at").alias("month"),
        F.dayofmonth("observed_at").alias("day"), F.hour("observed_at").alias("hour"))


# SQL text of the same shape, for the DuckDB oracle.
CONDITION_SQL = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in CONDITION_OF_TYPE.items()) + " END"

K_SQL = "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)"

READINGS_SQL = f"""
    SELECT e.event_id, e.user_id, c.c_name AS city_name, n.n_name AS state_code,
           r.r_name AS country_code, e.ts AS observed_at, e.value AS temp_f,
           e.value AS feels_like_f, {K_SQL} AS humidity_pct,
           CAST({K_SQL} AS DOUBLE) AS wind_speed_mph, {K_SQL} AS clouds_pct,
           {CONDITION_SQL} AS condition_main, e.event_type AS condition_description
    FROM events e
    JOIN customer c ON e.user_id = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
"""
