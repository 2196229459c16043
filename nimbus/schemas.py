"""Declared schemas for every zone (no inference anywhere).

* ``PAYLOAD``   - nested API document (D1)
* ``READING``   - flat reading in the raw zone (D2), 24 fields, all nullable
* ``RAW_ZONE``  - ``READING`` + hive partition ints (read back as text by
  ``sources.raw.read_raw`` and typed with ``try_cast``)
* ``PROCESSED`` - raw + enrichment columns (D7)
"""

from __future__ import annotations

from pyspark.sql import types as T

PARTITION_COLS = ["year", "month", "day", "hour"]

PAYLOAD = T.StructType([
    T.StructField("coord", T.StructType([
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
    ])),
    T.StructField("weather", T.ArrayType(T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("main", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("icon", T.StringType()),
    ]))),
    T.StructField("base", T.StringType()),
    T.StructField("main", T.StructType([
        T.StructField("temp", T.DoubleType()),
        T.StructField("feels_like", T.DoubleType()),
        T.StructField("temp_min", T.DoubleType()),
        T.StructField("temp_max", T.DoubleType()),
        T.StructField("pressure", T.IntegerType()),
        T.StructField("humidity", T.IntegerType()),
        T.StructField("sea_level", T.IntegerType()),
        T.StructField("grnd_level", T.IntegerType()),
    ])),
    T.StructField("visibility", T.IntegerType()),
    T.StructField("wind", T.StructType([
        T.StructField("speed", T.DoubleType()),
        T.StructField("deg", T.IntegerType()),
        T.StructField("gust", T.DoubleType()),
    ])),
    T.StructField("rain", T.StructType([T.StructField("1h", T.DoubleType())])),
    T.StructField("clouds", T.StructType([T.StructField("all", T.IntegerType())])),
    T.StructField("dt", T.LongType()),
    T.StructField("sys", T.StructType([
        T.StructField("type", T.IntegerType()),
        T.StructField("id", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("sunrise", T.LongType()),
        T.StructField("sunset", T.LongType()),
    ])),
    T.StructField("timezone", T.IntegerType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("cod", T.IntegerType()),
])

_READING_FIELDS = [
    ("city", T.StringType()),
    ("state", T.StringType()),
    ("country", T.StringType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("fetched_at", T.StringType()),
    ("observed_at", T.StringType()),
    ("temp_f", T.DoubleType()),
    ("feels_like_f", T.DoubleType()),
    ("temp_min_f", T.DoubleType()),
    ("temp_max_f", T.DoubleType()),
    ("humidity_pct", T.IntegerType()),
    ("pressure_hpa", T.IntegerType()),
    ("visibility_m", T.IntegerType()),
    ("wind_speed_mph", T.DoubleType()),
    ("wind_deg", T.IntegerType()),
    ("wind_gust_mph", T.DoubleType()),
    ("clouds_pct", T.IntegerType()),
    ("condition_id", T.IntegerType()),
    ("condition_main", T.StringType()),
    ("condition_description", T.StringType()),
    ("condition_icon", T.StringType()),
    ("sunrise", T.StringType()),
    ("sunset", T.StringType()),
]

READING = T.StructType([T.StructField(n, t, True) for n, t in _READING_FIELDS])
READING_COLS = [n for n, _ in _READING_FIELDS]

PARTITION_FIELDS = [T.StructField(c, T.IntegerType(), True) for c in PARTITION_COLS]

RAW_ZONE = T.StructType(list(READING.fields) + PARTITION_FIELDS)

ENRICH_FIELDS = [
    T.StructField("city_slug", T.StringType(), True),
    T.StructField("processed_at", T.StringType(), True),
    T.StructField("temp_c", T.DoubleType(), True),
    T.StructField("feels_like_c", T.DoubleType(), True),
    T.StructField("wind_speed_ms", T.DoubleType(), True),
]

PROCESSED = T.StructType(list(READING.fields) + ENRICH_FIELDS + PARTITION_FIELDS)

# Required columns of the ingest rule set (fixed values, same list the
# processing job enforces).
REQUIRED_COLS = [
    "city", "state", "country", "lat", "lon",
    "fetched_at", "observed_at",
    "temp_f", "feels_like_f", "temp_min_f", "temp_max_f",
    "humidity_pct", "pressure_hpa", "wind_speed_mph",
    "condition_main", "condition_description",
]
