"""Payload flattening, record serialisation and the staging projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbus.functions.timefn import ISO_FORMAT_UTC, epoch_to_iso, hour_floor
from nimbus.operators.validate import MALFORMED
from nimbus.schemas import READING_COLS


def _iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT_UTC)


def flatten_payload(df: DataFrame, city: str = "city", state: str = "state",
                    fetched_at: Column | str | None = None,
                    dim_lat: str | None = None, dim_lon: str | None = None) -> DataFrame:
    """Nested API document (+ attached city/state) -> flat 24-field reading.

    Defaults follow the source model: missing wind speed/deg, clouds,
    visibility read as 0, a missing gust stays NULL, country falls back to
    the dimension and then to ``US``, sunrise/sunset to epoch 0. A missing
    ``main``/``weather``/``dt`` leaves required fields NULL so validation
    quarantines the row instead of the job failing. What the reader says of
    the document (``_corrupt_record``, ``_malformed``) goes along.
    """
    first = F.try_element_at(F.col("weather"), F.lit(1))
    if fetched_at is None:
        fetched = _iso(F.current_timestamp())
    elif isinstance(fetched_at, str):
        fetched = F.col(fetched_at)
    else:
        fetched = fetched_at
    lat = F.col("coord.lat")
    lon = F.col("coord.lon")
    if dim_lat:
        lat = F.coalesce(lat, F.col(dim_lat))
    if dim_lon:
        lon = F.coalesce(lon, F.col(dim_lon))
    country = F.coalesce(F.col("sys.country"), F.lit("US"))
    said = [c for c in ("_corrupt_record", MALFORMED) if c in df.columns]
    return df.select(
        F.col(city).alias("city"),
        F.col(state).alias("state"),
        country.alias("country"),
        lat.alias("lat"),
        lon.alias("lon"),
        fetched.alias("fetched_at"),
        epoch_to_iso("dt").alias("observed_at"),
        F.col("main.temp").alias("temp_f"),
        F.col("main.feels_like").alias("feels_like_f"),
        F.col("main.temp_min").alias("temp_min_f"),
        F.col("main.temp_max").alias("temp_max_f"),
        F.col("main.humidity").alias("humidity_pct"),
        F.col("main.pressure").alias("pressure_hpa"),
        F.coalesce(F.col("visibility"), F.lit(0)).alias("visibility_m"),
        F.coalesce(F.col("wind.speed"), F.lit(0.0)).alias("wind_speed_mph"),
        F.coalesce(F.col("wind.deg"), F.lit(0)).alias("wind_deg"),
        F.col("wind.gust").alias("wind_gust_mph"),
        F.coalesce(F.col("clouds.all"), F.lit(0)).alias("clouds_pct"),
        first["id"].alias("condition_id"),
        first["main"].alias("condition_main"),
        first["description"].alias("condition_description"),
        first["icon"].alias("condition_icon"),
        epoch_to_iso(F.coalesce(F.col("sys.sunrise"), F.lit(0))).alias("sunrise"),
        epoch_to_iso(F.coalesce(F.col("sys.sunset"), F.lit(0))).alias("sunset"),
        *said,
    )


def to_record(df: DataFrame) -> DataFrame:
    """Flat reading in canonical field order (P2); ISO timestamps as strings."""
    return df.select(*READING_COLS)


def to_landed(df: DataFrame) -> DataFrame:
    """A reading as it lands in the raw zone. One whose document had values
    that did not fit carries their names and the whole document, so that
    validation rejects it and nothing of it is lost."""
    if MALFORMED not in df.columns:
        return to_record(df)
    bad = F.nullif(F.col(MALFORMED), F.lit(""))
    return df.select(*READING_COLS, bad.alias(MALFORMED), F.when(bad.isNotNull(), F.col("_corrupt_record")).alias("_document"))


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per reading, as the raw zone stores it."""
    return to_record(df).select(F.to_json(F.struct(*READING_COLS)).alias("value"))


# Staging projection (fixed values: output names and types of the staging view).
STAGE_COLUMNS = [
    ("city", "city_name", None),
    ("state", "state_code", None),
    ("country", "country_code", None),
    ("lat", "latitude", "double"),
    ("lon", "longitude", "double"),
    ("observed_at", "observed_at", "timestamp"),
    ("fetched_at", "fetched_at", "timestamp"),
    ("temp_f", "temp_f", "double"),
    ("feels_like_f", "feels_like_f", "double"),
    ("temp_min_f", "temp_min_f", "double"),
    ("temp_max_f", "temp_max_f", "double"),
    ("humidity_pct", "humidity_pct", "int"),
    ("pressure_hpa", "pressure_hpa", "int"),
    ("visibility_m", "visibility_m", "int"),
    ("wind_speed_mph", "wind_speed_mph", "double"),
    ("wind_deg", "wind_deg", "int"),
    ("wind_gust_mph", "wind_gust_mph", "double"),
    ("clouds_pct", "clouds_pct", "int"),
    ("condition_main", "condition_main", None),
    ("condition_description", "condition_description", None),
    ("condition_icon", "condition_icon", None),
]


def stage(df: DataFrame) -> DataFrame:
    """Rename + cast to the 22-column staging shape.

    ``try_cast`` turns malformed values into NULL rather than failing the
    query under ANSI mode. A source column missing from ``df`` reads NULL.
    """
    present = set(df.columns)
    out = []
    for src, dst, typ in STAGE_COLUMNS:
        c = F.col(src) if src in present else F.lit(None).cast(typ or "string")
        out.append((c.try_cast(typ) if typ else c).alias(dst))
    staged = df.select(*out)
    return staged.withColumn("observed_hour", hour_floor("observed_at"))
