"""Enrichment projection."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.functions import units


def run_hour_parts(run_hour: str) -> dict[str, int]:
    """``2024-03-31T15`` -> year/month/day/hour (unpadded ints)."""
    dt = datetime.strptime(run_hour, "%Y-%m-%dT%H")
    return {"year": dt.year, "month": dt.month, "day": dt.day, "hour": dt.hour}


def enrich(df: DataFrame, run_hour: str | None = None, processed_at: str | None = None,
           city: str = "city", state: str = "state", temp_f: str = "temp_f",
           feels_like_f: str = "feels_like_f", wind_mph: str = "wind_speed_mph") -> DataFrame:
    """Slug, audit time, SI units and (when ``run_hour`` is given) partition ints.

    ``processed_at`` is an argument so re-runs are reproducible; it defaults
    to the job's start time.
    """
    if processed_at is None:
        processed_at = datetime.now(timezone.utc).isoformat()
    cols = {
        "city_slug": units.slug(city, state),
        "processed_at": F.lit(processed_at),
        "temp_c": units.f_to_c(temp_f),
        "feels_like_c": units.f_to_c(feels_like_f),
        "wind_speed_ms": units.mph_to_ms(wind_mph),
    }
    if run_hour is not None:
        cols.update({k: F.lit(v) for k, v in run_hour_parts(run_hour).items()})
    return df.withColumns(cols)
