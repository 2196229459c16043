"""Unit conversions and keys (F1-F3): plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbus.functions._util import col

# Conversion factor and rounding digits of the processing job.
MPH_TO_MS = 0.44704
TEMP_DIGITS = 2
WIND_DIGITS = 3


def slug(city, state) -> Column:
    """``new_york_city_ny``: whitespace runs collapse to one underscore."""
    return F.concat_ws(
        "_",
        F.lower(F.regexp_replace(col(city), r"\s+", "_")),
        F.lower(col(state)),
    )


def f_to_c(temp_f, digits: int = TEMP_DIGITS) -> Column:
    return F.round((col(temp_f) - 32) * 5 / 9, digits)


def mph_to_ms(speed_mph, digits: int = WIND_DIGITS) -> Column:
    return F.round(col(speed_mph) * MPH_TO_MS, digits)
