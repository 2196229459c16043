"""Time functions (F8, F12-F16). Session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbus.functions._util import col

# Display zone and label format of the dashboard.
DISPLAY_TZ = "America/New_York"
HOUR_LABEL_FORMAT = "MMM dd, hh:mm a 'ET'"
DAY_LABEL_FORMAT = "MMM dd, yyyy hh:mm a 'ET'"
ISO_FORMAT_UTC = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"


def epoch_to_ts(epoch_seconds) -> Column:
    """Epoch seconds -> timestamp (UTC instant)."""
    return F.timestamp_seconds(col(epoch_seconds))


def epoch_to_iso(epoch_seconds) -> Column:
    """Epoch seconds -> ISO-8601 string with ``+00:00`` offset."""
    return F.date_format(F.timestamp_seconds(col(epoch_seconds)), ISO_FORMAT_UTC)


def hour_floor(ts, ntz: bool = False) -> Column:
    out = F.date_trunc("hour", col(ts))
    return out.cast("timestamp_ntz") if ntz else out


def to_display_tz(ts) -> Column:
    return F.from_utc_timestamp(col(ts), DISPLAY_TZ)


def hour_label(ts) -> Column:
    """``Jan 01, 07:00 PM ET`` in the display zone (DST-aware)."""
    return F.date_format(to_display_tz(ts), HOUR_LABEL_FORMAT)


def as_of_label(ts) -> Column:
    """``Mar 31, 2024 11:46 AM ET``: the "data as of" caption."""
    return F.date_format(to_display_tz(ts), DAY_LABEL_FORMAT)


def season(month) -> Column:
    m = col(month)
    return (F.when(m.isin(12, 1, 2), "winter")
             .when(m.isin(3, 4, 5), "spring")
             .when(m.isin(6, 7, 8), "summer")
             .when(m.isin(9, 10, 11), "fall"))
