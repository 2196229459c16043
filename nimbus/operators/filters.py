"""Filters (P8-P10) written so they reach the scan.

Time filters are ranges on the raw column (``ts >= a AND ts < b``), which
Parquet can push down; ``date_trunc(ts) = h`` cannot be pushed.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbus.functions._util import col


def filter_in(df: DataFrame, c: str, values) -> DataFrame:
    """IN-list filter; an empty or missing list keeps every row."""
    if not values:
        return df
    return df.filter(col(c).isin(*list(values)))


def _utc(x):
    """Datetimes and ISO texts with an offset as naive UTC; others unchanged."""
    d = x
    if isinstance(x, str):
        try:
            d = datetime.datetime.fromisoformat(x)
        except ValueError:
            return x
    if isinstance(d, datetime.datetime) and d.tzinfo is not None:
        return d.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return x


def ts_literal(x, typ: str = "timestamp") -> Column:
    """Literal timestamp of type ``typ``. Python datetimes go through their
    ISO text so the value never depends on the driver process's time zone; an
    offset is applied before the cast (a ``timestamp_ntz`` would drop it)."""
    if isinstance(x, Column):
        return x.cast(typ)
    shifted = _utc(x)
    suffix = "+00:00" if shifted is not x and typ == "timestamp" else ""
    if isinstance(shifted, datetime.datetime):
        shifted = shifted.isoformat(sep=" ") + suffix
    elif isinstance(shifted, datetime.date):
        shifted = shifted.isoformat()
    return F.lit(shifted).cast(typ)


def _ts_type(df: DataFrame, ts: str) -> str:
    """Bound literals take the column's own type, so no cast lands on the
    column and the comparison still pushes down to the scan."""
    return df.schema[ts].dataType.typeName()


def latest(df: DataFrame, ts: str) -> str | None:
    """``max(ts)`` of ``df`` resolved to a single value (one small job over
    one pruned column). A literal bound, unlike a scalar subquery, is pushed
    into the Parquet scan, where row-group statistics on ``ts`` skip data
    outside the window. The value comes back as text formatted in the
    session time zone, so it never passes through the driver process's
    local zone."""
    return df.agg(F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]


def trailing_window(df: DataFrame, ts: str, as_of=None, hours: int = 24) -> DataFrame:
    """Rows with ``as_of - hours <= ts``; ``as_of`` defaults to the data's max(ts).

    ``as_of`` is an argument, never the wall clock, so reruns are stable.
    """
    typ = _ts_type(df, ts)
    anchor = latest(df, ts) if as_of is None else as_of
    if anchor is None:
        return df.limit(0)
    lo = ts_literal(anchor, typ) - F.make_dt_interval(hours=F.lit(hours))
    return df.filter(col(ts) >= lo.cast(typ))


def hour_slice(df: DataFrame, ts: str, hour=None) -> DataFrame:
    """Rows whose ``ts`` falls in ``[hour, hour + 1h)``; default the latest hour."""
    typ = _ts_type(df, ts)
    anchor = latest(df, ts) if hour is None else hour
    if anchor is None:
        return df.limit(0)
    start = F.date_trunc("hour", ts_literal(anchor, typ)).cast(typ)
    end = (start + F.make_dt_interval(hours=F.lit(1))).cast(typ)
    return df.filter((col(ts) >= start) & (col(ts) < end))


def hour_of(x) -> datetime.datetime:
    """Start of the UTC hour of ``x`` (naive values are taken as UTC)."""
    d = _utc(x if isinstance(x, datetime.datetime) else str(x))
    d = d if isinstance(d, datetime.datetime) else datetime.datetime.fromisoformat(d)
    return d.replace(minute=0, second=0, microsecond=0)


def partition_from(hour: datetime.datetime) -> Column:
    """Partitions of ``hour`` or later, as comparisons on the bare partition
    columns (a catalog can evaluate them without fetching all partitions)."""
    y, m, d, h = (F.col(c) for c in ("year", "month", "day", "hour"))
    return (y > hour.year) | ((y == hour.year) & (
        (m > hour.month) | ((m == hour.month) & (
            (d > hour.day) | ((d == hour.day) & (h >= hour.hour))))))


def partition_before(hour: datetime.datetime) -> Column:
    """Partitions before ``hour``."""
    y, m, d, h = (F.col(c) for c in ("year", "month", "day", "hour"))
    return (y < hour.year) | ((y == hour.year) & (
        (m < hour.month) | ((m == hour.month) & (
            (d < hour.day) | ((d == hour.day) & (h < hour.hour))))))


def partition_bounds(start=None, end=None, max_lag_hours: int | None = None,
                     max_lead_hours: int | None = None) -> Column | None:
    """Partition predicate for an event-time range ``[start, end)``.

    Data lands in the partition of the hour it was fetched: usually after it
    was observed, but a clock that runs ahead puts it before. How late and how
    early only the caller can know: without ``max_lag_hours`` there is no upper
    bound and without ``max_lead_hours`` no lower one, and nothing is missed.
    """
    preds = []
    if start is not None and max_lead_hours is not None:
        preds.append(partition_from(hour_of(start) - datetime.timedelta(hours=max_lead_hours)))
    if end is not None and max_lag_hours is not None:
        preds.append(partition_before(hour_of(end) + datetime.timedelta(hours=max_lag_hours + 1)))
    if not preds:
        return None
    return preds[0] if len(preds) == 1 else preds[0] & preds[1]
