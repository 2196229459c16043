"""Regional KPIs and hour-over-hour change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nimbus.functions import exact
from nimbus.functions._util import col
from nimbus.operators.filters import hour_slice
from nimbus.operators.summary import time_bucket


def _per_name(df: DataFrame, group: list, value: str, name: str, wind: str | None,
              scale: int | None) -> DataFrame:
    """Stage 1 over the raw rows, per (group, name): a code-generated hash
    aggregate of extremes, sums and counts (partial before its shuffle)."""
    v = col(value)
    s = exact.sum_units(value, scale) if scale is not None else F.sum(v)
    aggs = [F.max(v).alias("_mx"), F.min(v).alias("_mn"), s.alias("_s"), F.count(v).alias("_n")]
    if wind:
        ws = exact.sum_units(wind, scale) if scale is not None else F.sum(col(wind))
        aggs += [ws.alias("_ws"), F.count(col(wind)).alias("_wn")]
    return df.groupBy(*group, col(name).alias("_name")).agg(*aggs)


def _finish_mean(total: str, n: str, scale: int | None) -> Column:
    if scale is not None:
        return exact.mean_from_units(F.sum(total), F.sum(n), scale)
    return F.try_divide(F.sum(total), F.sum(n))


def snapshot_aggs(wind: bool = False, scale: int | None = None) -> list[Column]:
    """Stage 2 over the per-name rows: extremes with the name of their
    reading (ties to the smallest name, a total order) and means over
    readings."""
    n = F.col("_name")
    aggs = [
        F.max("_mx").alias("max_value"),
        F.min_by(n, F.struct(-F.col("_mx"), n)).alias("max_name"),
        F.min("_mn").alias("min_value"),
        F.min_by(n, F.struct(F.col("_mn"), n)).alias("min_name"),
        _finish_mean("_s", "_n", scale).alias("avg_value"),
    ]
    if wind:
        aggs.append(_finish_mean("_ws", "_wn", scale).alias("avg_wind"))
    aggs.append(F.sum("_n").alias("reading_count"))
    return aggs


def regional_snapshot(df: DataFrame, ts: str, value: str, name: str, wind: str | None = None,
                      hour=None, per_hour: bool = False, bucket_col: str = "observed_hour",
                      scale: int | None = None) -> DataFrame:
    """KPIs over readings (not over cities) for one hour slice (default the
    latest hour) or, with ``per_hour``, for every hour at once.

    Two stages: the raw rows are reduced per (hour, name) by a hash
    aggregate; the arg-max/arg-min pick (``min_by`` over a struct, which
    Spark runs as a sort-based aggregate) then only sees the reduced rows.
    """
    if per_hour:
        group = [time_bucket(ts, "hour", df).alias(bucket_col)]
        stage1 = _per_name(df, group, value, name, wind, scale)
        return stage1.groupBy(bucket_col).agg(*snapshot_aggs(bool(wind), scale))
    stage1 = _per_name(hour_slice(df, ts, hour), [], value, name, wind, scale)
    return stage1.agg(*snapshot_aggs(bool(wind), scale))


def hour_over_hour(df: DataFrame, keys, ts: str, value: str, digits: int = 1,
                   key_digits: int = 2, scale: int | None = None,
                   bucket_col: str = "observed_hour") -> DataFrame:
    """Per hour: mean over readings minus the mean of the per-key hourly
    means (rounded to ``key_digits``) of the previous hour *present* in the
    data, rounded to ``digits``; NULL for the first hour.

    Plan: one partial aggregation per (key, hour), a second over hours, then
    ``lag`` over one row per hour. The window runs on the hour aggregate,
    so its single partition holds one row per hour of the time span.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    bucket = time_bucket(ts, "hour", df).alias(bucket_col)
    if scale is not None:
        per_key = (df.filter(col(value).isNotNull())
                     .groupBy(*keys, bucket)
                     .agg(exact.sum_units(value, scale).alias("_s"), F.count(value).alias("_n")))
        # per-key mean rounded to key_digits, kept as an exact integer count of units
        key_units = exact.round_units_mean_units("_s", "_n", key_digits, scale)
        per_hour = per_key.groupBy(bucket_col).agg(
            F.sum("_s").alias("_S"), F.sum("_n").alias("_N"),
            F.sum(key_units).alias("_K"), F.count(F.lit(1)).alias("_M"))
        now = exact.mean_from_units("_S", "_N", scale)
        key_mean = F.col("_K").cast("double") / (F.col("_M") * (10 ** key_digits))
        hour_avg = exact.round_units_mean("_S", "_N", key_digits, scale)
    else:
        per_key = (df.filter(col(value).isNotNull()).groupBy(*keys, bucket)
                     .agg(F.sum(value).alias("_s"), F.count(value).alias("_n"),
                          F.round(F.avg(value), key_digits).alias("_km")))
        per_hour = per_key.groupBy(bucket_col).agg(
            F.sum("_s").alias("_S"), F.sum("_n").alias("_N"), F.avg("_km").alias("_KM"))
        now = F.col("_S") / F.col("_N")
        key_mean = F.col("_KM")
        hour_avg = F.round(now, key_digits)
    w = Window.orderBy(bucket_col)
    hours = per_hour.select(bucket_col, now.alias("_now"), key_mean.alias("_km"),
                            hour_avg.alias("hour_avg"))
    lagged = hours.select(
        bucket_col, "hour_avg", "_now",
        F.lag(bucket_col).over(w).alias("prev_hour"),
        F.lag("_km").over(w).alias("_prev_km"),
    )
    delta = (exact.round_half_up(F.col("_now") - F.col("_prev_km"), digits) if scale is not None
             else F.round(F.col("_now") - F.col("_prev_km"), digits))
    return lagged.select(bucket_col, "hour_avg", "prev_hour", delta.alias("hour_delta"))
