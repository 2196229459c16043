"""Dashboard data (C5-C12) as DataFrames over the staging view and marts.

The source reads the whole history and filters 24 hours in pandas; here
the window is a filter in the plan (with partition bounds when reading the
processed zone), ``as_of`` is an argument, and every section is a
distributed query whose result is small.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.dims import activities_df, populations_df
from nimbus.functions.text import signed_one_decimal
from nimbus.functions.timefn import as_of_label
from nimbus.operators.filters import filter_in, hour_slice, trailing_window
from nimbus.operators.flatten import stage
from nimbus.operators.reshape import series_long
from nimbus.operators.snapshot import hour_over_hour, regional_snapshot
from nimbus.operators.summary import mean_order, value_counts
from nimbus.operators.views import (city_advice, current_cards, hourly_detail, map_layer,
                                    range_summary)
from nimbus.sources.processed import read_processed


def window_24h(df: DataFrame, ts: str, as_of=None) -> DataFrame:
    return trailing_window(df, ts, as_of=as_of, hours=24)


def load_window(spark, processed_root: str, as_of, hours: int = 24,
                max_lag_hours: int | None = None, max_lead_hours: int | None = None,
                index_root: str | None = None, reconcile: bool = False) -> DataFrame:
    """Staging rows observed in ``[as_of - hours, as_of]``. With ``index_root``
    only the partitions that hold them are read, however late or early they
    landed; a caller who knows the longest time between observation and
    landing (``max_lag_hours``), and how far clocks run ahead
    (``max_lead_hours``), may give these instead."""
    end = (as_of if isinstance(as_of, datetime.datetime)
           else datetime.datetime.fromisoformat(str(as_of)))
    start = end - datetime.timedelta(hours=hours)
    window_end = end + datetime.timedelta(microseconds=1)   # inclusive as_of
    return stage(read_processed(spark, processed_root, start=start, end=window_end, max_lag_hours=max_lag_hours,
                                max_lead_hours=max_lead_hours, index_root=index_root, reconcile=reconcile))


def select_cities(df: DataFrame, cities=None, states=None, city: str = "city_name",
                  state: str = "state_code") -> DataFrame:
    """State and city multi-select (P8); an empty selection keeps all."""
    return filter_in(filter_in(df, state, states), city, cities)


def city_options(current: DataFrame, states=None, city: str = "city_name",
                 state: str = "state_code") -> DataFrame:
    """Sidebar choices: sorted distinct cities of the selected states (all
    states when none are selected)."""
    return filter_in(current, state, states).select(city).distinct().orderBy(city)


def weather_map(stg: DataFrame, populations: DataFrame | None = None, hour=None) -> DataFrame:
    """Map layer for one hour (C5): readings in the hour with colour/size.
    Default populations: the literal 19-city table."""
    sl = hour_slice(stg, "observed_at", hour)
    cols = ["latitude", "longitude", "temp_f", "feels_like_f", "wind_speed_mph",
            "humidity_pct", "condition_description", "city_name", "state_code"]
    pops = populations_df(stg.sparkSession) if populations is None else populations
    return map_layer(sl.select(*cols), pops)


def data_as_of(current: DataFrame, ts: str = "observed_at") -> DataFrame:
    """Newest observation and its display caption."""
    return current.agg(F.max(ts).alias("as_of")).withColumn(
        "label", F.concat(F.lit("Data as of: "), as_of_label("as_of")))


def cards(current: DataFrame) -> DataFrame:
    """Per-city cards."""
    return current_cards(current).orderBy("city_name")


def regional_snapshot_with_delta(stg: DataFrame, hour) -> DataFrame:
    """KPIs for ``hour`` plus the change against the previous present hour."""
    kpis = regional_snapshot(hour_slice(stg, "observed_at", hour), "observed_at", "temp_f",
                             "city_name", wind="wind_speed_mph", per_hour=True)
    hoh = hour_over_hour(stg, ["city_name", "state_code"], "observed_at", "temp_f")
    out = kpis.join(hoh.select("observed_hour", "prev_hour", "hour_delta"), "observed_hour", "left")
    return out.withColumn("delta_label", F.when(F.col("hour_delta").isNotNull(), F.concat(
        signed_one_decimal("hour_delta"), F.lit("°F"))))


def temperature_series(stg: DataFrame, cities) -> DataFrame:
    """Long series of actual and feels-like temperature."""
    sel = filter_in(stg, "city_name", cities)
    return series_long(sel, ["observed_at", "city_name"],
                       {"temp_f": "Temp", "feels_like_f": "Feels Like"}, "Metric", "°F") \
        .withColumn("label", F.concat_ws(" — ", "city_name", "Metric")) \
        .orderBy("observed_at")


def advisor(current: DataFrame, activities: DataFrame | None = None, month: int = 1,
            k: int = 2) -> DataFrame:
    """City advisor (C9); ``month`` comes from the caller's as-of date.
    Default activities: the literal table."""
    acts = activities_df(current.sparkSession) if activities is None else activities
    return city_advice(current, acts, month, k)


def condition_distribution(stg: DataFrame, cities=None) -> DataFrame:
    """Condition frequency (C10), ascending by count, as (Condition, Count)."""
    vc = value_counts(filter_in(stg, "city_name", cities), "condition_main", "Count")
    return vc.withColumnRenamed("condition_main", "Condition")


def city_comparison(hourly: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Box summary per city over min/avg/max and the city order by mean (C11)."""
    box = range_summary(hourly, "city_name", ["min_temp_f", "avg_temp_f", "max_temp_f"])
    order = mean_order(hourly, "city_name", "avg_temp_f", out="mean_avg_temp_f")
    return box.orderBy("city_name"), order


def detail(hourly: DataFrame) -> DataFrame:
    """Hourly detail table (C12), ordered by city then hour (O1)."""
    return hourly_detail(hourly.orderBy("city_name", "observed_hour"))
