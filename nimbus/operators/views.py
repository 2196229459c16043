"""Dashboard-facing operators (C5, C6, C9, C11, C12; J3, J4, F4-F11, A11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nimbus.dims import DEFAULT_POPULATION
from nimbus.functions import advice as adv
from nimbus.functions import geo, text
from nimbus.functions._util import col
from nimbus.functions.timefn import season
from nimbus.operators.quantiles import HOT_ROWS, exact_quantiles
from nimbus.operators.reshape import series_long


def lookup_with_default(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str,
                        value: str, default, out: str | None = None) -> DataFrame:
    """Left join a dimension value with a default for missing keys.

    Spark's size-checked broadcast threshold (and AQE at run time) chooses
    between broadcast and a shuffled join; a literal table is a local relation
    of known size, so it is broadcast.
    """
    d = dim.select(F.col(dim_key).alias("_dk"), F.col(value).alias("_dv"))
    joined = df.join(d, col(left_key) == F.col("_dk"), "left")
    return joined.withColumn(out or value, F.coalesce(F.col("_dv"), F.lit(default))) \
                 .drop("_dk", "_dv")


def map_layer(df: DataFrame, populations: DataFrame, city: str = "city_name",
              temp: str = "temp_f", pop_city: str = "city", pop: str = "population") -> DataFrame:
    """Per reading: RGB from temperature, opacity and radius from population."""
    j = lookup_with_default(df, populations, city, pop_city, pop, DEFAULT_POPULATION,
                            out="population")
    t = geo.population_scale("population")
    out = j.withColumns({
        "color_r": geo.temp_channel(temp, 0),
        "color_g": geo.temp_channel(temp, 1),
        "color_b": geo.temp_channel(temp, 2),
        "alpha": geo.alpha(t),
        "radius": geo.radius(t),
    })
    return out.withColumn("color", F.array("color_r", "color_g", "color_b", "alpha"))


def current_cards(df: DataFrame, city: str = "city_name", state: str = "state_code",
                  temp: str = "temp_f", feels_like: str = "feels_like_f",
                  humidity: str = "humidity_pct", wind: str = "wind_speed_mph",
                  clouds: str = "clouds_pct", condition: str = "condition_main",
                  description: str = "condition_description") -> DataFrame:
    """Card labels per latest reading."""
    return df.select(
        F.concat_ws(", ", col(city), col(state)).alias("title"),
        F.concat_ws(" ", text.condition_icon(condition), text.title_or_dash(description)).alias("label"),
        F.concat(text.one_decimal(temp), F.lit(" °F")).alias("value"),
        F.concat(F.lit("Feels "), text.one_decimal(feels_like), F.lit(" °F")).alias("delta"),
        F.concat(F.lit("Humidity "), F.format_string("%.0f", col(humidity).cast("double")),
                 F.lit("%  |  Wind "), text.one_decimal(wind),
                 F.lit(" mph  |  Clouds "), F.format_string("%.0f", col(clouds).cast("double")),
                 F.lit("%")).alias("caption"),
        col(city).alias(city), col(state).alias(state),
    )


def advice_columns(df: DataFrame, month, feels_like: str = "feels_like_f",
                   wind: str = "wind_speed_mph", humidity: str = "humidity_pct",
                   condition: str = "condition_main") -> DataFrame:
    """Dress, travel, severity, context note and season.

    ``month`` is a column or an int taken from an explicit ``as_of`` date,
    never from today's date.
    """
    m = month if not isinstance(month, int) else F.lit(month)
    out = df.withColumns({
        "dress": adv.dress(feels_like),
        "travel": adv.travel(condition, wind, feels_like),
        "severity": adv.severity(condition, wind, humidity, feels_like),
        "season": season(m),
    })
    return out.withColumn("context_note",
                          adv.context_note("severity", condition, wind, humidity, feels_like))


def city_advice(latest: DataFrame, activities: DataFrame, month: int, k: int = 2,
                city: str = "city_name", **cols) -> DataFrame:
    """Advice plus the first ``k`` seasonal activities per city.

    Activities are folded into one array per city (a few entries each) and
    joined to the readings by Spark's size-checked join selection. Picking
    runs as array functions on each row:
    seasonal filter, indoor-only for ``poor`` (falling back to all seasonal
    if the city has no indoor option) and for ``severe`` (no fallback),
    authored order, first ``k``.
    """
    per_city = (activities.filter(F.array_contains("months", F.lit(month)))
                .groupBy(F.col("city").alias("_acity"))
                .agg(F.array_sort(F.collect_list(F.struct("ord", "name", "outdoor", "tip")))
                     .alias("_acts")))
    base = advice_columns(latest, month, **cols)
    j = base.join(per_city, col(city) == F.col("_acity"), "left")
    acts = F.coalesce(F.col("_acts"), F.array())
    indoor = F.filter(acts, lambda a: ~a["outdoor"])
    cands = (F.when(F.col("severity") == "ok", acts)
              .when((F.col("severity") == "poor") & (F.size(indoor) == 0), acts)
              .otherwise(indoor))
    picks = F.transform(F.slice(cands, 1, k),
                        lambda a: F.concat(a["name"], F.lit(" ("), a["tip"], F.lit(")")))
    return (j.withColumn("activities", picks)
             .withColumn("activities_text",
                         F.when(F.size("activities") > 0, F.array_join("activities", "  ·  "))
                          .otherwise(F.lit(adv.NO_ACTIVITIES)))
             .drop("_acity", "_acts"))


def range_summary(df: DataFrame, key: str, cols, names=("min_v", "q1", "median", "q3", "max_v"),
                  probs=(0.0, 0.25, 0.5, 0.75, 1.0), approx: bool = False,
                  accuracy: int = 10000, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Five-number summary per key over several value columns stacked.

    Exact, interpolated like ``quantile_cont``, without a buffer of a key's
    values; keys of more than ``hot_rows`` values are ordered in pieces
    (``operators.quantiles``). ``approx=True`` switches to a bounded-memory
    sketch.
    """
    long = series_long(df, [key], list(cols), "metric", "_v")
    if approx:
        r = long.groupBy(key).agg(F.percentile_approx("_v", list(probs), accuracy).alias("_q"))
        return r.select(key, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    return exact_quantiles(long, key, "_v", probs, names, hot_rows)


# Display names of the hourly detail table.
HOURLY_DETAIL_NAMES = {
    "city_name": "City", "state_code": "State",
    "observed_hour": "Hour", "avg_temp_f": "Avg Temp (°F)",
    "min_temp_f": "Min Temp (°F)", "max_temp_f": "Max Temp (°F)",
    "avg_feels_like_f": "Feels Like (°F)", "avg_humidity_pct": "Humidity (%)",
    "avg_pressure_hpa": "Pressure (hPa)", "avg_wind_speed_mph": "Wind (mph)",
    "avg_clouds_pct": "Clouds (%)",
    "dominant_condition": "Condition", "reading_count": "Readings",
}


def hourly_detail(df: DataFrame, names: dict | None = None) -> DataFrame:
    """Column subset + presentation names."""
    names = HOURLY_DETAIL_NAMES if names is None else names
    return df.select(*[F.col(c).alias(n) for c, n in names.items() if c in df.columns])
