"""Staging view and the two marts (C2-C4), plus the refresh."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.operators.flatten import stage
from nimbus.operators.latest import latest_per_key
from nimbus.operators.summary import hourly_summary
from nimbus.schemas import PARTITION_COLS
from nimbus.sources.processed import read_processed, read_processed_hours
from nimbus.sources.sinks import materialize, refresh_table, remove_hours, write_partitions
from nimbus.sources.zone import find_changes

# The 18 output columns of the current-readings mart.
CURRENT_COLUMNS = [
    "city_name", "state_code", "country_code", "latitude", "longitude", "observed_at",
    "temp_f", "feels_like_f", "temp_min_f", "temp_max_f", "humidity_pct", "pressure_hpa",
    "visibility_m", "wind_speed_mph", "wind_gust_mph", "clouds_pct", "condition_main",
    "condition_description",
]


# Columns of the sync variant's current table (keyed by slug).
SYNC_CURRENT_COLUMNS = [
    "city_name", "state_code", "country_code", "latitude", "longitude", "observed_at",
    "temp_f", "feels_like_f", "temp_min_f", "temp_max_f", "temp_c", "feels_like_c",
    "humidity_pct", "pressure_hpa", "visibility_m", "wind_speed_mph", "wind_gust_mph",
    "clouds_pct", "condition_main", "condition_description", "city_slug",
]

# Typed processed table of the sync variant, (column, type) in output order.
SYNC_PROCESSED_COLUMNS = [
    ("city", None), ("state", None), ("country", None), ("lat", None), ("lon", None),
    ("observed_at", "timestamp"), ("fetched_at", "timestamp"), ("processed_at", "timestamp"),
    ("temp_f", None), ("feels_like_f", None), ("temp_min_f", None), ("temp_max_f", None),
    ("temp_c", None), ("feels_like_c", None), ("humidity_pct", None), ("pressure_hpa", None),
    ("visibility_m", None), ("wind_speed_mph", None), ("wind_speed_ms", None),
    ("wind_deg", None), ("wind_gust_mph", None), ("clouds_pct", None), ("condition_id", None),
    ("condition_main", None), ("condition_description", None), ("condition_icon", None),
    ("city_slug", None), ("year", None), ("month", None), ("day", None), ("hour", None),
]


def stg_weather_raw(processed: DataFrame) -> DataFrame:
    """Typed staging shape over processed (or raw) readings."""
    return stage(processed)


def weather_current(stg: DataFrame, keep_ties: bool = False,
                    keys=("city_name", "state_code")) -> DataFrame:
    """Latest reading per (city, state).

    Default: one row, ordered by ``observed_at`` then ``fetched_at``
    (newest first). ``keep_ties=True`` keeps every reading tied on
    ``observed_at``, as the SQL model's join-back does. Readings without a
    key or a time have no place in the mart (the model's equality join drops
    them).
    """
    order = (["observed_at"] if keep_ties
             else [F.col("observed_at").desc(), F.col("fetched_at").desc()])
    known = stg.dropna(subset=[*keys, "observed_at"])
    return latest_per_key(known, list(keys), order, keep_ties=keep_ties).select(*CURRENT_COLUMNS)


def weather_current_by_city(stg: DataFrame) -> DataFrame:
    """Dashboard form (W2): latest per city name only, state not in the key."""
    return weather_current(stg, keys=("city_name",))


def weather_hourly_summary(stg: DataFrame, profile: str = "dbt",
                           extremes: str | None = None) -> DataFrame:
    """Hourly per-city summary."""
    return hourly_summary(stg, keys=["city_name", "state_code"], ts="observed_at",
                          label="condition_main", profile=profile, extremes=extremes)


def processed_typed(processed: DataFrame) -> DataFrame:
    """Processed readings with timestamps typed (sync variant's base table)."""
    present = set(processed.columns)
    return processed.select(*[
        (F.col(c).try_cast(t) if t else F.col(c)).alias(c) if c in present
        else F.lit(None).cast(t or "string").alias(c)
        for c, t in SYNC_PROCESSED_COLUMNS])


def current_by_slug(typed: DataFrame) -> DataFrame:
    """Latest reading per slug (the sync variant's DISTINCT ON), 21 columns.
    Ties on ``observed_at`` resolve by ``fetched_at`` (a total order)."""
    renamed = typed.select(
        *[F.col(c) for c in typed.columns],
        F.col("city").alias("city_name"), F.col("state").alias("state_code"),
        F.col("country").alias("country_code"), F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"))
    latest = latest_per_key(renamed, ["city_slug"],
                            [F.col("observed_at").desc(), F.col("fetched_at").desc()])
    return latest.select(*SYNC_CURRENT_COLUMNS)


def sync_hourly_summary(typed: DataFrame) -> DataFrame:
    """Hourly summary of the sync variant (observed extremes, 2 dp means)."""
    return hourly_summary(typed.withColumnsRenamed({"city": "city_name", "state": "state_code"}),
                          keys=["city_name", "state_code"], ts="observed_at",
                          label="condition_main", profile="sync")


def build_sync_tables(processed: DataFrame, prefix: str = "") -> dict[str, int]:
    """Full refresh of the three sync tables with their row counts."""
    typed = processed_typed(processed)
    return {
        "weather_processed": refresh_table(typed, f"{prefix}weather_processed"),
        "weather_current": refresh_table(current_by_slug(typed), f"{prefix}weather_current"),
        "weather_hourly_summary": refresh_table(sync_hourly_summary(typed),
                                                f"{prefix}weather_hourly_summary"),
    }


def build_marts(processed: DataFrame, prefix: str = "") -> dict[str, int]:
    """Staging as a view; marts as tables with their row counts."""
    stg = materialize(stg_weather_raw(processed), f"{prefix}stg_weather_raw", kind="view")
    return {
        "weather_current": refresh_table(weather_current(stg), f"{prefix}weather_current"),
        "weather_hourly_summary": refresh_table(weather_hourly_summary(stg),
                                                f"{prefix}weather_hourly_summary"),
    }


# ---------------------------------------------------------------------------
# Incremental refresh. A full refresh rereads the whole history every run;
# these touch only what a run can change.
# ---------------------------------------------------------------------------

def update_current(spark, table: str, new_processed: DataFrame) -> int:
    """Merge the newest reading per (city, state) of ``new_processed`` into
    the current mart ``table``.

    The latest reading is a maximum, so latest(old mart + new rows) equals
    latest(all history). New rows win ties on ``observed_at`` (they were
    fetched later). The merged result is checkpointed into the shared
    checkpoint folder, cutting its lineage to the table, and then written
    over the table. Returns the mart's row count.
    """
    new = weather_current(stg_weather_raw(new_processed)).withColumn("_new", F.lit(1))
    if spark.catalog.tableExists(table):
        both = spark.table(table).select(*CURRENT_COLUMNS).withColumn("_new", F.lit(0)) \
            .unionByName(new)
    else:
        both = new
    merged = latest_per_key(both, ["city_name", "state_code"],
                            [F.col("observed_at").desc(), F.col("_new").desc()]).drop("_new")
    merged = merged.checkpoint()
    return refresh_table(merged, table)


def update_hourly_summary(spark, processed_root: str, summary_root: str, profile: str = "dbt",
                          index_root: str | None = None, reconcile: bool = False) -> int:
    """Bring the hourly summary up to date with the processed zone.

    Nobody has to say what changed: the index (``index_root``, by default
    beside the summary) is compared with the zone's files (``sources.zone``),
    so a run that was never announced, a replayed hour and a removed one are
    all found. The observed hours that changed partitions hold or held, and no
    others, are recomputed from the partitions that hold them; hours without
    any reading left lose their summary. The index becomes current last, so a
    run that dies is simply repeated. Returns the number of changed partitions.
    """
    index_root = index_root or f"{summary_root.rstrip('/')}_index"

    def read(hours):
        return read_processed(spark, processed_root, reconcile=reconcile) if hours is None \
            else read_processed_hours(spark, processed_root, hours, reconcile=reconcile)

    changes = find_changes(spark, processed_root, index_root, read)
    if not changes.partitions:
        return 0
    # Hours only, a row for each: the partitions to read, and hours that no partition holds any more.
    held = changes.index.join(changes.observed, "observed_hour", "left_semi")
    parts = held.select(*PARTITION_COLS).distinct().collect()
    if parts:
        stg = stg_weather_raw(read([datetime.datetime(*p) for p in parts])).join(changes.observed, "observed_hour", "left_semi")
        summary = weather_hourly_summary(stg, profile).withColumns({
            "year": F.year("observed_hour"), "month": F.month("observed_hour"),
            "day": F.dayofmonth("observed_hour"), "hour": F.hour("observed_hour")})
        written = write_partitions(summary, summary_root)
    else:
        written = set()
    # Changed hours for which nothing was written: no reading with a key is left.
    stamps = [tuple(r) for r in changes.observed.select(F.year("observed_hour"), F.month("observed_hour"), F.dayofmonth("observed_hour"), F.hour("observed_hour")).collect()]
    remove_hours(spark, summary_root, [h for h in stamps if h not in written])
    changes.commit()
    return changes.partitions
