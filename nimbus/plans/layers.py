"""Layers in the catalog, and a refresh of several tables as one step.

* ``staging_view``: the staging layer is a persistent SQL view in a schema of
  its own, so any session reads it, and always over the zone as it is.
* ``refresh_together``: each mart keeps its rows in a table partitioned by
  version, behind a view that shows the version a pointer names. A refresh
  writes the new version of every mart, then moves the pointer: one file
  committed by one rename. Until then every reader sees the old marts,
  from then on the new ones, never some of each. A refresh that dies before
  it has moved nothing, and the next one overwrites what it left.
* ``refresh_layers``: both, with the row counts and quality checks taken from
  the rows while they are written (``operators.quality.MartChecks``).

A session caches the files of a table it has read: ``current_mart`` looks at
the pointer anew. The version before stays for readers at work.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nimbus.functions._util import observed
from nimbus.operators.flatten import STAGE_COLUMNS
from nimbus.operators.quality import MartChecks
from nimbus.plans.marts import weather_current, weather_hourly_summary

VERSION = "_version"
POINTER = "_current_version"


def _schema(spark: SparkSession, name: str, location: str | None) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def staging_view(spark: SparkSession, processed_table: str, schema: str = "staging", name: str = "stg_weather_raw",
                 location: str | None = None) -> DataFrame:
    """Create or replace the staging view over a registered processed table."""
    have = set(spark.table(processed_table).columns)
    cols = []
    for src, dst, typ in STAGE_COLUMNS:
        value = f"`{src}`" if src in have else "NULL"
        cols.append(f"{f'try_cast({value} AS {typ})' if typ else f'CAST({value} AS string)' if src not in have else value} AS {dst}")
    hour = "date_trunc('hour', try_cast(observed_at AS timestamp))" if "observed_at" in have else "CAST(NULL AS timestamp)"
    _schema(spark, schema, location)
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS SELECT {', '.join(cols)}, {hour} AS observed_hour FROM {processed_table}")
    return spark.table(f"{schema}.{name}")


def current_version(spark: SparkSession, schema: str) -> int:
    """The version the marts of ``schema`` show; 0 before the first refresh."""
    if not spark.catalog.tableExists(f"{schema}.{POINTER}"):
        return 0
    spark.catalog.refreshTable(f"{schema}.{POINTER}")
    return spark.table(f"{schema}.{POINTER}").agg(F.max("version")).first()[0] or 0


def _rows_table(spark: SparkSession, schema: str, name: str, df: DataFrame) -> str:
    """The table behind a mart; columns that are new are added to it."""
    table = f"{schema}.{name}_rows"
    if not spark.catalog.tableExists(table):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {table} ({cols}, {VERSION} bigint) USING parquet PARTITIONED BY ({VERSION})")
    else:
        have = set(spark.table(table).columns)
        new = [f for f in df.schema.fields if f.name not in have]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS (" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")
    return table


def write_version(spark: SparkSession, schema: str, frames: dict[str, DataFrame], location: str | None = None) -> tuple[int, dict[str, int]]:
    """Write the next version of every mart, seen by no reader yet: its number
    and the row counts, taken while writing."""
    _schema(spark, schema, location)
    version, counts = current_version(spark, schema) + 1, {}
    for name, df in frames.items():
        table = _rows_table(spark, schema, name, df)
        obs = Observation(f"rows-{uuid.uuid4().hex[:8]}")
        view = f"_nimbus_{uuid.uuid4().hex[:12]}"
        df.observe(obs, F.count(F.lit(1)).alias("rows")).createOrReplaceTempView(view)
        cols = [c for c in spark.table(table).columns if c != VERSION]
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({VERSION} = {version}) SELECT "
                  + ", ".join(f"`{c}`" if c in df.columns else f"NULL AS `{c}`" for c in cols) + f" FROM {view}")
        spark.catalog.dropTempView(view)
        counts[name] = int((observed(obs) or {}).get("rows") or 0)
    return version, counts


def show_version(spark: SparkSession, schema: str, version: int, columns: dict[str, list[str]]) -> None:
    """Let the marts show ``version`` (one committed write), and forget those
    before the one shown until now."""
    pointer = f"{schema}.{POINTER}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {pointer} (version bigint) USING parquet")
    for name, cols in columns.items():
        listed = ", ".join(f"`{c}`" for c in cols)
        wanted = f"SELECT {listed} FROM {schema}.{name}_rows WHERE {VERSION} = (SELECT max(version) FROM {pointer})"
        if not spark.catalog.tableExists(f"{schema}.{name}") or spark.table(f"{schema}.{name}").columns != cols:
            spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS {wanted}")
    spark.range(1).select(F.lit(version).cast("long").alias("version")).coalesce(1).write.insertInto(pointer)
    for name in columns:
        old = [r[0].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {schema}.{name}_rows").collect()]
        for v in (v for v in old if int(v) < version - 1):
            spark.sql(f"ALTER TABLE {schema}.{name}_rows DROP IF EXISTS PARTITION ({VERSION} = {v})")


def refresh_together(spark: SparkSession, schema: str, frames: dict[str, DataFrame], location: str | None = None) -> dict[str, int]:
    """Refresh several marts as one step; their row counts."""
    version, counts = write_version(spark, schema, frames, location)
    show_version(spark, schema, version, {n: df.columns for n, df in frames.items()})
    return counts


def current_mart(spark: SparkSession, schema: str, name: str) -> DataFrame:
    """A mart as it is now, whatever this session has read before."""
    current_version(spark, schema)
    spark.catalog.refreshTable(f"{schema}.{name}_rows")
    return spark.table(f"{schema}.{name}")


def refresh_layers(spark: SparkSession, processed_table: str, states, expected_states=None, staging: str = "staging", marts: str = "marts",
                   min_cities: int = 15, as_of=None, location: str | None = None) -> tuple[dict[str, int], DataFrame]:
    """Staging view and marts from a registered processed table: the row
    counts of the marts, and the quality report of what was written (C13).
    ``location``: where new schemas keep their tables (default: the warehouse)."""
    stg = staging_view(spark, processed_table, staging, location=location and f"{location}/staging")
    checks = MartChecks(states, expected_states or states, min_cities)
    frames = {"weather_current": checks.current(weather_current(checks.staging(stg))),
              "weather_hourly_summary": checks.summary(weather_hourly_summary(stg))}
    counts = refresh_together(spark, marts, frames, location and f"{location}/marts")
    return counts, checks.report(current_mart(spark, marts, "weather_current"), as_of)
