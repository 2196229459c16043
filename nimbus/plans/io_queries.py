"""Registered queries that go through storage.

They write derived data under the shared checkpoint folder, then read it
back through the library's readers, so the partition layout, the
partition-bound pruning and the exact-hour overwrite are exercised on the
driver tables.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from nimbus.operators.filters import latest
from nimbus.plans.jobs import processed_from_raw
from nimbus.plans.standins import CONDITION_SQL, K_SQL, readings_as_landed, table
from nimbus.session import work_dir
from nimbus.sources.processed import read_processed
from nimbus.sources.sinks import write_partitions

PROCESSED_AT = "2024-01-31T00:00:00+00:00"

# Rows of readings_as_landed() that pass the ingest rules (SQL side).
VALID_LANDED_SQL = f"""
  e.value IS NOT NULL AND e.value BETWEEN -100 AND 150 AND NOT isnan(e.value)
  AND {K_SQL} BETWEEN 0 AND 100
  AND CAST({K_SQL} AS DOUBLE) >= 0 AND ({CONDITION_SQL}) IS NOT NULL
  AND e.event_type IS NOT NULL AND e.ts IS NOT NULL
"""


def q_processed_window(spark: SparkSession, sf: str) -> DataFrame:
    """All hours validated, enriched and written as hour partitions in one
    job (dynamic overwrite), then the trailing 24 hours read back listing
    only the window's hour folders."""
    root = f"{work_dir(spark, 'processed-window')}/processed"
    write_partitions(processed_from_raw(readings_as_landed(spark, sf), PROCESSED_AT), root)
    as_of = datetime.datetime.fromisoformat(latest(table(spark, sf, "events"), "ts"))
    start = as_of - datetime.timedelta(hours=24)
    # landed by observation hour (no fetch lag): only the window's 25 hour
    # folders are listed
    out = read_processed(spark, root, start=start,
                         end=as_of + datetime.timedelta(microseconds=1), max_lag_hours=0, max_lead_hours=0)
    return out.select("city", "state", "observed_at", "temp_c", "city_slug", "day", "hour")


SQL_PROCESSED_WINDOW = f"""
SELECT c.c_name AS city, n.n_name AS state,
       strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS observed_at,
       round((e.value - 32) * 5 / 9, 2) AS temp_c,
       concat_ws('_', lower(regexp_replace(c.c_name, '\\s+', '_', 'g')), lower(n.n_name)) AS city_slug,
       CAST(day(e.ts) AS INTEGER) AS day, CAST(hour(e.ts) AS INTEGER) AS hour
FROM events e JOIN customer c ON e.user_id = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE {VALID_LANDED_SQL}
  AND e.ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS
"""

QUERIES = {"processed_window": q_processed_window}
ORACLE_SQL = {"processed_window": SQL_PROCESSED_WINDOW}
