"""Registered streaming queries (T1-T3) over the driver tables.

Each runs a stream to completion with ``availableNow`` into a fresh folder
under the shared checkpoint folder, then returns the result as a batch
DataFrame. Their final state is deterministic, so each has oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.operators.summary import Metric
from nimbus.plans.io_queries import VALID_LANDED_SQL
from nimbus.plans.standins import K_SQL, readings_as_landed, table
from nimbus.session import work_dir
from nimbus.sources.sinks import write_raw
from nimbus.streaming import (compact, dedup_stream, dedup_to_table, deduplicated, drain, dropped_late,
                              hourly_stream, hourly_stream_closed, ingest_stream, run_to_table)


SLICES = 4


def _in_time_order(spark: SparkSession, sf: str, base: str, start, again: int | None = None) -> None:
    """Events arriving in ``SLICES`` landings ordered by time, each followed by
    a run of the stream (``start(stream)``) on the same checkpoint, as a
    scheduler would; ``again``: every so many-th event lands twice. Rows the
    watermark drops as late would be lost, so there must be none."""
    ev = table(spark, sf, "events")
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    lo, hi = ev.agg(F.min(second), F.max(second)).first()
    for i in range(SLICES):
        part = ev.where(F.floor((second - lo) * SLICES / F.lit(hi - lo + 1)) == i)
        if again:
            part = part.unionByName(part.where(F.col("event_id") % again == 0))
        part.write.mode("append").parquet(f"{base}/landed")
        query = start(spark.readStream.schema(ev.schema).parquet(f"{base}/landed"))
        drain(query)
        if late := dropped_late(query):
            raise RuntimeError(f"{late} rows came later than the watermark allows")


def q_stream_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Watermarked tumbling-hour summary; update mode, final state read back."""
    base = work_dir(spark, "stream-hourly")

    def start(events):
        s = hourly_stream(events, ["user_id"], "ts",
                          [Metric("min_value", "min", "value"), Metric("max_value", "max", "value")],
                          label="event_type", watermark="2 hours", label_col="dominant_type")
        return run_to_table(s, f"{base}/out", f"{base}/ck", mode="update")

    _in_time_order(spark, sf, base, start)
    out = compact(spark, f"{base}/out", f"{base}/final", ["window_start", "user_id"])
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("observed_hour"),
                      "user_id", "min_value", "max_value", "dominant_type", "reading_count")


SQL_STREAM_HOURLY = """
WITH cc AS (SELECT user_id, date_trunc('hour', ts) AS observed_hour, event_type, count(*) AS n
            FROM events WHERE event_type IS NOT NULL GROUP BY ALL),
dom AS (SELECT user_id, observed_hour, event_type AS dominant_type FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, observed_hour
                                       ORDER BY n DESC, event_type) AS rn FROM cc) WHERE rn = 1)
SELECT a.observed_hour, a.user_id, a.min_value, a.max_value, d.dominant_type, a.reading_count
FROM (SELECT date_trunc('hour', ts) AS observed_hour, user_id, min(value) AS min_value,
             max(value) AS max_value, count(*) AS reading_count
      FROM events GROUP BY ALL) a
LEFT JOIN dom d ON a.user_id = d.user_id AND a.observed_hour = d.observed_hour
"""


def q_stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Drop repeated (user, ts) observations within the watermark; a
    quarter of the events lands twice."""
    base = work_dir(spark, "stream-dedup")

    def start(events):
        return run_to_table(dedup_stream(events, ["user_id", "ts"], "ts", "2 hours"), f"{base}/out", f"{base}/ck")

    _in_time_order(spark, sf, base, start, again=4)
    return spark.read.parquet(f"{base}/out").select(
        "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "value")


SQL_STREAM_DEDUP = """
SELECT user_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) AS rn FROM events)
WHERE rn = 1
"""


LATE_WATERMARK_HOURS = 9 * 24


def q_stream_dedup_late(spark: SparkSession, sf: str) -> DataFrame:
    """Copies and late rows in triggers of their own. Events land in time
    order in four slices; a quarter lands again with the next slice, and every
    fiftieth only two slices later. Each landing is one run of the stream."""
    base = work_dir(spark, "stream-dedup-late")
    ev = table(spark, sf, "events")
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    lo, hi = ev.agg(F.min(second), F.max(second)).first()
    cut = ev.withColumn("_slice", F.floor((second - lo) * SLICES / F.lit(hi - lo + 1)))
    for i in range(SLICES + 2):
        here = (F.col("_slice") == i) & (F.col("event_id") % 50 != 0) | (F.col("_slice") == i - 1) & (F.col("event_id") % 4 == 0) | (F.col("_slice") == i - 2) & (F.col("event_id") % 50 == 0)
        part = cut.where(here).drop("_slice")
        if part.isEmpty():
            continue
        part.coalesce(1).write.mode("append").parquet(f"{base}/landed")
        drain(dedup_to_table(spark.readStream.schema(ev.schema).parquet(f"{base}/landed"), ["user_id", "ts"], "ts", f"{base}/out", f"{base}/ck", watermark_hours=LATE_WATERMARK_HOURS))
    accepted, late = deduplicated(spark, f"{base}/out", ev.schema)
    cols = ["user_id", "ts", "event_type", "value"]
    return accepted.select(F.lit("accepted").alias("side"), *cols).unionByName(late.select(F.lit("late").alias("side"), *cols))


SQL_STREAM_DEDUP_LATE = """
WITH b AS (SELECT min(CAST(floor(epoch(ts)) AS BIGINT)) AS lo, max(CAST(floor(epoch(ts)) AS BIGINT)) AS hi FROM events),
e AS (SELECT events.*, CAST(floor((CAST(floor(epoch(ts)) AS BIGINT) - lo) * 4.0 / (hi - lo + 1)) AS INTEGER) AS s FROM events, b),
a AS (SELECT *, s AS l FROM e WHERE event_id % 50 <> 0 UNION ALL SELECT *, s + 1 FROM e WHERE event_id % 4 = 0
      UNION ALL SELECT *, s + 2 FROM e WHERE event_id % 50 = 0),
m AS (SELECT l, max(ts) AS seen FROM a GROUP BY l),
w AS (SELECT x.l, max(m.seen) - INTERVAL 216 HOURS AS mark FROM (SELECT DISTINCT l FROM a) x LEFT JOIN m ON m.l < x.l GROUP BY x.l),
t AS (SELECT a.*, coalesce(a.ts < w.mark, false) AS is_late FROM a JOIN w USING (l))
SELECT 'late' AS side, user_id, ts, event_type, value FROM t WHERE is_late
UNION ALL SELECT 'accepted', user_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY l, event_id) AS rn FROM t WHERE NOT is_late) WHERE rn = 1
"""


def q_stream_hourly_closed(spark: SparkSession, sf: str) -> DataFrame:
    """T2 without a map of labels in state: each hour once, when the watermark
    has passed it. The hours still open at the end are not returned."""
    base = work_dir(spark, "stream-hourly-closed")

    def start(events):
        s = hourly_stream_closed(events.withColumn("cents", F.round(F.col("value") * 100).cast("long")), ["user_id"], "ts",
                                 [Metric("min_value", "min", "value"), Metric("max_value", "max", "value"), Metric("sum_cents", "sum", "cents")],
                                 label="event_type", watermark="2 hours", label_col="dominant_type")
        return run_to_table(s, f"{base}/out", f"{base}/ck")

    _in_time_order(spark, sf, base, start)
    return spark.read.parquet(f"{base}/out").select(F.col("window_start").cast("timestamp_ntz").alias("observed_hour"),
                                                    "user_id", "min_value", "max_value", "sum_cents", "dominant_type", "reading_count")


SQL_STREAM_HOURLY_CLOSED = """
WITH cc AS (SELECT user_id, date_trunc('hour', ts) AS observed_hour, event_type, count(*) AS n
            FROM events WHERE event_type IS NOT NULL GROUP BY ALL),
dom AS (SELECT user_id, observed_hour, event_type AS dominant_type FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, observed_hour
                                       ORDER BY n DESC, event_type) AS rn FROM cc) WHERE rn = 1)
SELECT a.observed_hour, a.user_id, a.min_value, a.max_value, a.sum_cents, d.dominant_type, a.reading_count
FROM (SELECT date_trunc('hour', ts) AS observed_hour, user_id, min(value) AS min_value, max(value) AS max_value,
             CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS sum_cents, count(*) AS reading_count
      FROM events GROUP BY ALL) a
LEFT JOIN dom d ON a.user_id = d.user_id AND a.observed_hour = d.observed_hour
WHERE a.observed_hour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOURS
"""


def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Land readings as hour-partitioned JSON, then ingest incrementally."""
    base = work_dir(spark, "stream-ingest")
    landed = readings_as_landed(spark, sf)
    write_raw(landed, f"{base}/raw")
    drain(ingest_stream(spark, f"{base}/raw", f"{base}/processed", f"{base}/ck",
                        processed_at="2024-01-31T00:00:00+00:00",
                        quarantine_root=f"{base}/rejected"))
    return spark.read.parquet(f"{base}/processed").select(
        "city", "state", "observed_at", "temp_f", "humidity_pct", "city_slug", "temp_c",
        "wind_speed_ms", "year", "month", "day", "hour")


SQL_STREAM_INGEST = f"""
SELECT c.c_name AS city, n.n_name AS state,
       strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS observed_at, e.value AS temp_f,
       {K_SQL} AS humidity_pct,
       concat_ws('_', lower(regexp_replace(c.c_name, '\\s+', '_', 'g')), lower(n.n_name)) AS city_slug,
       round((e.value - 32) * 5 / 9, 2) AS temp_c,
       round(CAST({K_SQL} AS DOUBLE) * 0.44704, 3) AS wind_speed_ms,
       CAST(year(e.ts) AS INTEGER) AS year, CAST(month(e.ts) AS INTEGER) AS month,
       CAST(day(e.ts) AS INTEGER) AS day, CAST(hour(e.ts) AS INTEGER) AS hour
FROM events e JOIN customer c ON e.user_id = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE {VALID_LANDED_SQL}
"""

QUERIES = {
    "stream_hourly": q_stream_hourly,
    "stream_dedup": q_stream_dedup,
    "stream_ingest": q_stream_ingest,
    "stream_dedup_late": q_stream_dedup_late, "stream_hourly_closed": q_stream_hourly_closed,
}

ORACLE_SQL = {
    "stream_hourly": SQL_STREAM_HOURLY,
    "stream_dedup": SQL_STREAM_DEDUP,
    "stream_ingest": SQL_STREAM_INGEST,
    "stream_dedup_late": SQL_STREAM_DEDUP_LATE, "stream_hourly_closed": SQL_STREAM_HOURLY_CLOSED,
}
