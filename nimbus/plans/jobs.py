"""The two scheduled jobs: fetch to the raw zone, process one hour.

``run_hour`` is an explicit argument of both, so a late or replayed hour
is a plain re-run (T4 backfill) and fetch and process always agree on the
hour they touch.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbus.dims import CITIES
from nimbus.operators.enrich import enrich
from nimbus.operators.flatten import to_landed
from nimbus.operators.enrich import run_hour_parts
from nimbus.operators.validate import REASONS, ingest_rules, passes, split, split_counts
from nimbus.schemas import PARTITION_COLS, PARTITION_FIELDS, PROCESSED, READING, READING_COLS
from nimbus.sources.keyed import (Transport, fetch_counts, payload_readings,
                                  register_keyed_source)
from nimbus.sources.raw import CORRUPT, read_raw
from nimbus.sources.sinks import (clear_hours, empty_hours, overwrite_hour, register_table, replace_hours,
                                  with_run_hour, write_partitions, write_raw)

CITY_KEY_SCHEMA = "name string, state string, lat double, lon double"

QUARANTINE = T.StructType(
    list(READING.fields)
    + [T.StructField(CORRUPT, T.StringType()),
       T.StructField(REASONS, T.ArrayType(T.StringType()))] + PARTITION_FIELDS)

log = logging.getLogger(__name__)


@dataclass
class FetchResult:
    ok: int
    failed: int


def fetch_to_raw(spark: SparkSession, transport: Transport, raw_root: str, run_hour: str,
                 cities: list[tuple] | None = None) -> FetchResult:
    """Fetch every city in its own task, land successes as JSON lines. An answer
    with values that do not fit lands with their names and its whole text: the
    process job sends it to quarantine.

    Failed cities are counted and skipped; if every city fails the job
    fails (nothing is written in that case)."""
    fmt = register_keyed_source(spark, cities or CITIES, CITY_KEY_SCHEMA, transport,
                                name="nimbus_cities")
    fetched, obs = fetch_counts(spark.read.format(fmt).load())
    records = to_landed(payload_readings(fetched))
    write_raw(records, raw_root, run_hour)
    res = FetchResult(int(obs.get["ok"]), int(obs.get["failed"]))
    if res.ok == 0:
        raise RuntimeError("No weather data fetched")
    if res.failed:
        log.warning("%d cities failed to fetch and were skipped", res.failed)
    log.info("fetched %d/%d cities for %s", res.ok, res.ok + res.failed, run_hour)
    return res


@dataclass
class ProcessResult:
    total: int
    valid: int
    invalid: int


def process_hour(spark: SparkSession, raw_root: str, processed_root: str, run_hour: str,
                 quarantine_root: str | None = None, processed_at: str | None = None,
                 table: str | None = None, rules=None, atomic: bool = False) -> ProcessResult:
    """Validate and enrich one raw hour; write processed Parquet and quarantine.

    * one scan of the raw hour, persisted for the count and the two writes
      (spills to disk if large; recomputed from the raw files if lost)
    * counts come from one aggregation over the cached hour (an observation
      on a write is dropped when its input turns out empty)
    * the processed hour is replaced whole (static partition overwrite when
      a table is registered, so even an all-invalid re-run clears it)
    * ``atomic`` (with ``table``): the hour is written beside and the catalog
      entry switched, so no reader of the table sees it half replaced
    """
    raw = read_raw(spark, raw_root, run_hour=run_hour)
    rules = rules if rules is not None else ingest_rules()
    checked = raw.persist()
    try:
        # One aggregation over the cached hour: counts and the empty guard.
        c = split_counts(checked, rules).first()
        if c.total_count == 0:
            raise RuntimeError(f"No raw data to process for {run_hour}")
        good, rejected = split(checked, rules)
        valid = enrich(good, run_hour=run_hour, processed_at=processed_at)
        valid = valid.select(*PROCESSED.fieldNames())
        if table:
            register_table(spark, table, processed_root, PROCESSED)
            _replace_hour(spark, table, valid, run_hour, atomic, c.valid_count)
        else:
            write_partitions(valid, processed_root)
        if quarantine_root:
            bad = (with_run_hour(rejected, run_hour)
                   .select(*READING_COLS, CORRUPT, REASONS, *PARTITION_COLS))
            if table:
                # a re-run with no rejects must also clear the hour's old rejects
                qtable = f"{table}_quarantine"
                register_table(spark, qtable, quarantine_root, QUARANTINE, fmt="json")
                _replace_hour(spark, qtable, bad, run_hour, atomic, c.invalid_count)
            else:
                write_partitions(bad, quarantine_root, fmt="json")
                if c.invalid_count == 0:
                    clear_hours(spark, quarantine_root, [run_hour])
        if not table and c.valid_count == 0:
            clear_hours(spark, processed_root, [run_hour])
    finally:
        checked.unpersist()
    if c.invalid_count:
        log.warning("%d records failed validation for %s", c.invalid_count, run_hour)
    log.info("processed %s: valid=%d invalid=%d", run_hour, c.valid_count, c.invalid_count)
    return ProcessResult(c.total_count, c.valid_count, c.invalid_count)


def _replace_hour(spark: SparkSession, table: str, df: DataFrame, run_hour: str, atomic: bool, rows: int) -> None:
    if not atomic:
        overwrite_hour(spark, table, df, run_hour)
    elif rows:
        replace_hours(df, table)
    else:
        empty_hours(spark, table, [run_hour])


def backfill(spark: SparkSession, raw_root: str, processed_root: str, run_hours: list[str],
             quarantine_root: str | None = None, processed_at: str | None = None,
             table: str | None = None, rules=None, atomic: bool = False) -> dict[str, ProcessResult]:
    """Re-process late or replayed hours (T4) in one distributed job.

    Only the requested hours' folders are read; one aggregation counts every
    hour; one dynamic-overwrite write replaces all of them.
    Hours left with no valid rows (or no rejects) are then emptied together,
    so no stale hour remains.
    Hours without raw data are reported as zero counts. ``atomic`` as in
    ``process_hour``.
    """
    rules = rules if rules is not None else ingest_rules()
    stamp = processed_at or datetime.now(timezone.utc).isoformat()
    raw = read_raw(spark, raw_root, run_hours=run_hours).persist()
    try:
        ok = F.coalesce(passes(rules, raw), F.lit(False))
        per_hour = {(r.year, r.month, r.day, r.hour): r for r in raw.groupBy(*PARTITION_COLS).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("v")).collect()}  # one row per hour
        valid = processed_from_raw(raw, stamp, rules)
        bad = rejected_from_raw(raw, rules)
        _write_hours(spark, valid, processed_root, table, PROCESSED, "parquet", atomic)
        if quarantine_root:
            _write_hours(spark, bad, quarantine_root, f"{table}_quarantine" if table else None,
                         QUARANTINE, "json", atomic)
    finally:
        raw.unpersist()
    out = {}
    for h in run_hours:
        r = per_hour.get(tuple(run_hour_parts(h).values()))
        n, v = (int(r.n), int(r.v)) if r else (0, 0)
        out[h] = ProcessResult(n, v, n - v)
    no_valid = [h for h, r in out.items() if r.valid == 0]
    no_rejects = [h for h, r in out.items() if r.invalid == 0] if quarantine_root else []
    if table:
        empty_hours(spark, table, no_valid)
        if quarantine_root:
            empty_hours(spark, f"{table}_quarantine", no_rejects)
    else:
        clear_hours(spark, processed_root, no_valid)
        if quarantine_root:
            clear_hours(spark, quarantine_root, no_rejects)
    return out


def _write_hours(spark: SparkSession, df: DataFrame, root: str, table: str | None, schema,
                 fmt: str, atomic: bool = False) -> None:
    """Replace every hour present in ``df`` (dynamic partition overwrite)."""
    if table:
        register_table(spark, table, root, schema, fmt=fmt)
        if atomic:
            replace_hours(df, table)
            return
        cols = spark.table(table).columns
        # overwrite only the hours written, whatever the session default is
        key = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(key, "static")
        spark.conf.set(key, "dynamic")
        try:
            df.select(*cols).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(key, before)
    else:
        write_partitions(df, root, fmt=fmt)


def rejected_from_raw(raw: DataFrame, rules=None) -> DataFrame:
    """Quarantine rows (fields, corrupt text, reasons, partition ints) of any
    raw frame that carries partition ints."""
    _, bad = split(raw, rules if rules is not None else ingest_rules())
    kept = [f for f in QUARANTINE.fields if f.name != REASONS]
    return bad.select(*[F.col(f.name) if f.name in bad.columns
                        else F.lit(None).cast(f.dataType).alias(f.name) for f in kept], REASONS)


def processed_from_raw(raw: DataFrame, processed_at: str, rules=None) -> DataFrame:
    """Validated + enriched rows of any raw frame that carries partition ints
    (used by the incremental ingest, where one batch spans several hours)."""
    valid, _ = split(raw, rules if rules is not None else ingest_rules())
    out = enrich(valid.drop(CORRUPT), processed_at=processed_at)
    # optional fields the input does not carry are written as typed NULLs
    return out.select(*[F.col(f.name) if f.name in out.columns
                        else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in PROCESSED.fields])
