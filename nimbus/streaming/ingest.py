"""Incremental ingest of the landed raw zone.

``readStream`` over the raw root picks up new files; ``availableNow``
processes what is there and stops, so a scheduler can run it like a batch
job with exactly-once bookkeeping in the checkpoint.

Micro-batches do not align with hours: a batch may hold part of an hour.
The batch therefore only tells *which* hours changed; each touched hour is
re-read whole from the raw zone and replaced whole in the processed zone.
Overwriting an hour from the partial batch alone would drop the rows
landed earlier.

The touched hours are partition keys (a handful per batch), brought to
the driver; the re-read lists only their folders and filters on their exact
partition values. A semi-join against the batch would not get dynamic
partition pruning here and would rescan the whole raw zone on every batch.
"""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nimbus.operators.validate import ingest_rules, split_counts
from nimbus.plans.jobs import processed_from_raw, rejected_from_raw
from nimbus.plans.marts import update_hourly_summary
from nimbus.sources.raw import read_raw
from nimbus.sources.sinks import write_partitions


log = logging.getLogger(__name__)

# The columns of the binaryFile source.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"
# New files of one trigger: the first run over a long history is many batches.
MAX_FILES = 10_000
_HOUR_IN_PATH = r"year=(\d+)/month=(\d+)/day=(\d+)/hour=(\d+)/"


def touched_hours(batch: DataFrame) -> list[int]:
    """Distinct hour keys (yyyymmddhh) of a micro-batch, taken from the names
    of its files, one row for each file: no file is opened for them."""
    part = [F.regexp_extract(F.col("_file"), _HOUR_IN_PATH, i + 1).cast("bigint") for i in range(4)]
    key = part[0] * 1000000 + part[1] * 10000 + part[2] * 100 + part[3]
    return [r[0] for r in batch.select(key.alias("k")).distinct().collect() if r[0] is not None]


def raw_stream(spark: SparkSession, raw_root: str, max_files: int = MAX_FILES) -> DataFrame:
    """Names of newly landed raw files, a row for each."""
    r = (spark.readStream.schema(BINARY_FILE).format("binaryFile").option("recursiveFileLookup", "true")
         .option("maxFilesPerTrigger", max_files))
    return r.load(raw_root).select(F.col("path").alias("_file"))


def _run_hour(key: int) -> str:
    s = str(key)
    return f"{s[:4]}-{s[4:6]}-{s[6:8]}T{s[8:10]}"


def ingest_stream(spark: SparkSession, raw_root: str, processed_root: str, checkpoint: str,
                  processed_at: str | None = None, max_files: int = MAX_FILES,
                  available_now: bool = True, summary_root: str | None = None,
                  quarantine_root: str | None = None) -> StreamingQuery:
    """Process newly landed raw files.

    Valid rows go to ``processed_root``; with ``quarantine_root`` the others
    go there with their reasons, and without it a batch that holds any fails,
    so no row is lost unseen. With ``summary_root`` the hourly summary is kept
    current for every observed hour that changed, however old. A trigger
    takes at most ``max_files`` new files; ``availableNow`` runs as many
    triggers as there is data for."""
    stamp = processed_at or datetime.now(timezone.utc).isoformat()

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        keys = touched_hours(batch)
        if not keys:
            return
        session = batch.sparkSession
        hours = [_run_hour(k) for k in keys]
        full = read_raw(session, raw_root, run_hours=hours).persist()
        try:
            if not quarantine_root:
                counts = split_counts(full, ingest_rules()).first()
                if counts.invalid_count:
                    raise RuntimeError(f"{counts.invalid_count} records failed validation and there is "
                                       "no quarantine_root for them")
            log.info("batch %d: %d hours", batch_id, len(hours))
            write_partitions(processed_from_raw(full, stamp), processed_root)
            if quarantine_root:
                write_partitions(rejected_from_raw(full), quarantine_root, fmt="json")
        finally:
            full.unpersist()
        if summary_root:
            update_hourly_summary(session, processed_root, summary_root)

    w = (raw_stream(spark, raw_root, max_files).writeStream
         .foreachBatch(per_batch).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
