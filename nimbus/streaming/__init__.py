"""Structured Streaming jobs (T1-T3); T4 backfill is ``plans.jobs.backfill``."""

from nimbus.streaming.ingest import ingest_stream, raw_stream
from nimbus.streaming.windows import (LateRows, compact, dedup_stream, dedup_to_table, deduplicated, drain, dropped_late,
                                      hourly_stream, hourly_stream_closed, read_latest, run_to_table)

__all__ = ["LateRows", "compact", "ingest_stream", "raw_stream", "dedup_stream", "dedup_to_table", "deduplicated", "drain",
           "dropped_late", "hourly_stream", "hourly_stream_closed", "read_latest", "run_to_table"]
