"""Scans and sinks: raw JSON zone, processed Parquet zone, keyed fetch,
partition-safe writers, catalog registration and retention."""

from nimbus.sources.keyed import collect_keyed, payload_readings, register_keyed_source
from nimbus.sources.processed import read_processed
from nimbus.sources.raw import read_mixed_json, read_payload, read_raw
from nimbus.sources.sinks import (expire_partitions, materialize, overwrite_hour, refresh_table,
                                  register_table, write_partitions, write_raw)

__all__ = ["collect_keyed", "payload_readings", "register_keyed_source", "read_processed",
           "read_mixed_json", "read_payload", "read_raw", "expire_partitions", "materialize",
           "overwrite_hour", "refresh_table", "register_table", "write_partitions", "write_raw"]
