"""Processed-zone scans.

A reading lands in the partition of the hour it was processed in. That may be
long after it was observed and, where a station's clock runs ahead, before:
bounds on partitions follow from a time range only as far as the caller knows
how late and how early readings land (``max_lag_hours``, ``max_lead_hours``).
Without them every partition is read and the exact range filtered; with an
index of observed hours (``index_root``) only the partitions that hold the
range are, and nothing need be known.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbus.operators.filters import hour_of, partition_bounds, ts_literal
from nimbus.operators.validate import MALFORMED
from nimbus.schemas import PARTITION_COLS, PARTITION_FIELDS, PROCESSED
from nimbus.sources.footers import read_reconciled
from nimbus.sources.raw import hour_in, load_or_empty, partition_glob
from nimbus.sources.tolerant import CORRUPT, json_records, text_schema, type_records
from nimbus.sources.zone import window_partitions, zone_files

_RECORD = T.StructType([f for f in PROCESSED.fields if f.name not in PARTITION_COLS])


def _folders(root: str, start, end, max_lag_hours, max_lead_hours) -> str:
    """What to list: the folders of a bounded range, else the root. The glob
    names years, months, days and hours, so its length does not depend on the
    range."""
    if start is None or end is None or max_lag_hours is None or max_lead_hours is None:
        return root
    lo = hour_of(start) - datetime.timedelta(hours=max_lead_hours)
    hi = max(lo, hour_of(end) + datetime.timedelta(hours=max_lag_hours + 1))
    days = (hi.date() - lo.date()).days
    hours = range(24) if days else range(lo.hour, hi.hour + 1)
    stamps = [datetime.datetime.combine(lo.date() + datetime.timedelta(days=i), datetime.time())
              for i in range(days + 1)]
    return partition_glob(root, stamps, hours)


def _parquet(spark: SparkSession, root: str, path: str, merge_schema: bool, keep) -> DataFrame:
    """Files of one physical type for each column, the declared one."""
    schema = PROCESSED
    if merge_schema:
        found = load_or_empty(spark, spark.read.option("mergeSchema", "true"), root, path,
                              PROCESSED, "parquet").schema
        have = set(PROCESSED.fieldNames())
        schema = T.StructType([*_RECORD.fields, *[f for f in found.fields if f.name not in have], *PARTITION_FIELDS])
    return keep(load_or_empty(spark, spark.read.schema(schema), root, path, schema, "parquet"))


def _whole(spark: SparkSession, root: str, path: str, fmt: str, merge_schema: bool, keep) -> DataFrame:
    """Every row with what of it could not be read (``_malformed``)."""
    if fmt == "json":
        df = load_or_empty(spark, json_records(spark.read, _RECORD, PARTITION_FIELDS), root, path,
                           text_schema(_RECORD, PARTITION_FIELDS), "json")
        return type_records(keep(df), _RECORD, PARTITION_COLS)
    # File names only: those of the partitions that are read.
    paths = [r.path for r in keep(zone_files(spark, root)).select("path").collect()]
    return read_reconciled(spark, root, paths, PROCESSED, merge_schema)


def _in_range(df: DataFrame, ts: str, start, end) -> DataFrame:
    t = F.col(ts).try_cast("timestamp")
    if start is not None:
        df = df.filter(t >= ts_literal(start))
    if end is not None:
        df = df.filter(t < ts_literal(end))
    return df


def read_processed(spark: SparkSession, root: str, start=None, end=None,
                   max_lag_hours: int | None = None, fmt: str = "parquet",
                   ts: str = "observed_at", merge_schema: bool = False,
                   max_lead_hours: int | None = None, index_root: str | None = None,
                   reconcile: bool = False) -> DataFrame:
    """Processed readings, optionally limited to event times in ``[start, end)``.

    Spark does not derive partition bounds from ``observed_at``: they come
    from the index or from what the caller knows (see above); with both ends
    and both bounds given, only those folders are listed at all. The
    schema is the declared one in every flavour (a column missing from a file
    reads NULL); ``merge_schema`` adds columns beyond it that Parquet files
    hold. ``reconcile`` reads Parquet files of different physical types. A
    zone that does not exist yet has no rows.

    JSON and reconciled files may hold values and lines that do not fit the
    schema: rows with such a value are not returned here but by
    ``processed_rejects``; each row of the zone is in one of the two.
    """
    if index_root is not None and (start is not None or end is not None):
        hours = window_partitions(spark, root, index_root, lambda h: _hours(spark, root, h, fmt, reconcile), start, end)
        df = read_processed_hours(spark, root, hours, fmt, reconcile, merge_schema)
        return _in_range(df, ts, start, end)
    path = _folders(root, start, end, max_lag_hours, max_lead_hours)
    bounds = partition_bounds(start, end, max_lag_hours, max_lead_hours)
    keep = (lambda df: df) if bounds is None else (lambda df: df.filter(bounds))
    if fmt == "parquet" and not reconcile:
        return _in_range(_parquet(spark, root, path, merge_schema, keep), ts, start, end)
    return _in_range(_clean(_whole(spark, root, path, fmt, merge_schema, keep)), ts, start, end)


def _clean(df: DataFrame) -> DataFrame:
    return df.where(F.col(MALFORMED) == "").drop(MALFORMED, CORRUPT)


def processed_rejects(spark: SparkSession, root: str, fmt: str = "json",
                      hours: list[datetime.datetime] | None = None) -> DataFrame:
    """The rows that ``read_processed`` leaves out: broken lines with their
    text (``_corrupt_record``, JSON), and rows with a value that does not fit
    the schema, named in ``_malformed``."""
    path = root if hours is None else partition_glob(root, hours)
    keep = (lambda df: df) if hours is None else (lambda df: df.where(hour_in(hours)))
    return _whole(spark, root, path, fmt, False, keep).where(F.col(MALFORMED) != "")


def read_processed_hours(spark: SparkSession, root: str, hours: list[datetime.datetime], fmt: str = "parquet",
                         reconcile: bool = False, merge_schema: bool = False) -> DataFrame:
    """Processed readings of the given processing hours; only their folders
    are listed."""
    if not hours:
        return spark.createDataFrame([], PROCESSED)
    path, keep = partition_glob(root, hours), lambda df: df.where(hour_in(hours))
    if fmt == "parquet" and not reconcile:
        return _parquet(spark, root, path, merge_schema, keep)
    if fmt == "parquet":
        paths = [r.path for r in zone_files(spark, root, hours).select("path").collect()]
        return _clean(read_reconciled(spark, root, paths, PROCESSED, merge_schema))
    return _clean(_whole(spark, root, path, fmt, merge_schema, keep))


def _hours(spark: SparkSession, root: str, hours, fmt: str = "parquet", reconcile: bool = False) -> DataFrame:
    return read_processed(spark, root, fmt=fmt, reconcile=reconcile) if hours is None else read_processed_hours(spark, root, hours, fmt, reconcile)
