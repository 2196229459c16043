"""Raw-zone scans (S1-S3, S5): JSON lines under hive partitions.

Schemas are always declared. Partition columns are declared ``int`` so
``month=3`` and ``month=03`` read the same, and filters on them become
``PartitionFilters`` (whole directories skipped). We read the partition
*root* and filter; ``recursiveFileLookup`` would turn partition discovery
off.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbus.operators.filters import partition_bounds
from nimbus.operators.validate import MALFORMED
from nimbus.schemas import PARTITION_FIELDS, PAYLOAD, READING
from nimbus.sources.tolerant import CORRUPT, json_records, text_schema, type_records

__all__ = ["CORRUPT", "hour_in", "load_or_empty", "partition_glob", "read_mixed_json", "read_payload", "read_raw"]


def _alts(values, pad: bool) -> str:
    names = {str(v) for v in values} | ({f"{v:02d}" for v in values} if pad else set())
    return "{" + ",".join(sorted(names)) + "}"


def partition_glob(root: str, hours, day_hours=None) -> str:
    """One path glob covering the folders of ``hours`` (datetimes; with
    ``day_hours``, those hours of their days), in both
    directory spellings (``month=3`` / ``month=03``). It may also match a few
    neighbouring folders (year/month/day/hour sets are combined); callers
    filter on the exact partition values, so only the listing is widened."""
    hours = list(hours)
    return (f"{root.rstrip('/')}/year={_alts({h.year for h in hours}, False)}"
            f"/month={_alts({h.month for h in hours}, True)}"
            f"/day={_alts({h.day for h in hours}, True)}"
            f"/hour={_alts(set(day_hours) if day_hours is not None else {h.hour for h in hours}, True)}")


def read_raw(spark: SparkSession, root: str, run_hour: str | None = None,
             start=None, end=None, max_lag_hours: int | None = None,
             schema: T.StructType = READING, run_hours: list[str] | None = None,
             max_lead_hours: int | None = None) -> DataFrame:
    """Flat readings landed as JSON lines under ``year/month/day/hour``.

    Every field is read as text and typed with ``try_cast``: a malformed
    number becomes NULL and is named in ``_malformed`` (comma-separated,
    empty when the row parsed); an unparsable line
    keeps its text in ``_corrupt_record``. Lines holding a JSON array
    expand to one row per element; blank lines are skipped. Both go to
    quarantine through validation instead of failing the job.

    With ``run_hour`` (or ``run_hours``) only those hours' folders are
    listed (a path glob with ``basePath``, so the partition columns stay):
    an hourly job does not list years of history. Without them the root is
    listed once and filters on the partition ints prune the files read.
    """
    said = [T.StructField(MALFORMED, T.StringType()), *PARTITION_FIELDS]
    reader = json_records(spark.read, schema, said)
    hours = ([run_hour] if run_hour is not None else []) + list(run_hours or [])
    if hours:
        parsed = [_dt.datetime.strptime(h, "%Y-%m-%dT%H") for h in hours]
        df = load_or_empty(spark, reader, root, partition_glob(root, parsed),
                           text_schema(schema, said), "json")
        df = df.filter(hour_in(parsed))
    else:
        df = reader.json(root)
    bounds = partition_bounds(start, end, max_lag_hours, max_lead_hours)
    if bounds is not None:
        df = df.filter(bounds)
    return type_records(df, schema, [f.name for f in PARTITION_FIELDS])


def hour_in(hours) -> Column:
    """Exact partition predicate for a list of hours: comparisons on the bare
    partition columns, the hours of a day together."""
    days: dict[_dt.date, set[int]] = {}
    for h in hours:
        days.setdefault(h.date(), set()).add(h.hour)
    out = F.lit(False)
    for d, hrs in sorted(days.items()):
        out = out | ((F.col("year") == d.year) & (F.col("month") == d.month)
                     & (F.col("day") == d.day) & F.col("hour").isin(sorted(hrs)))
    return out


def load_or_empty(spark: SparkSession, reader, root: str, glob: str, empty_schema: T.StructType,
          fmt: str) -> DataFrame:
    try:
        return reader.option("basePath", root).format(fmt).load(glob)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], empty_schema)


def read_mixed_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Text whose lines are a JSON object or a JSON array of objects.

    Spark's JSON reader already expands a top-level array into rows; blank
    lines are skipped. Leaves are read as text and typed afterwards, so
    nothing is lost: see ``sources.tolerant`` for ``_malformed`` and
    ``_corrupt_record``, which follow the columns of ``schema``.
    """
    return type_records(json_records(spark.read, schema).json(path), schema)


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """Nested API documents (S3) with the declared payload schema, read like
    ``read_mixed_json``."""
    return type_records(json_records(spark.read, PAYLOAD).json(path), PAYLOAD)
