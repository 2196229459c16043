"""What a zone holds: its files as a table, and the hours its readings were
observed in.

A zone is partitioned by the hour its readings were processed in. Which
*observed* hours a partition holds cannot be told from its name: readings come
late, and stations' clocks run ahead, so a reading may even land before the
time it claims. Nothing here assumes anything of the kind. An index keeps,
for each partition, its observed hours and a signature of its files (names,
sizes, modification times). Comparing signatures with the zone's file listing
finds every partition that is new, changed or gone, whoever wrote it and
whether or not anyone announced it; only those are read again.

The listing is a DataFrame (the ``binaryFile`` source without its content:
Spark lists folders in parallel, no file is opened). The index is a few rows a
partition; each update writes it whole as a new version and makes it current
by one rename, after everything that depends on it has been written: a run
that dies before that finds the same changes again.
"""

from __future__ import annotations

import datetime
import re
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbus.operators.filters import hour_of
from nimbus.schemas import PARTITION_COLS, PARTITION_FIELDS
from nimbus.sources.raw import hour_in, partition_glob

FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("modified", T.TimestampType()),
                      T.StructField("length", T.LongType()), *PARTITION_FIELDS])
INDEX = T.StructType([T.StructField("observed_hour", T.TimestampType()), T.StructField("files", T.StringType()), *PARTITION_FIELDS])
_VERSION = re.compile(r"version=(\d+)")


def zone_files(spark: SparkSession, root: str, hours: list[datetime.datetime] | None = None) -> DataFrame:
    """``path, modified, length`` and partition ints of a zone's data files
    (of ``hours`` only, listing no other folders). A zone that does not exist
    has none."""
    path = root if hours is None else partition_glob(root, hours)
    try:
        found = spark.read.format("binaryFile").option("basePath", root).load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], FILES)
    if not set(PARTITION_COLS) <= set(found.columns):  # the root alone is there
        return spark.createDataFrame([], FILES)
    out = found.select("path", F.col("modificationTime").alias("modified"), "length", *[F.col(c).cast("int").alias(c) for c in PARTITION_COLS])
    return out if hours is None else out.where(hour_in(hours))


def partition_state(files: DataFrame) -> DataFrame:
    """A row for each partition: ``files``, a signature of its files."""
    each = F.xxhash64("path", "modified", "length")
    return files.groupBy(*PARTITION_COLS).agg(F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.bit_xor(each)).alias("files"))


# ---------------------------------------------------------------- versions

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, index_root: str) -> list[int]:
    fs, path = _fs(spark, index_root)
    if not fs.exists(path):
        return []
    found = (_VERSION.fullmatch(s.getPath().getName()) for s in fs.listStatus(path))
    return sorted(int(m[1]) for m in found if m)


def read_index(spark: SparkSession, index_root: str) -> DataFrame:
    """The current index (``observed_hour``, ``files``, partition ints)."""
    have = _versions(spark, index_root)
    if not have:
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).parquet(f"{index_root.rstrip('/')}/version={have[-1]}")


def _commit(spark: SparkSession, pending: str, index_root: str) -> None:
    """Make a written index current; the one before stays for its readers."""
    have = _versions(spark, index_root)
    fs, _ = _fs(spark, index_root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    number = have[-1] + 1 if have else 1
    if not fs.rename(path(pending), path(f"{index_root.rstrip('/')}/version={number}")):
        raise RuntimeError(f"{index_root}: version {number} was written by another run")
    for old in have[:-1]:
        fs.delete(path(f"{index_root.rstrip('/')}/version={old}"), True)


# ---------------------------------------------------------------- the index

@dataclass
class Changes:
    """What has changed since the index was written: the index as it should
    be, the observed hours concerned, and how to make the index current."""

    index: DataFrame
    observed: DataFrame
    partitions: int
    _pending: str
    _root: str

    def commit(self) -> None:
        if self.partitions:
            _commit(self.index.sparkSession, self._pending, self._root)


def _stamps(rows) -> list[datetime.datetime]:
    return [datetime.datetime(r.year, r.month, r.day, r.hour) for r in rows]


def find_changes(spark: SparkSession, root: str, index_root: str, read_hours, observed_at: str = "observed_at") -> Changes:
    """Compare the zone with its index. ``read_hours(hours)`` reads partitions
    of the zone (``None``: all of them)."""
    old = read_index(spark, index_root)
    now = partition_state(zone_files(spark, root))
    known = old.select("files", *PARTITION_COLS).distinct()
    both = now.select(*PARTITION_COLS, F.col("files").alias("now")).join(known.select(*PARTITION_COLS, F.col("files").alias("was")), PARTITION_COLS, "full")
    # One row for each partition that is new, changed or gone.
    moved = both.where(~F.col("now").eqNullSafe(F.col("was"))).collect()
    index_root = index_root.rstrip("/")
    if not moved:
        return Changes(old, old.select("observed_hour").limit(0), 0, "", index_root)
    first = old.isEmpty()
    schema = T.StructType([*PARTITION_FIELDS, T.StructField("files", T.StringType())])
    changed = spark.createDataFrame([(*(r[c] for c in PARTITION_COLS), r.now) for r in moved], schema)
    there = _stamps(r for r in moved if r.now is not None)
    hour = F.date_trunc("hour", F.col(observed_at).try_cast("timestamp")).alias("observed_hour")
    parts = changed.where(F.col("files").isNotNull())
    held = (read_hours(None if first else there).select(hour, *PARTITION_COLS).where(F.col("observed_hour").isNotNull()).distinct()
            if there else spark.createDataFrame([], INDEX).drop("files"))
    # A partition without any observed hour is known all the same.
    fresh = parts.join(held, PARTITION_COLS, "left").select(*INDEX.fieldNames())
    kept = old.join(changed.select(*PARTITION_COLS), PARTITION_COLS, "left_anti").select(*INDEX.fieldNames())
    pending = f"{index_root}/pending-{uuid.uuid4().hex[:12]}"
    kept.unionByName(fresh).coalesce(1).write.parquet(pending)
    index = spark.read.schema(INDEX).parquet(pending)
    of = index.join(parts.select(*PARTITION_COLS), PARTITION_COLS, "left_semi").select("observed_hour")
    before = old.join(changed.select(*PARTITION_COLS), PARTITION_COLS, "left_semi").select("observed_hour")
    observed = of.unionByName(before).where(F.col("observed_hour").isNotNull()).distinct()
    return Changes(index, observed, len(moved), pending, index_root)


def window_partitions(spark: SparkSession, root: str, index_root: str, read_hours, start=None, end=None) -> list[datetime.datetime]:
    """The partitions that hold readings observed in ``[start, end)``, by the
    index and, where the zone has moved on since, by the zone itself (the
    index is brought up to date on the way)."""
    changes = find_changes(spark, root, index_root, read_hours)
    changes.commit()
    index = read_index(spark, index_root)
    if start is not None:
        index = index.where(F.col("observed_hour") >= F.lit(hour_of(start).isoformat(sep=" ")).cast("timestamp"))
    if end is not None:
        index = index.where(F.col("observed_hour") <= F.lit(hour_of(end).isoformat(sep=" ")).cast("timestamp"))
    return sorted(_stamps(index.select(*PARTITION_COLS).distinct().collect()))  # partition names
