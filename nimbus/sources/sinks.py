"""Sinks, catalog registration and retention.

Re-runs must be idempotent: an hour is always rewritten whole. Writers
use the ``rebalance`` hint on the partition columns: AQE groups rows of an
hour together (few files per hour, not one per input split) and splits an
oversized hour into several tasks of the advisory size, so a hot hour is
never written by a single task.
"""

from __future__ import annotations

import datetime
import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nimbus.functions._util import observed
from nimbus.operators.enrich import run_hour_parts
from nimbus.operators.filters import ts_literal
from nimbus.schemas import PARTITION_COLS
from nimbus.sources.footers import footer_types
from nimbus.sources.raw import partition_glob
from nimbus.sources.zone import zone_files

DELETES_AT_ONCE = 16
# Table property: some hours stand beside the table's folder (``replace_hours``).
VERSIONED = "nimbus.versioned"


def with_run_hour(df: DataFrame, run_hour: str) -> DataFrame:
    """Partition ints from the run hour (unpadded on write)."""
    return df.withColumns({k: F.lit(v) for k, v in run_hour_parts(run_hour).items()})


def _by_partition(df: DataFrame) -> DataFrame:
    return df.hint("rebalance", *PARTITION_COLS)


def write_raw(df: DataFrame, root: str, run_hour: str | None = None) -> None:
    """Append JSON lines under ``year/month/day/hour``."""
    if run_hour is not None:
        df = with_run_hour(df, run_hour)
    _by_partition(df).write.mode("append").partitionBy(*PARTITION_COLS).json(root)


def _folders(spark: SparkSession, root: str, hours) -> dict[tuple, list]:
    """The folders of ``hours`` (year, month, day, hour), whichever way they
    are spelled (``month=3``, ``month=03``). Looks only where these hours can
    stand, never through the zone."""
    hours = {tuple(h) for h in hours}
    if not hours:
        return {}
    path = spark._jvm.org.apache.hadoop.fs.Path
    glob = partition_glob(root, [datetime.datetime(*h) for h in hours])
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[tuple, list] = {}
    for status in fs.globStatus(path(glob)) or []:
        hour = tuple(int(x) for x in re.findall(r"(?:year|month|day|hour)=(\d+)", str(status.getPath()))[-4:])
        if hour in hours:
            out.setdefault(hour, []).append(status.getPath())
    return out


def delete_folders(spark: SparkSession, folders: list) -> None:
    """Delete folders, several at a time."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()

    def drop(folder) -> None:
        p = path(folder) if isinstance(folder, str) else folder
        p.getFileSystem(conf).delete(p, True)

    with ThreadPoolExecutor(DELETES_AT_ONCE) as pool:
        list(pool.map(drop, folders))


def remove_hours(spark: SparkSession, root: str, hours) -> None:
    """Remove the folders of ``hours`` (year, month, day, hour)."""
    delete_folders(spark, [f for found in _folders(spark, root, hours).values() for f in found])


def _is_padded(folder) -> bool:
    return any(x != str(int(x)) for x in re.findall(r"(?:year|month|day|hour)=(\d+)", str(folder))[-4:])


def _written(df: DataFrame, write) -> set[tuple]:
    """Run ``write`` on ``df`` and return the hours it held, noted while it
    was written."""
    obs = Observation(f"hours-{uuid.uuid4().hex[:8]}")
    write(_by_partition(df.observe(obs, F.collect_set(F.struct(*PARTITION_COLS)).alias("hours"))))
    return {tuple(r) for r in (observed(obs) or {}).get("hours") or []}


def write_partitions(df: DataFrame, root: str, fmt: str = "parquet") -> set[tuple]:
    """Dynamic partition overwrite: every hour present in ``df`` is replaced
    whole, other hours are untouched (S8, S12), whichever way its folder is
    spelled (``month=3``, ``month=03``). An hour absent from ``df``
    keeps its old files; use ``overwrite_hour`` for an hour that may be empty.
    Returns the hours written. For readers that must never see an hour half
    replaced, use ``replace_hours``.
    """
    def write(x: DataFrame) -> None:
        (x.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy" if fmt == "parquet" else "none")
            .partitionBy(*PARTITION_COLS).format(fmt).save(root))

    hours = _written(df, write)
    spark = df.sparkSession
    # An hour stands in one folder only: the one just written is not padded.
    delete_folders(spark, [f for found in _folders(spark, root, hours).values() for f in found if _is_padded(f)])
    return hours


def register_table(spark: SparkSession, name: str, root: str, schema, fmt: str = "parquet",
                   recover: bool = False, recover_on_create: bool = True) -> None:
    """External partitioned table over ``root`` (S9): create on first use
    (picking up the hour folders already there), add new columns on later
    runs. Later hours are registered by the writes themselves (static
    partition overwrite), so the full folder listing of ``RECOVER
    PARTITIONS`` runs only at creation or when asked (crawler-style repair).
    """
    data_cols = [f for f in schema.fields if f.name not in PARTITION_COLS]
    if not spark.catalog.tableExists(name):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data_cols)
        parts = ", ".join(f"`{c}` int" for c in PARTITION_COLS)
        spark.sql(f"CREATE TABLE {name} ({cols}, {parts}) USING {fmt} "
                  f"PARTITIONED BY ({', '.join(PARTITION_COLS)}) LOCATION '{root}'")
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        recover = there and (recover or recover_on_create)
    else:
        have = {f.name for f in spark.table(name).schema.fields}
        new = [f for f in data_cols if f.name not in have]
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ("
                      + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")
    if recover:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _partition_spec(run_hour: str) -> str:
    return ", ".join(f"{k}={v}" for k, v in run_hour_parts(run_hour).items())


def overwrite_hour(spark: SparkSession, table: str, df: DataFrame, run_hour: str) -> None:
    """Replace one hour of a registered table with ``df`` (static partition
    spec), so an empty ``df`` really empties the hour (S8 re-run guard)."""
    cols = [f.name for f in spark.table(table).schema.fields if f.name not in PARTITION_COLS]
    view = f"_nimbus_{table.replace('.', '_')}_hour"
    src = df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in cols])
    src.createOrReplaceTempView(view)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({_partition_spec(run_hour)}) "
              f"SELECT {', '.join(f'`{c}`' for c in cols)} FROM {view}")
    spark.catalog.dropTempView(view)


def clear_hours(spark: SparkSession, root: str, run_hours: list[str]) -> None:
    """Empty hours of a path-based zone (S8 re-run guard without a table): a
    dynamic overwrite cannot empty an hour."""
    remove_hours(spark, root, [tuple(run_hour_parts(h).values()) for h in run_hours])


def empty_hours(spark: SparkSession, table: str, run_hours: list[str]) -> None:
    """Empty hours of a registered table (its files and catalog entries)."""
    _empty_partitions(spark, table, [run_hour_parts(h) for h in run_hours])


def _spec(p: dict) -> str:
    return "PARTITION (" + ", ".join(f"{c}={p[c]}" for c in PARTITION_COLS) + ")"


def table_root(spark: SparkSession, table: str) -> str:
    found = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()
    return found["data_type"].rstrip("/")


def partition_location(spark: SparkSession, table: str, p: dict) -> str:
    """Where a registered hour stands (not below the table's folder if it was
    replaced by ``replace_hours`` or is spelled with leading zeros)."""
    return spark.sql(f"DESCRIBE FORMATTED {table} {_spec(p)}").where("col_name = 'Location'").first()["data_type"]


def _registered(spark: SparkSession, table: str) -> DataFrame:
    """The partition ints of a table's catalog entries."""
    parts = spark.sql(f"SHOW PARTITIONS {table}")
    kv = F.split(F.col("partition"), "/")
    return parts.select(*[F.split(kv[i], "=")[1].cast("int").alias(c) for i, c in enumerate(PARTITION_COLS)])


def _empty_partitions(spark: SparkSession, table: str, parts: list[dict]) -> None:
    """Remove the files of partitions: their folders are deleted through the
    file system that holds them, several at a time, and the entries dropped
    in one statement. Works on partition metadata only."""
    if not parts:
        return
    hours = spark.createDataFrame([tuple(p[c] for c in PARTITION_COLS) for p in parts], ", ".join(f"{c} int" for c in PARTITION_COLS))
    known = [r.asDict() for r in _registered(spark, table).join(hours, PARTITION_COLS, "left_semi").collect()]
    root = table_root(spark, table)
    # Under the table's own folder, however spelled, and wherever else an entry points to.
    own = [str(f) for found in _folders(spark, root, [tuple(p[c] for c in PARTITION_COLS) for p in parts]).values() for f in found]
    versioned = spark.sql(f"SHOW TBLPROPERTIES {table}").where(f"key = '{VERSIONED}'").count() > 0
    delete_folders(spark, own + ([partition_location(spark, table, p) for p in known] if versioned else []))
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(map(_spec, parts))}")


# ---------------------------------------------------------------- atomic replacement

def stage_hours(df: DataFrame, table: str) -> tuple[str, set[tuple]]:
    """Write hours beside a registered table, where no reader looks: the
    folder and the hours in it."""
    spark = df.sparkSession
    folder = f"{table_root(spark, table)}/_versions/{uuid.uuid4().hex[:16]}"
    cols = [c for c in spark.table(table).columns if c not in PARTITION_COLS]
    fmt = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Provider'").first()["data_type"].lower()
    src = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(spark.table(table).schema[c].dataType).alias(c) for c in cols], *PARTITION_COLS)
    return folder, _written(src, lambda x: x.write.partitionBy(*PARTITION_COLS).format(fmt).save(folder))


def publish_hours(spark: SparkSession, table: str, folder: str, hours: set[tuple]) -> list[str]:
    """Point the table's hours at the folders of ``stage_hours``; returns the
    folders they pointed at before. New hours appear in one statement, every
    other one is switched by its own: at each moment an hour is the old
    one or the new one. No folder of the zone is listed."""
    if not hours:
        return []
    wanted = spark.createDataFrame([tuple(h) for h in sorted(hours)], ", ".join(f"{c} int" for c in PARTITION_COLS))
    known = {tuple(r) for r in _registered(spark, table).join(wanted, PARTITION_COLS, "left_semi").collect()}
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{VERSIONED}' = 'true')")

    def at(h: tuple) -> tuple[dict, str]:
        p = dict(zip(PARTITION_COLS, h, strict=True))
        return p, f"{folder}/" + "/".join(f"{c}={v}" for c, v in p.items())

    new = [at(h) for h in sorted(hours - known)]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"{_spec(p)} LOCATION '{where}'" for p, where in new))
    before = []
    for p, where in map(at, sorted(known)):
        before.append(partition_location(spark, table, p))
        spark.sql(f"ALTER TABLE {table} {_spec(p)} SET LOCATION '{where}'")
    return before


def replace_hours(df: DataFrame, table: str, keep_old: bool = False) -> set[tuple]:
    """Replace every hour present in ``df`` in a registered table, atomically
    for its readers: the hours are written beside, then the catalog entries
    are switched, then (unless ``keep_old``, for readers still at work) the old
    folders go. A run that dies before the switch has changed nothing; one
    that dies within it leaves each hour whole, old or new."""
    spark = df.sparkSession
    folder, hours = stage_hours(df, table)
    before = publish_hours(spark, table, folder, hours)
    spark.catalog.refreshTable(table)
    if not keep_old:
        delete_folders(spark, before)
    return hours


# ---------------------------------------------------------------- reconciliation

def catalog_diff(spark: SparkSession, table: str) -> DataFrame:
    """Where a table's catalog entries and its folders differ, a row each:
    partition ints, ``status`` and ``folder``.

    * ``new``: a folder without an entry (spelled with leading zeros or not);
    * ``vanished``: an entry whose folder is gone;
    * ``double``: an hour in several folders, which no entry can name together.
    """
    files = zone_files(spark, table_root(spark, table)).where(~F.col("path").contains("/_versions/"))
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    there = files.groupBy(*PARTITION_COLS).agg(F.min(folder).alias("folder"), F.count_distinct(folder).alias("folders"))
    both = there.join(_registered(spark, table).withColumn("known", F.lit(True)), PARTITION_COLS, "full")
    status = F.when(F.col("folders") > 1, "double").when(F.col("known").isNull(), "new").when(F.col("folder").isNull(), "vanished")
    found = both.select(*PARTITION_COLS, status.alias("status"), "folder").where(F.col("status").isNotNull())
    if spark.sql(f"SHOW TBLPROPERTIES {table}").where(f"key = '{VERSIONED}'").count() == 0:
        return found
    # Hours replaced beside the table's folder: gone only if the folder they point to is.
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    kept = []
    for r in found.where("status = 'vanished'").select(*PARTITION_COLS).collect():  # partition names
        p = path(partition_location(spark, table, r.asDict()))
        if p.getFileSystem(conf).exists(p):
            kept.append(tuple(r))
    return found.join(spark.createDataFrame(kept, ", ".join(f"{c} int" for c in PARTITION_COLS)), PARTITION_COLS, "left_anti") if kept else found


def type_conflicts(spark: SparkSession, table: str) -> DataFrame:
    """Columns whose type in some files is not the table's: ``column_name,
    declared, found, files``."""
    root = table_root(spark, table)
    declared = {f.name: f.dataType for f in spark.table(table).schema.fields}
    rows: dict[tuple, int] = {}
    for same in footer_types(spark, [r.path for r in zone_files(spark, root).select("path").collect()]).values():
        for f in spark.read.parquet(same[0]).schema.fields:
            if f.name in declared and f.dataType != declared[f.name]:
                key = (f.name, declared[f.name].simpleString(), f.dataType.simpleString())
                rows[key] = rows.get(key, 0) + len(same)
    return spark.createDataFrame([(*k, n) for k, n in rows.items()], "column_name string, declared string, found string, files long")


def reconcile_table(spark: SparkSession, table: str) -> DataFrame:
    """Make a table's catalog entries agree with its folders (S9, what a
    crawler does) and return what was found (``catalog_diff``): new folders
    are registered where they stand, entries without a folder dropped, hours
    in several folders reported only."""
    found = catalog_diff(spark, table).collect()  # partition metadata, the differences only
    spec = {s: [r for r in found if r.status == s] for s in ("new", "vanished")}
    if spec["new"]:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"{_spec(r.asDict())} LOCATION '{r.folder}'" for r in spec["new"]))
    if spec["vanished"]:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(_spec(r.asDict()) for r in spec["vanished"]))
    spark.catalog.refreshTable(table)
    return spark.createDataFrame([tuple(r) for r in found], ", ".join(f"{c} int" for c in PARTITION_COLS) + ", status string, folder string")


def expire_partitions(spark: SparkSession, table: str, before) -> DataFrame:
    """Drop hours older than ``before`` (S13): their folders are removed and
    their catalog entries dropped in one statement. Works from partition
    metadata (one row per hour), never from data rows, and starts no job per
    hour. Returns the dropped partitions."""
    old = _registered(spark, table).filter(F.make_timestamp_ntz(*[F.col(c) for c in PARTITION_COLS],
                                            F.lit(0), F.lit(0))
                       < ts_literal(before, "timestamp_ntz"))
    dropped = old.select(*PARTITION_COLS).collect()  # partition metadata only
    _empty_partitions(spark, table, [r.asDict() for r in dropped])
    return spark.createDataFrame(dropped, ", ".join(f"{c} int" for c in PARTITION_COLS))


def materialize(df: DataFrame, name: str, kind: str = "table") -> DataFrame:
    """Staging as a view, marts as tables."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def refresh_table(df: DataFrame, name: str) -> int:
    """Full refresh (CTAS) with its row count taken while writing."""
    obs = Observation(f"refresh_{name}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").saveAsTable(name)
    seen = observed(obs) or {}
    return int(seen["rows"]) if "rows" in seen else df.sparkSession.table(name).count()
