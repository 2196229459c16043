"""Helpers shared by the text operators.

* ``prepare`` sets the session for text-sized Arrow batches and ships the
  package to the executors.
* ``staged`` writes an intermediate result to the shared checkpoint folder
  and reads it back: the lineage ends there, so a lost executor costs the
  tasks of the running job only, and the shuffle files before it can go. Once
  a result is written, ``remove_staged`` removes the folders it came from.
* ``doc_rows`` gives the two-column key the operators join on. Rows with the
  same ``doc_id`` and the same text are one document given several times;
  rows with the same ``doc_id`` and different texts are different documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nimbus.session import ship_package, work_dir

# Rows of an Arrow batch: texts are long, so a batch holds fewer of them.
BATCH_ROWS = 500
# Stands for a missing doc_id inside join keys; sorts before every other id.
NO_ID = -(2 ** 63)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    """Session settings of the text operators."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)


# Folders written by ``staged``, by application.
_made: dict[str, list[str]] = {}


def staged_folders(spark: SparkSession) -> list[str]:
    """The folders that ``staged`` has written and nobody has removed."""
    return list(_made.get(spark.sparkContext.applicationId, ()))


def remove_staged(spark: SparkSession, folders: list[str]) -> None:
    """Remove staged folders that no table is read from any more."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    for f in folders:
        path(f).getFileSystem(conf).delete(path(f), True)
        _made[spark.sparkContext.applicationId].remove(f)


def staged(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint folder and
    return the written table. The job's shuffle files are removed when it
    ends (its result no longer needs them). The folder is appended to
    ``made``."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(col: str = "doc_id") -> Column:
    """``doc_id`` as a non-null long."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NO_ID))


def key_to_id(col: Column) -> Column:
    return F.when(col != F.lit(NO_ID), col)


def doc_rows(docs: DataFrame) -> DataFrame:
    """``did, rk, text``: the key of a document and its text (null: empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(id_key().alias("did"), F.xxhash64(id_key(), text).alias("rk"),
                       text.alias("text"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n += "_"
        out.append(n)
    return out


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
