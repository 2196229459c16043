"""Parquet files of different physical types as one table.

A zone whose runs inferred their types holds ``humidity_pct`` as INT64 in one
file and DOUBLE in the next; Spark's reader takes one type for all files and
fails on the others. Each file's own types stand in its footer. Files are
grouped by them, each group is read with its own types, typed to the declared
schema by the rules of ``sources.tolerant`` (a whole decimal is an integer, a
fraction in an integer field is malformed), and the groups are united by name.

Footers are read by the driver, a few at a time: metadata of the files that
the query reads anyway, so callers bound them by partitions.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbus.operators.validate import MALFORMED
from nimbus.schemas import PARTITION_COLS
from nimbus.sources.tolerant import cast_number

FOOTERS_AT_ONCE = 16


def footer_types(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Files by the types that their footers state."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path, file, reader = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.parquet.hadoop.util.HadoopInputFile, jvm.org.apache.parquet.hadoop.ParquetFileReader

    def types(p: str) -> str:
        opened = reader.open(file.fromPath(path(p), conf))
        try:
            return opened.getFileMetaData().getSchema().toString()
        finally:
            opened.close()

    out: dict[str, list[str]] = {}
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        for p, t in zip(paths, pool.map(types, paths), strict=True):
            out.setdefault(t, []).append(p)
    return out


def _as_declared(f: T.StructField, have: T.DataType | None) -> tuple[Column, Column | None]:
    """A column as declared, and its name where a value could not be."""
    if have is None:
        return F.lit(None).cast(f.dataType).alias(f.name), None
    c = F.col(f"`{f.name}`")
    if have == f.dataType:
        return c.alias(f.name), None
    if isinstance(f.dataType, T.StringType):
        return c.cast("string").alias(f.name), None
    cast = cast_number(c, f.dataType)
    return cast.alias(f.name), F.when(c.isNotNull() & cast.isNull(), F.lit(f.name))


def read_reconciled(spark: SparkSession, root: str, paths: list[str], schema: T.StructType, merge: bool = False) -> DataFrame:
    """The files ``paths`` of a partitioned zone with the columns of
    ``schema`` (``merge``: and further ones that files hold), and
    ``_malformed``: the columns whose value did not fit, '' if none."""
    groups, extra = [], {}
    for same in footer_types(spark, sorted(paths)).values():
        have = {f.name: f for f in spark.read.parquet(same[0]).schema.fields if f.name not in PARTITION_COLS}
        groups.append((same, have))
        if merge:
            for name, f in have.items():
                if name not in schema.fieldNames():
                    # Where files disagree on a column that is not declared, its text is kept.
                    extra[name] = f.dataType if extra.get(name, f.dataType) == f.dataType else T.StringType()
    fields = [f for f in schema.fields if f.name not in PARTITION_COLS] + [T.StructField(n, t) for n, t in sorted(extra.items())]
    parts = [f for f in schema.fields if f.name in PARTITION_COLS]
    out = None
    for same, have in groups:
        own = T.StructType([f for f in have.values() if f.name in {x.name for x in fields}] + parts)
        df = spark.read.schema(own).option("basePath", root).parquet(*same)
        cols = [_as_declared(f, have[f.name].dataType if f.name in have else None) for f in fields]
        bad = F.concat_ws(",", *[b for _, b in cols if b is not None])
        df = df.select(*[c for c, _ in cols], *[p.name for p in parts], bad.alias(MALFORMED))
        out = df if out is None else out.unionByName(df)
    if out is None:
        return spark.createDataFrame([], T.StructType([*fields, *parts, T.StructField(MALFORMED, T.StringType())]))
    return out
