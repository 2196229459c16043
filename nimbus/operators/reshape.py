"""Unions, unpivots and key differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_batches(dfs: list[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from a batch reads NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def series_long(df: DataFrame, id_cols, value_cols, var_name: str = "metric",
                value_name: str = "reading", value_type: str = "double") -> DataFrame:
    """Wide -> long (U2, U3). ``value_cols`` is a list of names or a
    ``{column: label}`` mapping for the emitted ``var_name`` values."""
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    if not isinstance(value_cols, dict):
        value_cols = {c: c for c in value_cols}
    wide = df.select(*id_cols, *[F.col(c).cast(value_type).alias(lbl)
                                 for c, lbl in value_cols.items()])
    return wide.unpivot(id_cols, list(value_cols.values()), var_name, value_name)


def missing_keys(expected: DataFrame, actual: DataFrame, keys) -> DataFrame:
    """Keys of ``expected`` absent from ``actual`` (U4) as an anti-join.

    Both sides are reduced to distinct keys first (partial aggregation
    before the shuffle), so a key repeated in a third of ``actual`` ships
    once per map task rather than once per row.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (expected.select(*keys).distinct()
            .join(actual.select(*keys).distinct(), keys, "left_anti"))
