"""Latest row per key.

``row_number() = 1`` over a key window. Catalyst rewrites the filtered window
into a partial ``WindowGroupLimit`` before the shuffle, so each map task ships
at most one row per key: a hot key does not pull all of its rows into one task.
Ties are kept by joining the keys' latest order values back (``keep_ties``): a
key that is all ties may be a third of the rows, and a skewed join is split
where a window is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order_cols(order) -> list[Column]:
    """Names sort descending (latest first); Columns are used as given."""
    if isinstance(order, (str, Column)):
        order = [order]
    return [F.col(o).desc() if isinstance(o, str) else o for o in order]


def latest_per_key(df: DataFrame, keys, order, keep_ties: bool = False,
                   rank_col: str | None = None) -> DataFrame:
    """One row per ``keys`` by ``order``; with ``keep_ties`` every row tied on
    ``order`` is kept (the join-back form of the SQL model).

    Give ``order`` a total order (e.g. ``observed_at`` then ``fetched_at``)
    for a deterministic pick.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if keep_ties:
        return _with_ties(df, keys, [order] if isinstance(order, (str, Column)) else list(order))
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    tmp = rank_col or "_latest_rank"
    out = df.withColumn(tmp, F.row_number().over(w)).filter(F.col(tmp) == 1)
    return out if rank_col else out.drop(tmp)


def _with_ties(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Every row tied on ``order`` (column names, latest first, NULL last)."""
    if not all(isinstance(o, str) for o in order):
        raise ValueError("keep_ties takes the names of the order columns, latest first")
    # NULL is smallest in a struct: a key of NULLs only keeps them all.
    latest = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_at"))
    at = latest.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col("_at")[o].alias(f"_o{i}") for i, o in enumerate(order)])
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col(o).eqNullSafe(F.col(f"_o{i}")) for i, o in enumerate(order)]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return df.join(at, on).select(*df.columns)


def first_k_per_group(df: DataFrame, keys, order, k: int,
                      rank_col: str = "rank") -> DataFrame:
    """First ``k`` rows per group by ``order`` (W4, O4), with their rank.

    Same partial-limit plan as ``latest_per_key``: at most ``k`` rows per key
    leave each map task (Catalyst inserts the partial limit for ``k`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000 by default).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if isinstance(order, (str, Column)):
        order = [order]
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(*keys).orderBy(*cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
