"""Exact quantiles by distributed order statistics.

Equal values of a key are counted first (combined before the shuffle). For a
key of ordinary size the running count in the order of its values places each
value, and the two values around a probability are picked. A key of more than
``hot_rows`` rows would bring all its values into one ordered task, so such
keys take another way to the same numbers: their (key, value) pairs are
dealt out by range, which cuts a hot key into even, ordered pieces; the pieces'
totals (one row for each key and piece) give every piece the rank it starts
at; and the running counts then run within the pieces. Both ways give the
same doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Rows of a key above which its values are ordered in pieces.
HOT_ROWS = 5_000_000


def _pick(placed: DataFrame, key: str, probs, names) -> DataFrame:
    """Quantiles from ``key, _v, _n, _to, _all``: ``_to`` is the number of
    values up to and with this one, ``_all`` the key's."""

    def at(place: Column) -> Column:
        # The value whose run of equal values covers a place (from 0).
        return F.max(F.when((place >= F.col("_to") - F.col("_n")) & (place < F.col("_to")), F.col("_v")))

    aggs = []
    for i, p in enumerate(probs):
        place = (F.col("_all") - 1) * float(p)
        aggs += [at(F.floor(place)).alias(f"_l{i}"), at(F.ceil(place)).alias(f"_h{i}"),
                 F.max(place - F.floor(place)).alias(f"_f{i}")]
    r = placed.groupBy(key).agg(*aggs)
    return r.select(key, *[(F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * F.col(f"_f{i}")).alias(n)
                           for i, n in enumerate(names)])


def _in_one_order(counted: DataFrame, key: str) -> DataFrame:
    by_key = Window.partitionBy(key)
    upto = F.sum("_n").over(by_key.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    return counted.withColumn("_to", upto).withColumn("_all", F.sum("_n").over(by_key))


def _in_pieces(counted: DataFrame, key: str, pieces: int) -> DataFrame:
    # A written table: the ranges are drawn from a sample, so a piece computed
    # again after a lost executor must not have other bounds.
    dealt = (counted.repartitionByRange(pieces, key, "_v").withColumn("_piece", F.spark_partition_id())).checkpoint()
    totals = dealt.groupBy(key, "_piece").agg(F.sum("_n").alias("_in"))
    before = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(key, "_piece", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_start"),
                           F.sum("_in").over(Window.partitionBy(key)).alias("_all"))
    within = Window.partitionBy(key, "_piece").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    run = dealt.withColumn("_to", F.sum("_n").over(within))
    joined = run.join(starts.withColumnsRenamed({key: "_k", "_piece": "_p"}), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_piece") == F.col("_p")))
    return joined.select(key, "_v", "_n", (F.col("_to") + F.col("_start")).alias("_to"), "_all")


def exact_quantiles(df: DataFrame, key: str, value: str, probs, names, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``key`` and one column for each probability, interpolated like
    ``quantile_cont``. NULL values do not count; a key without any other gets
    NULLs."""
    rows = df.select(F.col(key), F.col(value).alias("_v"))
    counted = rows.groupBy(key, "_v").agg(F.count("_v").alias("_n"))  # NULL counts 0
    hot = rows.groupBy(key).agg(F.count("_v").alias("_rows")).where(F.col("_rows") > hot_rows).select(F.col(key).alias("_hot"), F.lit(True).alias("_is"))
    if hot.isEmpty():
        return _pick(_in_one_order(counted, key), key, probs, names)
    told = counted.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left").drop("_hot")
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (_pick(_in_one_order(told.where(F.col("_is").isNull()).drop("_is"), key), key, probs, names)
            .unionByName(_pick(_in_pieces(told.where(F.col("_is") & (F.col("_n") > 0)).drop("_is"), key, pieces), key, probs, names)))
