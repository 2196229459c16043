"""Connected components of a graph given as a table of links.

Large-star and small-star steps alternate (Kiveris et al., "Connected
Components in MapReduce and Beyond"): each links neighbours to the smallest
one, so the number of links never grows and chains shrink by halves. Every
step is an aggregation and a join; hubs are split by skew joins, and each
round ends in a table of the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbus.llm.common import staged


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links``: u > v. Link the larger (``large``) or smaller neighbours of
    each node to its smallest neighbour."""
    if large:
        near = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = links
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = near.join(least, "u")
    if large:
        out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (its smallest node) for nodes with a link."""
    now = staged(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "links")
    state = None
    while True:
        now = staged(_star(_star(now, large=True), large=False), "links")
        # Same links as before: every component is a star around its least node.
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == new:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = new
