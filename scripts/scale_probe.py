"""Hot-key probe: the same operators on uniform and on skewed data.

Derives a larger frame from the driver's ``events`` table (replicated
``--rep`` times with user ids offset per copy), then a skewed copy in which
a third of all rows belong to one user. Each operator runs into the
``noop`` sink on both; comparable times mean no hot-key straggler.

Usage: python scripts/scale_probe.py [sf_dir] [rep]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from nimbus.operators.latest import first_k_per_group, latest_per_key  # noqa: E402
from nimbus.operators.snapshot import hour_over_hour  # noqa: E402
from nimbus.operators.summary import Metric, dominant_label, hourly_summary  # noqa: E402
from nimbus.session import get_session  # noqa: E402

OPS = {
    "hourly_summary": lambda df: hourly_summary(
        df, ["user_id"], "ts", [Metric("avg_value", "exact_avg", "value", 2),
                                Metric("max_value", "max", "value")],
        label="event_type", label_col="dominant", profile="raw"),
    "latest_per_key": lambda df: latest_per_key(df, ["user_id"], [F.col("ts").desc(),
                                                                  F.col("event_id").desc()]),
    "first_k_per_group": lambda df: first_k_per_group(df, "user_id", ["ts", "event_id"], 3),
    "dominant_label": lambda df: dominant_label(df, ["user_id"], "event_type"),
    "hour_over_hour": lambda df: hour_over_hour(df, ["user_id"], "ts", "value", scale=2),
}


def _customer_join(customer):
    """events x customer as a sort-merge join (the plan at scale, where the
    customer side exceeds the broadcast threshold)."""
    def op(df):
        key = F.pmod(F.col("user_id"), F.lit(1_000_000))
        return df.join(customer.hint("merge"), key == F.col("c_custkey"))
    return op


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    rep = int(sys.argv[2]) if len(sys.argv) > 2 else 30
    # AQE's skew thresholds scaled down to this data size (defaults: 256MB, 5x median)
    spark = get_session("local[8]", 64, app_name="nimbus-scale-probe", conf={
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4MB"})
    spark.sparkContext.setLogLevel("ERROR")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    ops = dict(OPS, customer_join_smj=_customer_join(customer))
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    big = (ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(rep - 1))))
             .withColumn("event_id", F.col("event_id") * rep + F.col("copy"))
             .withColumn("user_id", F.col("user_id") + F.col("copy") * 1_000_000)
             .drop("copy"))
    uniform = big.repartition(64).persist()
    skewed = big.withColumn(
        "user_id", F.when(F.pmod(F.col("event_id"), 3) == 0, F.lit(1)).otherwise(F.col("user_id"))
    ).repartition(64).persist()
    n = uniform.count()
    hot = skewed.filter("user_id = 1").count()
    print(f"rows={n} hot_user_rows={hot} ({hot / n:.0%})")
    print("| operator | uniform s | one user = 1/3 of rows s |")
    print("| --- | --- | --- |")
    for name, op in ops.items():
        res = []
        for df in (uniform, skewed):
            op(df).write.format("noop").mode("overwrite").save()      # warm-up
            best = min(_timed(op, df) for _ in range(2))
            res.append(best)
        print(f"| {name} | {res[0]:.2f} | {res[1]:.2f} |")


def _timed(op, df) -> float:
    t0 = time.perf_counter()
    op(df).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


if __name__ == "__main__":
    main()
