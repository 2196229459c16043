"""Plan properties the design relies on at scale, plus a hot-key fixture.

The checks read ``explain()`` output, so a change that silently loses
partial aggregation, the partial window limit or scan pushdown fails here.
"""

from __future__ import annotations

import contextlib
import io
import random
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from nimbus.plans.registry import QUERIES
import __spark_entry__ as E
from conftest import new_dir, reading, write_lines
from nimbus.operators.latest import first_k_per_group, latest_per_key
from nimbus.operators.summary import Metric, hourly_summary
from nimbus.sources.raw import read_raw
from nimbus.sources.sinks import _by_partition

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def q():
    return E.queries()


def _before_exchange(text: str, needle: str) -> bool:
    """``needle`` appears in the plan below (i.e. before) the first Exchange."""
    lines = text.splitlines()
    ex = [i for i, ln in enumerate(lines) if "Exchange" in ln]
    hits = [i for i, ln in enumerate(lines) if needle in ln]
    return bool(ex and hits and max(hits) > min(ex))


def test_summary_aggregates_partially(spark, q):
    p = plan(q["hourly_summary"](spark, SF), "simple")
    # stage 1 over the raw rows: plain (codegen) hash aggregate, partial before its shuffle
    stage1 = [ln for ln in p.splitlines() if "partial_sum(cast(round((value" in ln]
    assert stage1 and all("+- HashAggregate" in ln or ln.lstrip().startswith("HashAggregate")
                          for ln in stage1)
    assert _before_exchange(p, "partial_sum(cast(round((value")
    # the dominant label is a total-order min_by, not mode()
    assert "min_by" in p and "mode(" not in p


def test_latest_and_topk_limit_before_shuffle(spark, q):
    for name in ("latest_per_user", "first_k_per_group"):
        p = plan(q[name](spark, SF), "simple")
        assert "WindowGroupLimit" in p and "Partial" in p, name
        assert _before_exchange(p, "Partial"), name


def test_ties_meet_in_a_join_that_can_be_split(spark, q):
    # a key that is all ties would meet in one window task
    p = plan(q["latest_keep_ties"](spark, SF), "simple")
    assert "Window" not in p and "Join" in p and _before_exchange(p, "partial_max")


def test_valid_rows_push_predicates_to_scan(spark, q):
    p = plan(q["valid_rows"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_id)" in p
    assert "GreaterThanOrEqual(value,-100.0)" in p and "LessThanOrEqual(value,150.0)" in p


def test_window_bounds_push_to_scan(spark, q):
    assert "GreaterThanOrEqual(ts," in plan(q["trailing_24h"](spark, SF))
    p = plan(q["hour_slice"](spark, SF))
    assert "GreaterThanOrEqual(ts," in p and "LessThan(ts," in p


def test_scan_reads_only_needed_columns(spark, q):
    p = plan(q["value_counts"](spark, SF))
    assert "ReadSchema: struct<event_type:string>" in p


def test_raw_read_prunes_partitions(spark):
    root = new_dir()
    for h in (1, 2):
        write_lines(Path(root) / f"year=2024/month=3/day=31/hour={h}" / "a.json", [reading()])
    df = read_raw(spark, root, run_hour="2024-03-31T02")
    p = plan(df)
    # only the run hour's folder is listed, not the whole history
    location = [ln for ln in p.splitlines() if ln.startswith("Location:")][0]
    assert "hour=2" in location and "hour=1" not in location, location
    assert df.count() == 1 and {r.hour for r in df.collect()} == {2}


def test_partitioned_write_is_rebalanced(spark):
    df = spark.range(10).withColumns({"year": F.lit(2024), "month": F.lit(1), "day": F.lit(1),
                                      "hour": F.lit(0)})
    assert "Rebalance" in plan(_by_partition(df), "extended") or \
        "REBALANCE" in plan(_by_partition(df), "extended")


def test_hot_key_results_match_brute_force(spark):
    """One key holds a third of all rows; results must equal pandas."""
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        user = 0 if i % 3 == 0 else rnd.randint(1, 200)
        ts = pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=rnd.randint(0, 86400 * 3))
        rows.append((i, user, ts.to_pydatetime(), rnd.choice("abcd"), round(rnd.uniform(0, 100), 2)))
    pdf = pd.DataFrame(rows, columns=["event_id", "user_id", "ts", "event_type", "value"])
    df = spark.createDataFrame(pdf, "event_id long, user_id long, ts timestamp_ntz, "
                                    "event_type string, value double").repartition(8)

    got = {r.user_id: r.event_id for r in latest_per_key(
        df, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).collect()}
    exp = pdf.sort_values(["ts", "event_id"]).groupby("user_id").tail(1)
    assert got == dict(zip(exp.user_id, exp.event_id))

    top = first_k_per_group(df, "user_id", ["ts", "event_id"], 3).filter("user_id = 0")
    exp_top = pdf[pdf.user_id == 0].sort_values(["ts", "event_id"]).head(3).event_id.tolist()
    assert [r.event_id for r in top.orderBy("rank").collect()] == exp_top

    hs = hourly_summary(df, ["user_id"], "ts", [Metric("n_max", "max", "value")],
                        label="event_type", label_col="dom", profile="raw")
    hot = {r.observed_hour.to_pydatetime() if hasattr(r.observed_hour, "to_pydatetime")
           else r.observed_hour: (r.dom, r.reading_count) for r in
           hs.filter("user_id = 0").collect()}
    p0 = pdf[pdf.user_id == 0].assign(h=lambda d: d.ts.dt.floor("h"))
    for h, g in p0.groupby("h"):
        counts = g.event_type.value_counts()
        best = sorted(counts[counts == counts.max()].index)[0]
        assert hot[h.to_pydatetime()] == (best, len(g))


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")
STORAGE = {"processed_window", "stream_ingest", "stream_hourly", "stream_dedup", "process_hour_rejects",
           "backfill_rejects", "stream_ingest_rejects", "incremental_summary", "late_window",
           "float_integers", "padded_rerun", "mixed_schema",
           "payload_scan", "mixed_json", "ndjson_processed", "retention", "keyed_collect"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORAGE))
def test_no_cross_join_or_python_in_query_plans(spark, q, name):
    p = plan(q[name](spark, SF), "extended")
    assert not [f for f in FORBIDDEN if f in p], name
