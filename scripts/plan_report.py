"""Write PLANS.md: physical-plan shape of every registered query.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md
Counts come from ``explain()`` of the initial adaptive plan (before AQE
re-optimises at run time).
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from nimbus.plans.registry import QUERIES  # noqa: E402
from nimbus.session import get_session  # noqa: E402

# Why each plan holds at scale (one line per query).
ROUND_TRIPS = {"process_hour_rejects", "backfill_rejects", "stream_ingest_rejects", "incremental_summary",
               "late_window", "float_integers", "padded_rerun", "mixed_schema",
               "payload_scan", "mixed_json", "ndjson_processed", "retention", "keyed_collect",
               "stream_dedup_late", "stream_hourly_closed", "process_hour_valid", "backfill_valid", "backfill_zone",
               "unannounced_summary", "mixed_types", "catalog_diff", "catalog_repair", "atomic_rerun",
               "marts_report", "marts_switch", "staging_view", "empty_hours", "keyed_source"}

NOTES = {
    "hourly_summary": "stage 1: codegen hash aggregate per (user, hour, type) with partial step; stage 2 rolls up and picks the label by min_by, one row per label and group (few where groups are small)",
    "daily_summary_raw": "same two stages at day grain; exact integer-cent sums",
    "latest_per_user": "partial WindowGroupLimit keeps 1 row per user per map task before the shuffle",
    "latest_keep_ties": "maximum by key (partial), joined back: a key that is all ties is split as a skewed join",
    "current_readings": "latest per user first (partial WindowGroupLimit), so one row a user meets the dimensions; then latest per city",
    "dominant_type": "hash aggregate of counts per (user, type), then min_by with a total order over the reduced rows",
    "validate_split_counts": "single scan, one global partial aggregate",
    "valid_rows": "map-only; conjunction pushed into the Parquet scan",
    "rejected_rows": "map-only; reasons built only for rejected rows",
    "enriched": "map-only after dimension joins; validation conjunction filters before projection",
    "props_json": "map-only",
    "staged": "map-only",
    "trailing_24h": "anchor resolved first (1 pruned column); bound pushed to Parquet row-group stats",
    "hour_slice": "as trailing_24h with both bounds pushed",
    "in_list": "map-only; IN pushed to the scan",
    "value_counts": "partial count per type; tiny final sort",
    "regional_snapshot": "raw rows reduced per (hour, user) by a hash aggregate; arg-max/arg-min min_by runs on the reduced rows",
    "hour_over_hour": "two partial aggregations; the single-partition lag sees one row per hour",
    "series_long": "map-only Expand (2 rows per input row)",
    "range_summary": "hour aggregate first; equal values counted (partial), then one ordered pass a user; users beyond 5 million rows in range-partitioned pieces",
    "range_summary_hot": "as range_summary with a low limit: the hot key's values are dealt out by range, totals of pieces give the ranks",
    "advice_seasons": "map-only after dimension joins",
    "daylight_labels": "distinct hours (partial) then labels",
    "ordered_views": "a test of declared orders: places within a city in its own task; one row a city and one a condition in the single-task windows",
    "mean_order": "hour aggregate then per-user mean",
    "dimension_default": "order counts pre-aggregated before the left join; join strategy size-checked",
    "first_k_per_group": "partial WindowGroupLimit keeps k rows per user per map task",
    "map_layer": "derived population table pre-aggregated; join left to the planner",
    "advice_bands": "map-only after dimension joins",
    "current_cards": "as current_readings plus map-only labels",
    "et_labels": "distinct hours (partial) then labels",
    "quality_report": "single scan, every rule a count_if in one aggregate",
    "model_tests": "row tests as one global partial aggregate; each unique test groups its own pruned column by its own type",
    "coverage": "rows reduced to distinct (city, state, slug) before the multi-distinct expansion",
    "freshness": "partial max per user; anchor is a scalar subquery",
    "union_by_name": "map-only union",
    "epoch_roundtrip": "map-only",
    "distinct_hours": "partial distinct",
    "sample_limit": "TakeOrderedAndProject: per-task top 10, no full sort",
    "hourly_detail": "projection over hourly_summary",
    "processed_window": "one job writes all hours (rebalanced); read-back lists only the window's 25 hour folders",
    "missing_keys": "both sides reduced to distinct keys (partial aggregation) before the anti-join",
    "row_count": "partial count",
    "stream_hourly": "stateful windowed aggregation, state bounded by the watermark; result read back per batch id",
    "stream_dedup": "state bounded by the watermark",
    "stream_ingest": "only the touched hours' folders are listed (path glob) and filtered exactly; rebalanced hour writes",
}


def _explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


CODEGEN_IGNORE = {"AdaptiveSparkPlan", "Exchange", "BroadcastExchange", "ColumnarToRow",
                  "AQEShuffleRead", "ShuffleQueryStage", "BroadcastQueryStage", "Union",
                  "TakeOrderedAndProject", "Subquery", "ReusedExchange", "ResultQueryStage",
                  "TableCacheQueryStage", "Window", "WindowGroupLimit", "Expand", "Generate",
                  "Sort", "Scan", "FileScan", "InMemoryTableScan", "LocalTableScan"}


def _interpreted(df) -> list[str]:
    """Operators outside whole-stage codegen in the final (executed) plan."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    out = set()
    for ln in text.splitlines():
        m = re.match(r"^[\s:+\-]*(\*\(\d+\) )?([A-Za-z]+)", ln)
        if m and not m.group(1) and m.group(2) not in CODEGEN_IGNORE and m.group(2)[0].isupper():
            out.add(m.group(2))
    return sorted(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 8, app_name="nimbus-plans")
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `scripts/plan_report.py` on `{sf_dir}` (initial adaptive plans). "
          "Shuffles = `Exchange` nodes (subqueries included); "
          "broadcasts = `BroadcastExchange` (size-checked by Spark unless the side is a literal "
          "dimension). Streaming queries show the read-back of their output. "
          "'Outside codegen' lists operators of the executed plan that are not in "
          "whole-stage codegen (the label pick over per-label rows, exact percentiles over "
          "hourly rows, reasons of rejected rows, one-row report projections).\n")
    print("| query | shuffles | broadcasts | partial agg | partial window limit | pushed filters "
          "| outside codegen | note |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if name in ROUND_TRIPS:
            continue  # they write, and read back what they wrote
        p = _explain(fn(spark, sf_dir))
        nodes = re.findall(r"^\(\d+\) (\w+)", p, flags=re.M)
        shuffles = nodes.count("Exchange")
        bcast = nodes.count("BroadcastExchange")
        partial = "yes" if "partial_" in p else "-"
        wgl = "yes" if "WindowGroupLimit" in p and "Partial" in p else "-"
        pushed = sorted({f for m in re.findall(r"^PushedFilters: \[(.*)\]$", p, flags=re.M)
                         for f in re.findall(r"(\w+)\(", m) if f != "IsNotNull"})
        interp = _interpreted(fn(spark, sf_dir))
        print(f"| {name} | {shuffles} | {bcast} | {partial} | {wgl} | "
              f"{', '.join(pushed) or '-'} | {', '.join(interp) or '-'} | {NOTES.get(name, '')} |")


if __name__ == "__main__":
    main()
