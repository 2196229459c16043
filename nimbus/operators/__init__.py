"""DataFrame -> DataFrame operators. Column names are arguments throughout.

Sub-modules ``validate`` and ``enrich`` share their names with their main
function; import those functions from the sub-modules.
"""

from nimbus.operators.filters import filter_in, hour_slice, partition_bounds, trailing_window
from nimbus.operators.flatten import flatten_payload, stage, to_json_lines, to_record
from nimbus.operators.latest import first_k_per_group, latest_per_key
from nimbus.operators.quality import coverage_report, freshness, model_tests, rule_failures
from nimbus.operators.reshape import missing_keys, series_long, union_batches
from nimbus.operators.snapshot import hour_over_hour, regional_snapshot
from nimbus.operators.summary import (Metric, dominant_label, hourly_summary, mean_order,
                                      row_count, value_counts, weather_metrics)
from nimbus.operators.validate import Rule, ingest_rules, quality_rules, split, split_counts
from nimbus.operators.views import (advice_columns, city_advice, current_cards, hourly_detail,
                                    lookup_with_default, map_layer, range_summary)

__all__ = [
    "filter_in", "hour_slice", "partition_bounds", "trailing_window",
    "flatten_payload", "stage", "to_json_lines", "to_record",
    "first_k_per_group", "latest_per_key",
    "coverage_report", "freshness", "model_tests", "rule_failures",
    "missing_keys", "series_long", "union_batches",
    "hour_over_hour", "regional_snapshot",
    "Metric", "dominant_label", "hourly_summary", "mean_order", "row_count", "value_counts",
    "weather_metrics", "Rule", "ingest_rules", "quality_rules", "split", "split_counts",
    "advice_columns", "city_advice", "current_cards", "hourly_detail", "lookup_with_default",
    "map_layer", "range_summary",
]
