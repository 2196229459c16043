"""Row validation with reasons, valid/invalid split and counts.

A rule is a named predicate that is TRUE when the row passes. A NULL
predicate counts as a failure (``coalesce(p, false)``), so under
three-valued logic every row lands in exactly one branch of the split.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbus.functions._util import col
from nimbus.schemas import REQUIRED_COLS

REASONS = "reject_reasons"
MALFORMED = "_malformed"   # comma-separated names of fields that did not parse


@dataclass(frozen=True)
class Rule:
    name: str
    check: Column

    def passed(self) -> Column:
        return F.coalesce(self.check, F.lit(False))


def _is_number(c) -> Column:
    # NaN compares above every number, so `NaN >= 0` is TRUE: exclude it.
    return ~F.isnan(col(c))


def not_null(c: str) -> Rule:
    return Rule(f"missing:{c}", col(c).isNotNull())


def in_range(c: str, lo, hi, name: str | None = None) -> Rule:
    return Rule(name or f"range:{c}", col(c).between(lo, hi) & _is_number(c))


def at_least(c: str, lo, name: str | None = None) -> Rule:
    return Rule(name or f"range:{c}", (col(c) >= lo) & _is_number(c))


def accepted_values(c: str, values, name: str | None = None) -> Rule:
    return Rule(name or f"accepted:{c}", col(c).isin(*values))


# ---------------------------------------------------------------------------
# The two rule sets (ingest rejects, quality reports).
# ---------------------------------------------------------------------------
INGEST_TEMP = (-100, 150)
INGEST_HUMIDITY = (0, 100)
INGEST_PRESSURE = (870, 1085)
QUALITY_TEMP = (-20.0, 120.0)
QUALITY_HUMIDITY = (0, 100)
QUALITY_PRESSURE = (900, 1100)
QUALITY_CLOUDS = (0, 100)
QUALITY_FEELS_LIKE_GAP = 40
QUALITY_LAT = (38.5, 45.5)
QUALITY_LON = (-80.0, -70.0)
VALID_STATES = ["NY", "NJ", "CT"]
# ---------------------------------------------------------------------------


def ingest_rules(required=tuple(REQUIRED_COLS), temp="temp_f", humidity="humidity_pct",
                 pressure="pressure_hpa", wind="wind_speed_mph") -> list[Rule]:
    """Rules of the processing job: not-null over required columns + ranges.

    Pass ``None`` for a range column the input does not have.
    """
    rules = [not_null(c) for c in required]
    if temp:
        rules.append(in_range(temp, *INGEST_TEMP))
    if humidity:
        rules.append(in_range(humidity, *INGEST_HUMIDITY))
    if pressure:
        rules.append(in_range(pressure, *INGEST_PRESSURE))
    if wind:
        rules.append(at_least(wind, 0))
    return rules


def quality_rules(temp="temp_f", feels_like="feels_like_f", temp_min="temp_min_f",
                  temp_max="temp_max_f", humidity="humidity_pct", pressure="pressure_hpa",
                  wind="wind_speed_mph", clouds="clouds_pct", observed="observed_at",
                  fetched="fetched_at", lat="lat", lon="lon", condition="condition_main",
                  state="state", states=tuple(VALID_STATES)) -> list[Rule]:
    """Row-level data-quality rules (P13). ``None`` skips a rule."""
    r: list[Rule] = []
    if state:
        r.append(accepted_values(state, states, "state_in_region"))
    if temp:
        r.append(in_range(temp, *QUALITY_TEMP, name="temp_realistic"))
    if temp and feels_like:
        r.append(Rule("feels_like_near_temp",
                      F.abs(col(feels_like) - col(temp)) < QUALITY_FEELS_LIKE_GAP))
    if temp and temp_min and temp_max:
        r.append(Rule("min_le_temp_le_max",
                      (col(temp_min) <= col(temp)) & (col(temp) <= col(temp_max))))
    if humidity:
        r.append(in_range(humidity, *QUALITY_HUMIDITY, name="humidity_range"))
    if pressure:
        r.append(in_range(pressure, *QUALITY_PRESSURE, name="pressure_range"))
    if wind:
        r.append(at_least(wind, 0, name="wind_non_negative"))
    if clouds:
        r.append(in_range(clouds, *QUALITY_CLOUDS, name="clouds_range"))
    if observed and fetched:
        r.append(Rule("observed_not_after_fetched",
                      col(observed).try_cast("timestamp") <= col(fetched).try_cast("timestamp")))
    if lat:
        r.append(in_range(lat, *QUALITY_LAT, name="lat_in_bbox"))
    if lon:
        r.append(in_range(lon, *QUALITY_LON, name="lon_in_bbox"))
    if condition:
        r.append(Rule("condition_not_blank", F.trim(col(condition)) != ""))
    return r


def reasons(rules: list[Rule]) -> Column:
    """Array of names of the failed rules, in rule order (empty when valid)."""
    return F.array_compact(F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rules]))


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``reject_reasons``. Values the reader could not parse (``_malformed``)
    are reported as ``malformed:<col>`` ahead of the rule results."""
    r = reasons(rules)
    if MALFORMED in df.columns:
        names = F.filter(F.split(F.col(MALFORMED), ","), lambda c: c != "")
        r = F.concat(F.transform(names, lambda c: F.concat(F.lit("malformed:"), c)), r)
    return df.withColumn(REASONS, r)


def passes(rules: list[Rule], df: DataFrame | None = None) -> Column:
    """TRUE when every rule holds (a NULL anywhere makes it not TRUE).

    Used directly as a filter this is a plain conjunction, so the simple
    parts (``IS NOT NULL``, range bounds) are pushed into the Parquet scan
    and no reasons array is built for rows that pass.
    """
    out = reduce(lambda a, b: a & b, [r.check for r in rules])
    if df is not None and MALFORMED in df.columns:
        out = out & (F.col(MALFORMED) == "")
    return out


def split(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid); reasons are computed for the invalid rows only."""
    ok = passes(rules, df)
    valid = df.filter(ok)
    if MALFORMED in valid.columns:
        valid = valid.drop(MALFORMED)
    invalid = validate(df.filter(~F.coalesce(ok, F.lit(False))), rules)
    return valid, invalid


def split_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: total, valid, invalid; one aggregation pass, no caching."""
    ok = F.coalesce(passes(rules, df), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(ok).alias("valid_count"),
        F.count_if(~ok).alias("invalid_count"),
    )


def reason_text(sep: str = ",") -> Column:
    return F.concat_ws(sep, F.col(REASONS))
