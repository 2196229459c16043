"""Data-quality reports (C13: P12-P14, A13, U4).

Each report is a single aggregation (plus a grouped count for each
uniqueness test): rules become ``count_if`` columns evaluated in one scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from nimbus.functions._util import col, observed
from nimbus.functions.units import slug
from nimbus.operators.filters import ts_literal
from nimbus.operators.validate import Rule, quality_rules


def rule_failures(df: DataFrame, rules: list[Rule], total_col: str = "total_count") -> DataFrame:
    """One row per rule: ``rule, failed_count, total_count``."""
    arr = F.array(*[F.struct(F.lit(r.name).alias("rule"),
                             F.count_if(~r.passed()).alias("failed_count")) for r in rules])
    return (df.agg(arr.alias("_r"), F.count(F.lit(1)).alias(total_col))
              .select(F.inline("_r"), total_col))


def row_tests(tests: list[tuple]) -> list[tuple[str, str, Column]]:
    """``kind, column, predicate of a failing row`` of the tests that look at
    one row at a time (all but ``unique``)."""
    out = []
    for t in tests:
        kind, c = t[0], t[1]
        if kind == "not_null":
            out.append((kind, c, col(c).isNull()))
        elif kind == "accepted_values":
            out.append((kind, c, col(c).isNotNull() & ~col(c).isin(*t[2])))
        elif kind == "accepted_range":
            lo, hi = t[2]
            bad = F.lit(False)
            if lo is not None:
                bad = bad | (col(c) < lo)
            if hi is not None:
                bad = bad | (col(c) > hi)
            out.append((kind, c, col(c).isNotNull() & bad))
        elif kind != "unique":
            raise ValueError(f"unknown test {kind!r}")
    return out


# column tests (P12): (kind, column, argument)
def model_tests(df: DataFrame, tests: list[tuple]) -> DataFrame:
    """``test, column_name, failures`` for not_null / unique / accepted_values /
    accepted_range tests.

    All row tests are one global aggregate (partial sums per task, no key
    shuffle). Each ``unique`` test is a group-by of its own column, pruned to
    it and compared by its own type.
    """
    reports = []
    for kind, c, *_ in tests:
        if kind == "unique":
            seen = df.select(col(c).alias("_v")).where(F.col("_v").isNotNull()).groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
            reports.append(seen.agg(F.count_if(F.col("_n") > 1).alias("failures"))
                           .select(F.lit(kind).alias("test"), F.lit(c).alias("column_name"), "failures"))
    if of_rows := row_tests(tests):
        row = F.array(*[F.struct(F.lit(k).alias("test"), F.lit(c).alias("column_name"),
                                 F.count_if(p).alias("failures")) for k, c, p in of_rows])
        reports.insert(0, df.agg(row.alias("_r")).select(F.inline("_r")))
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


# The column tests declared for the staging view and the marts.
def staging_tests(states) -> list[tuple]:
    return ([("not_null", c) for c in ("city_name", "state_code", "temp_f", "humidity_pct", "observed_at")]
            + [("accepted_values", "state_code", list(states)), ("accepted_range", "humidity_pct", (0, 100))])


CURRENT_TESTS = [("not_null", c) for c in ("city_name", "temp_f", "observed_at")] + [("unique", "city_name")]
SUMMARY_TESTS = [("not_null", c) for c in ("city_name", "state_code", "observed_hour", "avg_temp_f")]


def quality_report(stg: DataFrame, current: DataFrame, summary: DataFrame, rules: list[Rule],
                   states) -> DataFrame:
    """The weather test suites and row rules as one report (C13):
    ``suite, test, column_name, failures``."""
    out = rule_failures(stg, rules).select(
        F.lit("rows").alias("suite"), F.col("rule").alias("test"),
        F.lit(None).cast("string").alias("column_name"), F.col("failed_count").alias("failures"))
    for suite, df, tests in (("staging", stg, staging_tests(states)), ("current", current, CURRENT_TESTS),
                             ("summary", summary, SUMMARY_TESTS)):
        out = out.unionByName(model_tests(df, tests).select(
            F.lit(suite).alias("suite"), "test", "column_name", "failures"))
    return out


class MartChecks:
    """The whole report (C13) from the rows as the marts are written.

    ``staging``, ``current`` and ``summary`` each attach their checks to a
    DataFrame that is written anyway (``observe``): row rules, column tests and
    the newest observation cost no scan of their own. Only what needs rows of
    different keys together, uniqueness and coverage, is read from the finished
    current mart: one row for each city and state.
    """

    def __init__(self, states, expected_states, min_cities: int):
        self.states, self.expected, self.min_cities = list(states), list(expected_states), min_cities
        self.seen: dict[str, Observation] = {}
        self.tests: dict[str, list[tuple]] = {}

    def _observe(self, suite: str, df: DataFrame, tests: list[tuple], more: list[Column] = ()) -> DataFrame:
        """``tests``: (suite, test, column name, predicate of a failing row)."""
        self.seen[suite], self.tests[suite] = Observation(f"{suite}-{uuid.uuid4().hex[:8]}"), tests
        return df.observe(self.seen[suite], *[F.count_if(F.coalesce(p, F.lit(False))).alias(f"t{i}") for i, (*_, p) in enumerate(tests)], *more)

    def staging(self, stg: DataFrame) -> DataFrame:
        rules = quality_rules(lat="latitude", lon="longitude", observed="observed_at", fetched="fetched_at", state="state_code", states=self.states)
        tests = [("rows", r.name, None, ~r.passed()) for r in rules]
        tests += [("staging", *t) for t in row_tests(staging_tests(self.states))]
        newest = F.date_format(F.max("observed_at"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("newest")
        return self._observe("staging", stg, tests, [newest])

    def current(self, current: DataFrame) -> DataFrame:
        return self._observe("current", current, [("current", *t) for t in row_tests(CURRENT_TESTS)])

    def summary(self, summary: DataFrame) -> DataFrame:
        return self._observe("summary", summary, [("summary", *t) for t in row_tests(SUMMARY_TESTS)])

    def report(self, current: DataFrame, as_of=None) -> DataFrame:
        """``suite, test, column_name, failures``, after the marts are
        written. ``lag_minutes`` is how far the newest reading lies behind
        ``as_of`` (default: not at all), NULL without any."""
        rows, newest = [], None
        for suite, obs in self.seen.items():
            got = observed(obs) or {}
            newest = got.get("newest") if suite == "staging" else newest
            rows += [(s, t, c, int(got.get(f"t{i}") or 0)) for i, (s, t, c, _) in enumerate(self.tests[suite])]
        spark = current.sparkSession
        told = spark.createDataFrame(rows, "suite string, test string, column_name string, failures long")
        keys = current.select("city_name", "state_code", slug("city_name", "state_code").alias("_slug"))
        cover = coverage_report(keys, "state_code", "city_name", "_slug", self.expected, self.min_cities)
        sets = cover.select(F.inline(F.array(*[F.struct(F.lit("coverage").alias("suite"), F.lit(t).alias("test"), F.lit(c).cast("string").alias("column_name"), v.cast("long").alias("failures"))
                                               for t, c, v in (("missing_states", "state_code", F.size("missing_states")), ("unexpected_states", "state_code", F.col("unexpected_states")),
                                                               ("too_few_cities", "city_name", F.greatest(F.lit(self.min_cities) - F.col("n_cities"), F.lit(0))), ("duplicate_slugs", None, F.col("duplicate_slugs")))])))
        unique = model_tests(current, [t for t in CURRENT_TESTS if t[0] == "unique"]).select(F.lit("current").alias("suite"), "test", "column_name", "failures")
        at = F.lit(newest).cast("timestamp")
        anchor = at if as_of is None else ts_literal(as_of)
        lag = F.floor((F.unix_micros(anchor) - F.unix_micros(at)) / 60000000).cast("long")
        fresh = spark.range(1).select(F.lit("freshness").alias("suite"), F.lit("lag_minutes").alias("test"), F.lit("observed_at").alias("column_name"), lag.alias("failures"))
        return told.unionByName(unique).unionByName(sets).unionByName(fresh)


def missing_columns(df: DataFrame, required) -> list[str]:
    """Required fields absent from the schema (P14 "required keys present");
    schema metadata only, no job."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def coverage_report(df: DataFrame, state: str, city: str, slug: str | None,
                    expected_states, min_cities: int) -> DataFrame:
    """Set-level coverage (P14, U4): expected states that are missing, rows of
    states that are not expected (``unexpected_states``: how many such states;
    the two sets are equal when nothing is missing and this is 0), distinct
    city count against a minimum, and slugs shared by different cities.

    The rows are first reduced to distinct ``(city, state, slug)`` keys (a
    partial-aggregated shuffle); the distinct counts then run on that small
    set, so Spark's multi-distinct expansion never touches the raw rows.
    Only the expected state list is materialised, never the data's keys.
    """
    expected_states = list(expected_states)
    keys = [city, state] + ([slug] if slug else [])
    pairs = df.select(*[col(k) for k in keys]).distinct()
    present = [F.coalesce(F.max(F.coalesce(col(state) == s, F.lit(False))), F.lit(False)).alias(f"_p{i}")
               for i, s in enumerate(expected_states)]
    other = F.when(~col(state).isin(*expected_states), col(state))
    aggs = present + [F.count_distinct(other).alias("_other"), F.count_distinct(col(city)).alias("n_cities")]
    if slug:
        aggs += [F.count(col(slug)).alias("_ns"), F.count_distinct(col(slug)).alias("_nds")]
    r = pairs.agg(*aggs)
    missing = F.array_compact(F.array(*[F.when(~F.col(f"_p{i}"), F.lit(s))
                                        for i, s in enumerate(expected_states)]))
    out = [missing.alias("missing_states"), F.col("_other").alias("unexpected_states"), F.col("n_cities"),
           (F.col("n_cities") >= min_cities).alias("meets_min_cities")]
    if slug:
        out.append((F.col("_ns") - F.col("_nds")).alias("duplicate_slugs"))
    return r.select(*out)


def freshness(df: DataFrame, ts: str, keys=None, as_of=None,
              last_col: str = "last_seen", lag_col: str = "lag_minutes") -> DataFrame:
    """Latest timestamp (A13) overall or per key, with the lag behind ``as_of``
    (default: the newest timestamp in the data) in whole minutes."""
    anchor = (df.select(F.max(ts)).scalar() if as_of is None
              else ts_literal(as_of, df.schema[ts].dataType.typeName()))

    def _micros(c):
        return F.unix_micros(c.cast("timestamp"))

    lag = F.floor((_micros(anchor) - _micros(F.col(last_col))) / 60000000).cast("bigint")
    if keys:
        keys = [keys] if isinstance(keys, str) else list(keys)
        base = df.groupBy(*keys).agg(F.max(ts).alias(last_col))
    else:
        base = df.agg(F.max(ts).alias(last_col))
    return base.withColumn(lag_col, lag)
