"""Property-based checks: random inputs, one Spark job per example."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from conftest import reading
from nimbus.functions import exact, geo
from nimbus.operators.validate import ingest_rules, split, split_counts
from nimbus.schemas import READING

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

cents = st.integers(min_value=-50000, max_value=60000)


@SETTINGS
@given(groups=st.lists(st.lists(cents, min_size=1, max_size=6), min_size=1, max_size=8))
def test_exact_mean_is_half_up_of_true_mean(spark, groups):
    rows = [(g, c / 100) for g, vals in enumerate(groups) for c in vals]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: (r.m2, r.m1, r.raw) for r in df.groupBy("g").agg(
        exact.exact_mean("v", 2, 2).alias("m2"), exact.exact_mean("v", 1, 2).alias("m1"),
        exact.exact_mean("v", None, 2).alias("raw")).collect()}
    for g, vals in enumerate(groups):
        true = Decimal(sum(vals)) / Decimal(100 * len(vals))
        m2 = float(true.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        m1 = float(true.quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))
        assert got[g][0] == m2 and got[g][1] == m1
        assert abs(got[g][2] - float(true)) < 1e-9


values = st.one_of(st.none(), st.just(float("nan")),
                   st.floats(min_value=-200, max_value=200, allow_nan=False))


@SETTINGS
@given(rows=st.lists(st.tuples(values, st.one_of(st.none(), st.integers(-10, 120)),
                               st.one_of(st.none(), st.integers(800, 1100)), values),
                     min_size=1, max_size=20))
def test_split_partitions_rows(spark, rows):
    data = [reading(city=f"c{i}", temp_f=t, humidity_pct=h, pressure_hpa=p, wind_speed_mph=w)
            for i, (t, h, p, w) in enumerate(rows)]
    df = spark.createDataFrame(data, READING)
    valid, invalid = split(df, ingest_rules())
    v = {r.city for r in valid.collect()}
    bad = {r.city for r in invalid.collect()}
    assert v.isdisjoint(bad) and v | bad == {f"c{i}" for i in range(len(rows))}
    c = split_counts(df, ingest_rules()).first()
    assert (c.valid_count, c.invalid_count) == (len(v), len(bad))

    def ok(t, h, p, w):
        num = (lambda x: x is not None and x == x)
        return (num(t) and -100 <= t <= 150 and h is not None and 0 <= h <= 100
                and p is not None and 870 <= p <= 1085 and num(w) and w >= 0)
    assert v == {f"c{i}" for i, r in enumerate(rows) if ok(*r)}


@SETTINGS
@given(temps=st.lists(st.floats(min_value=-40, max_value=130, allow_nan=False), min_size=1,
                      max_size=30))
def test_colour_ramp_matches_formula(spark, temps):
    df = spark.createDataFrame([(t,) for t in temps], "t double")
    got = [tuple(r.c) for r in df.select(geo.temp_rgb("t").alias("c")).collect()]

    def ramp(t):
        a = geo.TEMP_ANCHORS
        if t <= a[0][0]:
            return tuple(a[0][1])
        if t >= a[-1][0]:
            return tuple(a[-1][1])
        for (t0, c0), (t1, c1) in zip(a, a[1:]):
            if t0 <= t <= t1:
                f = (t - t0) / (t1 - t0)
                return tuple(int(c0[j] + f * (c1[j] - c0[j])) for j in range(3))
    assert got == [ramp(t) for t in temps]
