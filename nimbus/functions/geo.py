"""Map styling (F10, F11): colour by temperature, size/opacity by population."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbus.dims import POP_MAX, POP_MIN
from nimbus.functions._util import col

# ---------------------------------------------------------------------------
# Colour anchors (temp_f, [R, G, B]) and size/opacity ranges.
# ---------------------------------------------------------------------------
TEMP_ANCHORS = [
    (10, [0, 0, 180]),
    (30, [30, 100, 255]),
    (50, [100, 220, 200]),
    (70, [255, 220, 50]),
    (90, [200, 30, 0]),
]
RADIUS_BASE = 3500
RADIUS_BOOST = 2000
ALPHA_BASE = 140
ALPHA_BOOST = 100
# ---------------------------------------------------------------------------

LOG_POP_MIN = math.log10(POP_MIN)
LOG_POP_MAX = math.log10(POP_MAX)


def temp_channel(temp_f, j: int) -> Column:
    """Channel ``j`` (0=R, 1=G, 2=B) of the piecewise-linear colour ramp.

    Clamped at both ends; inside a segment the value is truncated to int.
    NaN sorts above every number in Spark, so it takes the top colour.
    """
    t = col(temp_f)
    lo_t, lo_c = TEMP_ANCHORS[0]
    hi_t, hi_c = TEMP_ANCHORS[-1]
    expr = F.when(t <= lo_t, F.lit(lo_c[j])).when(t >= hi_t, F.lit(hi_c[j]))
    for (t0, c0), (t1, c1) in zip(TEMP_ANCHORS, TEMP_ANCHORS[1:]):
        frac = (t - t0) / (t1 - t0)
        expr = expr.when(t <= t1, (F.lit(c0[j]) + frac * (c1[j] - c0[j])).cast("int"))
    return expr.otherwise(F.lit(hi_c[j]))


def temp_rgb(temp_f) -> Column:
    return F.array(*[temp_channel(temp_f, j) for j in range(3)])


def population_scale(population) -> Column:
    """log10 position of the population between the smallest and largest city, clamped 0..1."""
    t = (F.log10(col(population).cast("double")) - LOG_POP_MIN) / (LOG_POP_MAX - LOG_POP_MIN)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), t))


def radius(pop_t) -> Column:
    return (F.lit(RADIUS_BASE) + col(pop_t) * RADIUS_BOOST).cast("int")


def alpha(pop_t) -> Column:
    return (F.lit(ALPHA_BASE) + col(pop_t) * ALPHA_BOOST).cast("int")
