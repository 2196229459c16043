"""Engine-independent means and rounding.

``round(avg(x), 2)`` is not reproducible across engines: floating sums
depend on the order rows arrive in, and ``round`` of a binary midpoint
differs between engines. For measurements with a fixed number of
decimals we sum exact integer units (cents), divide once, and round
half away from zero (as ``round``) with ``floor``: ``x < 0 ? 0 - floor(0.5 - x)
: floor(x + 0.5)``. Every step is a single IEEE operation, so any engine that
evaluates the same expression gets the same bits (and never ``-0.0``).

The integer sum is a plain ``bigint`` sum, so it keeps partial
(map-side) aggregation and runs in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbus.functions._util import col


def units(c, scale: int) -> Column:
    """Value as an exact integer count of 10^-scale units (``bigint``)."""
    return F.round(col(c) * (10 ** scale)).cast("bigint")


def sum_units(c, scale: int) -> Column:
    return F.sum(units(c, scale))


def mean_from_units(total_units, n, scale: int) -> Column:
    """Unrounded mean: ``double(total) / (n * 10^scale)``; NULL when n = 0
    (as ``avg`` of no values), never a division error under ANSI mode."""
    return F.try_divide(col(total_units).cast("double"), col(n) * (10 ** scale))


def half_away(x) -> Column:
    """Nearest integer, halves away from zero (as ``round(x)``), via ``floor``."""
    x = col(x)
    return F.when(x < 0, F.lit(0) - F.floor(F.lit(0.5) - x)).otherwise(F.floor(x + 0.5))


def sql_half_away(x: str) -> str:
    """The same expression as SQL text (for oracle queries)."""
    return f"(CASE WHEN ({x}) < 0 THEN 0 - floor(0.5 - ({x})) ELSE floor(({x}) + 0.5) END)"


def round_units_mean(total_units, n, digits: int, scale: int) -> Column:
    """Mean rounded half away from zero to ``digits`` (``digits <= scale``)."""
    step = 10 ** (scale - digits)
    return half_away(F.try_divide(col(total_units).cast("double"), col(n) * step)) / (10 ** digits)


def round_units_mean_units(total_units, n, digits: int, scale: int) -> Column:
    """The rounded mean as an integer count of ``10^-digits`` units."""
    step = 10 ** (scale - digits)
    return half_away(F.try_divide(col(total_units).cast("double"), col(n) * step))


def round_half_up(x, digits: int) -> Column:
    """Round a double half away from zero to ``digits`` (as ``round``)."""
    m = 10 ** digits
    return half_away(col(x) * m) / m


def exact_mean(c, digits: int | None, scale: int) -> Column:
    """Aggregate: mean of a ``scale``-decimal measurement, optionally rounded."""
    total = sum_units(c, scale)
    n = F.count(col(c))
    if digits is None:
        return mean_from_units(total, n, scale)
    return round_units_mean(total, n, digits, scale)
