"""Labels and JSON."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbus.functions._util import col

# ---------------------------------------------------------------------------
# Condition icons and placeholders of the dashboard cards.
# ---------------------------------------------------------------------------
CONDITION_ICONS = {
    "Clear": "☀️", "Clouds": "☁️", "Rain": "🌧️", "Drizzle": "🌦️",
    "Thunderstorm": "⛈️", "Snow": "❄️", "Mist": "🌫️", "Fog": "🌫️", "Haze": "🌫️",
}
DEFAULT_ICON = "🌡️"
MISSING_TEXT = "—"
# ---------------------------------------------------------------------------


def title_or_dash(c) -> Column:
    """Capitalised words; the placeholder for a missing or empty text."""
    return F.coalesce(F.initcap(F.nullif(col(c), F.lit(""))), F.lit(MISSING_TEXT))


def condition_icon(c) -> Column:
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(CONDITION_ICONS.items())])
    return F.coalesce(F.try_element_at(m, col(c)), F.lit(DEFAULT_ICON))


_BITS = 1 << 26


def _tenths(x: Column) -> Column:
    """Nearest number of tenths of a double ``0 <= x < 2**40``, by its exact
    binary value, ties to the even tenth (as C's printf rounds).

    The fraction is taken as two integers (26 bits, and what is below them),
    so every step is exact: 10 times the upper part is compared with a half,
    and the lower part only decides where that is within reach.
    """
    whole = F.floor(x)
    high = F.floor((x - whole) * _BITS)
    low = ((x - whole) * _BITS - high) * 10.0      # tenths of 2**-26, 0 <= low < 10
    ten = high.cast("bigint") * 10
    tenth = F.floor(ten / F.lit(float(_BITS))).cast("bigint")
    short = F.lit(_BITS // 2) - (ten - tenth * _BITS)   # what the upper part lacks to a half
    n = whole.cast("bigint") * 10 + tenth
    up = (low > short) | ((low == short) & (n % 2 == 1))
    return n + F.when(up, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def one_decimal(c, plus: bool = False) -> Column:
    """``%.1f`` (``plus``: ``%+.1f``) as C formats a double: by its exact binary
    value. Java's formatter rounds the shortest decimal text instead, which
    prints 72.25 and 72.35 differently."""
    x = col(c).cast("double")
    n = _tenths(F.abs(x))
    sign = F.when((x < 0) | (x.cast("string") == "-0.0"), "-").otherwise("+" if plus else "")
    exact = F.concat(sign, F.floor(n / F.lit(10)).cast("bigint").cast("string"), F.lit("."), (n % 10).cast("string"))
    return F.when(F.abs(x) < float(1 << 40), exact).otherwise(F.format_string("%+.1f" if plus else "%.1f", x))


def signed_one_decimal(c) -> Column:
    return one_decimal(c, plus=True)


def blank(c) -> Column:
    return F.coalesce(F.trim(col(c)) == "", F.lit(True))


def with_json_fields(df, c: str, fields: dict[str, str | None]):
    """Add top-level fields of the JSON text column ``c`` (``{name: cast}``).

    ``json_tuple`` parses each document once for all fields and, being a
    generator, is not inlined into later filters by the optimizer, so a
    field used in several predicates is still parsed once per row (a
    ``get_json_object`` column would be re-parsed in each). Values come back
    as text (numbers and strings alike) and are ``try_cast`` when asked.
    """
    names = list(fields)
    tmp = [f"_json_{n}" for n in names]
    out = df.select("*", F.json_tuple(col(c), *names).alias(*tmp))
    return out.select(*df.columns, *[
        (F.col(t).try_cast(fields[n]) if fields[n] else F.col(t)).alias(n)
        for n, t in zip(names, tmp)])
