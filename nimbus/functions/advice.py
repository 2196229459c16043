"""Rule-based advice (F4-F7) as ``when`` chains; rule order matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nimbus.functions._util import col

# ---------------------------------------------------------------------------
# Thresholds and texts of the advisor.
# ---------------------------------------------------------------------------
DRESS_BANDS = [
    (20, "Extreme cold — heavy parka, thermals, hat, gloves, and scarf essential."),
    (32, "Heavy winter coat, warm hat, and gloves required."),
    (45, "Warm jacket and layers recommended."),
    (60, "Light-to-medium jacket advised."),
    (75, "Comfortable light clothing — maybe a layer for the evening."),
]
DRESS_HOT = "Light, breathable clothing; stay hydrated in the heat."

TRAVEL_STORM = "Avoid outdoor travel — dangerous conditions."
TRAVEL_SNOW = "Allow extra travel time; watch for icy roads."
TRAVEL_RAIN = "Bring an umbrella; good day for indoor plans."
TRAVEL_WIND = "Very windy — secure loose items and expect delays."
TRAVEL_CLEAR = "Great day for outdoor activities or sightseeing."
TRAVEL_CLOUDS = "Overcast but manageable — outdoor plans should hold."
TRAVEL_DEFAULT = "Conditions are reasonable — no special precautions needed."

NOTE_SEVERE = "⛔ Dangerous conditions — indoor only"
NOTE_RAIN = "🌂 Rainy — indoor options shown"
NOTE_WIND = "💨 Very windy — indoor options shown"
NOTE_MUGGY = "🥵 Muggy — indoor options shown"
NOTE_COLD = "🧊 Cold — indoor options shown"

WINDY_MPH = 25
MUGGY_HUMIDITY = 85
MUGGY_FEELS_LIKE = 78
COLD_FEELS_LIKE = 40
CLEAR_WARM_FEELS_LIKE = 60
SEVERE_CONDITIONS = ["Thunderstorm", "Snow"]
WET_CONDITIONS = ["Rain", "Drizzle"]
NO_ACTIVITIES = "Check local listings for options."
# ---------------------------------------------------------------------------


def dress(feels_like) -> Column:
    fl = col(feels_like)
    expr = None
    for limit, text in DRESS_BANDS:
        expr = F.when(fl < limit, text) if expr is None else expr.when(fl < limit, text)
    return expr.otherwise(DRESS_HOT)


def travel(condition, wind_mph, feels_like) -> Column:
    c, w, fl = col(condition), col(wind_mph), col(feels_like)
    return (F.when(c == "Thunderstorm", TRAVEL_STORM)
             .when(c == "Snow", TRAVEL_SNOW)
             .when(c.isin(*WET_CONDITIONS), TRAVEL_RAIN)
             .when(w > WINDY_MPH, TRAVEL_WIND)
             .when((c == "Clear") & (fl > CLEAR_WARM_FEELS_LIKE), TRAVEL_CLEAR)
             .when(c == "Clouds", TRAVEL_CLOUDS)
             .otherwise(TRAVEL_DEFAULT))


def _muggy(humidity, feels_like) -> Column:
    return (col(humidity) > MUGGY_HUMIDITY) & (col(feels_like) > MUGGY_FEELS_LIKE)


def severity(condition, wind_mph, humidity, feels_like) -> Column:
    """``severe`` / ``poor`` / ``ok``."""
    c = col(condition)
    poor = (c.isin(*WET_CONDITIONS)
            | (col(wind_mph) > WINDY_MPH)
            | _muggy(humidity, feels_like)
            | (col(feels_like) < COLD_FEELS_LIKE))
    return (F.when(c.isin(*SEVERE_CONDITIONS), "severe")
             .when(F.coalesce(poor, F.lit(False)), "poor")
             .otherwise("ok"))


def context_note(sev, condition, wind_mph, humidity, feels_like) -> Column:
    s = col(sev)
    return (F.when(s == "severe", NOTE_SEVERE)
             .when((s == "poor") & col(condition).isin(*WET_CONDITIONS), NOTE_RAIN)
             .when((s == "poor") & (col(wind_mph) > WINDY_MPH), NOTE_WIND)
             .when((s == "poor") & _muggy(humidity, feels_like), NOTE_MUGGY)
             .when(s == "poor", NOTE_COLD))
