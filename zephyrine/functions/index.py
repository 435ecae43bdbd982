"""Pollutant concentration to index, categories, alerts and advice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zephyrine.functions.numeric import half_even
from zephyrine.schema import AQI_CAP, AQI_CATEGORIES, PM25_BREAKPOINTS, PM25_CAP


def pm25_to_aqi(pm25: Column, gap_policy: str = "saturate") -> Column:
    """Piecewise-linear index, one decimal.

    Breakpoint segments are closed and leave gaps such as (12.0, 12.1). With
    ``saturate`` a value in a gap, a negative and a missing value all give 500.0;
    ``truncate`` cuts the concentration to one decimal first, which closes the gaps.
    """
    if gap_policy == "truncate":
        pm25 = F.floor(pm25 * F.lit(10.0)) / F.lit(10.0)
    elif gap_policy != "saturate":
        raise ValueError(f"unknown gap policy {gap_policy!r}")
    level = F.least(pm25, F.lit(PM25_CAP))
    ladder = F.when(F.lit(False), F.lit(None).cast("double"))
    for c_low, c_high, i_low, i_high in PM25_BREAKPOINTS:
        slope = (i_high - i_low) / (c_high - c_low)
        value = F.lit(slope) * (level - F.lit(c_low)) + F.lit(float(i_low))
        ladder = ladder.when(level.between(F.lit(c_low), F.lit(c_high)), half_even(value, 1))
    return ladder.otherwise(F.lit(AQI_CAP))


def _category_struct(row: tuple) -> Column:
    label, low, high, color, advice = row
    return F.struct(
        F.lit(label).alias("label"),
        F.lit(low).alias("min"),
        F.lit(high).alias("max"),
        F.lit(color).alias("color"),
        F.lit(advice).alias("advice"),
    )


def aqi_category(aqi: Column, gap_policy: str = "saturate") -> Column:
    """Category struct. Integer bands are closed, so 50.5 is in none of them.

    ``saturate`` sends everything outside the bands to the last category;
    ``continuous`` extends each band up to the start of the next one.
    """
    if gap_policy not in ("saturate", "continuous"):
        raise ValueError(f"unknown gap policy {gap_policy!r}")
    ladder = F.when(F.lit(False), _category_struct(AQI_CATEGORIES[-1]))
    for row, following in zip(AQI_CATEGORIES, AQI_CATEGORIES[1:] + [None]):
        low, high = F.lit(row[1]), F.lit(row[2])
        inside = aqi.between(low, high)
        if gap_policy == "continuous" and following is not None:
            inside = (aqi >= low) & (aqi < F.lit(following[1]))
        ladder = ladder.when(inside, _category_struct(row))
    return ladder.otherwise(_category_struct(AQI_CATEGORIES[-1]))


# Alert ladder (upper bound, level, message).
ALERT_LADDER = [
    (50, "good", "Air quality is good for the next 3 days. Enjoy outdoor activities!"),
    (
        100,
        "moderate",
        "Air quality is moderate. Unusually sensitive people should consider reducing "
        "prolonged outdoor exertion.",
    ),
    (
        150,
        "unhealthy_sensitive",
        "Unhealthy for Sensitive Groups (AQI up to %d). People with respiratory or heart "
        "conditions should limit outdoor activity.",
    ),
    (
        200,
        "unhealthy",
        "Unhealthy conditions expected (AQI up to %d). Everyone should reduce prolonged "
        "outdoor exertion. Wear an N95 mask outdoors.",
    ),
    (
        300,
        "very_unhealthy",
        "Very Unhealthy (AQI up to %d). Avoid all outdoor activity. Keep windows closed. "
        "Use air purifiers indoors.",
    ),
    (
        None,
        "hazardous",
        "HAZARDOUS conditions (AQI up to %d). Stay indoors. This is a health emergency. "
        "Wear N95 mask if you must go out.",
    ),
]


def alert_level(max_aqi: Column) -> Column:
    """Alert struct(level, message) from a ladder of upper bounds without gaps."""
    shown = half_even(max_aqi, 0).cast("bigint")

    def alert(level: str, message: str) -> Column:
        text = F.format_string(message, shown) if "%d" in message else F.lit(message)
        return F.struct(F.lit(level).alias("level"), text.alias("message"))

    ladder = F.when(max_aqi.isNull(), F.lit(None))
    for bound, level, message in ALERT_LADDER:
        if bound is None:
            return ladder.otherwise(alert(level, message))
        ladder = ladder.when(max_aqi <= F.lit(bound), alert(level, message))
    return ladder


# Health advice (group, text above 100, text otherwise).
HEALTH_ADVICE = [
    ("General Public", "Limit prolonged outdoor activity", "Normal activity OK"),
    ("Children & Elderly", "Avoid outdoor play", "Normal activity OK"),
    ("Asthma / Heart Conditions", "Stay indoors, use inhaler as needed", "Monitor symptoms"),
    ("Athletes / Outdoor Workers", "Reschedule outdoor training", "Normal activity OK"),
]


def health_advice(max_aqi: Column) -> Column:
    """Array of struct(population, recommendation); explode it to get rows."""
    elevated = F.coalesce(max_aqi > F.lit(100), F.lit(False))
    return F.array(
        *[
            F.struct(
                F.lit(group).alias("population"),
                F.when(elevated, F.lit(high)).otherwise(F.lit(low)).alias("recommendation"),
            )
            for group, high, low in HEALTH_ADVICE
        ]
    )
