"""Calendar parts, cyclic encodings, timestamp parsing and date spines."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from zephyrine.functions.numeric import half_even


def season(month: Column) -> Column:
    """0 winter (Dec-Feb), 1 spring, 2 summer, 3 autumn."""
    return F.floor(F.pmod(month, F.lit(12)) / F.lit(3)).cast("int")


def cyclic(part: Column, period: int) -> dict[str, Column]:
    angle = F.lit(2 * math.pi) * part / F.lit(float(period))
    return {"sin": half_even(F.sin(angle), 6), "cos": half_even(F.cos(angle), 6)}


def time_features(ts: Column) -> dict[str, Column]:
    """The 12 calendar and cyclic features of one timestamp (Monday is weekday 0)."""
    hour, month, weekday = F.hour(ts), F.month(ts), F.weekday(ts)
    features = {
        "hour": hour,
        "day": F.dayofmonth(ts),
        "month": month,
        "weekday": weekday,
        "season": season(month),
        "is_weekend": (weekday >= 5).cast("int"),
    }
    for name, part, period in (("hour", hour, 24), ("month", month, 12), ("weekday", weekday, 7)):
        for wave, value in cyclic(part, period).items():
            features[f"{name}_{wave}"] = value
    return features


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def noon_stamp(ts: Column) -> Column:
    return F.date_trunc("day", ts) + F.expr("INTERVAL 12 HOURS")


def in_day(ts: Column, day: Column) -> Column:
    """Whole-day membership, first to last microsecond."""
    return F.to_date(ts) == day


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def parse_timestamp_utc(text: Column) -> Column:
    """Any ISO text (or a timestamp) as a UTC timestamp; NULL where it cannot be parsed."""
    return F.try_to_timestamp(text.cast("string"))


def parse_target_date(text: Column) -> Column:
    """Date or date-time text; anything else raises when the row is evaluated."""
    parsed = parse_timestamp_utc(F.trim(text))
    message = F.concat(F.lit("not a date or date-time: "), F.coalesce(text, F.lit("NULL")))
    return F.when(parsed.isNotNull(), parsed).otherwise(F.raise_error(message).cast("timestamp"))


def date_spine(start: Column, end: Column) -> Column:
    """Inclusive array of days; explode it to get rows."""
    return F.sequence(F.to_date(start), F.to_date(end), F.expr("INTERVAL 1 DAY"))


def default_backfill_start(end: Column, days: int = 90) -> Column:
    """``days`` back from the end, so the inclusive spine has ``days + 1`` dates."""
    return F.date_sub(F.to_date(end), days)


def forecast_label(now: Column, days_ahead: Column) -> Column:
    """Weekday name, short month and day of the forecast date."""
    return F.date_format(F.date_add(F.to_date(now), days_ahead), "EEEE, MMM dd")
