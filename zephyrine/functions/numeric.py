"""Rounding, missing-value and clipping expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def half_even(value: Column, digits: int) -> Column:
    """Round half to even on the scaled double; never yields -0.0.

    ``rint`` is a JVM intrinsic, unlike ``bround`` which builds a BigDecimal per row.
    """
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale + F.lit(0.0)


# Binary places at which a value is split, so that sums of both parts are whole numbers.
COARSE, FINE = 2.0**20, 2.0**32


def exact_parts(value: Column) -> tuple[Column, Column]:
    """Two whole numbers that make up a value to 52 binary places.

    Sums of them are exact in any order and any grouping: for values under 2**33 in groups of
    2**30 rows no sum leaves a long.
    """
    scaled = value * F.lit(COARSE)
    coarse = F.floor(scaled)
    return coarse, F.floor((scaled - coarse) * F.lit(FINE))


def joined_parts(coarse: Column, fine: Column) -> Column:
    """The value of summed parts."""
    return coarse.cast("double") / F.lit(COARSE) + fine.cast("double") / F.lit(COARSE * FINE)


def exact_mean(value: Column) -> Column:
    """Aggregate: the mean of exact sums, equal whatever the order and grouping of the rows."""
    coarse, fine = exact_parts(value)
    return joined_parts(F.sum(coarse), F.sum(fine)) / F.count(value)


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def cast_nullable_doubles(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Force the listed columns to DOUBLE with NULL as the only missing marker."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in present})


def coerce_double(text: Column) -> Column:
    """Text to DOUBLE; anything non-numeric becomes NULL instead of an error."""
    return nan_to_null(F.trim(text).try_cast("double"))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clamp, keeping NULL (``least`` and ``greatest`` alone would skip it)."""
    out = value
    if high is not None:
        out = F.least(out, F.lit(high).cast("double"))
    if low is not None:
        out = F.greatest(out, F.lit(low).cast("double"))
    return F.when(value.isNotNull(), out)


def change_rate(current: Column, previous: Column) -> Column:
    """Percent change; a missing or zero previous value counts as no change."""
    base = F.nullif(previous, F.lit(0.0))
    return F.coalesce(half_even((current - previous) / base * F.lit(100.0), 4), F.lit(0.0))
