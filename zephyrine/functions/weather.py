"""Weather interactions and the seeded stand-in for missing historical weather."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.functions.numeric import clip, half_even
from zephyrine.schema import CLIMATOLOGY, CLIMATOLOGY_SCHEMA


def temp_humidity_index(temperature: Column, humidity: Column) -> Column:
    return half_even(temperature * humidity / F.lit(100.0), 4)


def wind_dispersion(wind_speed: Column) -> Column:
    """Undefined (NULL) for a negative speed."""
    return F.when(wind_speed >= 0, half_even(F.pow(wind_speed, F.lit(1.5)), 4))


def atmospheric_stability(pressure: Column, wind_speed: Column) -> Column:
    return half_even(F.try_divide(pressure, wind_speed + F.lit(0.1)), 4)


def interaction_features() -> dict[str, Column]:
    return {
        "temp_humidity_index": temp_humidity_index(F.col("temperature"), F.col("humidity")),
        "wind_dispersion": wind_dispersion(F.col("wind_speed")),
        "atmospheric_stability": atmospheric_stability(F.col("pressure"), F.col("wind_speed")),
    }


def climatology(spark: SparkSession) -> DataFrame:
    """Twelve fixed rows, so a broadcast of it cannot grow with the data."""
    return spark.createDataFrame(CLIMATOLOGY, CLIMATOLOGY_SCHEMA)


def hashed_uniform(key: Column, salt: str) -> Column:
    """Uniform in [0, 1) from 32 bits of a keyed digest: same row, same value, any plan."""
    digest = F.md5(F.concat(key.cast("string"), F.lit("|" + salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def hashed_normal(key: Column, salt: str) -> Column:
    """Standard normal by Box-Muller over two keyed uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - hashed_uniform(key, salt + ".r")))
    return radius * F.cos(F.lit(2 * math.pi) * hashed_uniform(key, salt + ".a"))


# Visibility choices in metres, drawn with equal weight.
VISIBILITY_CHOICES = [5000.0, 8000.0, 10000.0, 10000.0, 10000.0]


def approximate_weather(key: Column) -> dict[str, Column]:
    """Climate means plus keyed noise; expects the ``clim_*`` columns in scope."""

    def steps(salt: str, count: int) -> Column:
        return F.floor(hashed_uniform(key, salt) * F.lit(float(count)))

    choices = F.array(*[F.lit(v) for v in VISIBILITY_CHOICES])
    temperature = F.col("clim_temperature") + F.lit(2.0) * hashed_normal(key, "temperature")
    wind = F.col("clim_wind_speed") + F.lit(0.8) * hashed_normal(key, "wind")
    return {
        "temperature": half_even(temperature, 2),
        "humidity": clip(F.col("clim_humidity") + steps("humidity", 16) - 8, 10, 100),
        "pressure": clip(F.col("clim_pressure") + steps("pressure", 10) - 5, 980, 1030),
        "wind_speed": half_even(clip(wind, low=0), 2),
        "wind_direction": steps("direction", 360).cast("double"),
        "visibility": F.get(choices, steps("visibility", len(VISIBILITY_CHOICES)).cast("int")),
    }
