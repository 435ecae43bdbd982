"""Tables behind the dashboard: forecast strip, alerts, pollutants, explanations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.functions.index import alert_level, aqi_category, health_advice
from zephyrine.functions.numeric import half_even, nan_to_null

# Pollutant labels and their columns.
POLLUTANT_LABELS = {
    "PM2.5": "pm25",
    "PM10": "pm10",
    "NO2": "no2",
    "O3": "o3",
    "SO2": "so2",
    "CO": "co",
}

# Weather metrics (label, column, unit).
WEATHER_METRICS = [
    ("Temperature", "temperature", "°C"),
    ("Humidity", "humidity", "%"),
    ("Wind Speed", "wind_speed", " m/s"),
    ("Pressure", "pressure", " hPa"),
]


def category_columns(aqi: Column) -> list[Column]:
    category = aqi_category(aqi)
    return [
        category.getField("label").alias("category"),
        category.getField("color").alias("color"),
        category.getField("advice").alias("advice"),
    ]


def today_plus_forecast(
    latest: DataFrame, forecast: DataFrame, keys: Sequence[str] = ("city",)
) -> DataFrame:
    """The forecast rows with the current reading as day 0."""
    today = latest.select(
        *keys,
        F.lit(0).alias("day"),
        F.col("aqi"),
        aqi_category(F.col("aqi")).getField("label").alias("category"),
    )
    return today.unionByName(forecast.select(*today.columns))


def max_horizon_aqi(
    latest: DataFrame, forecast: DataFrame, keys: Sequence[str] = ("city",)
) -> DataFrame:
    """Highest of the current and the forecast values; series without a forecast keep
    their current value."""
    return (
        today_plus_forecast(latest, forecast, keys).groupBy(*keys).agg(F.max("aqi").alias("max_aqi"))
    )


def alerts(max_aqi: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    alert = alert_level(F.col("max_aqi"))
    return max_aqi.select(
        *keys, "max_aqi", alert.getField("level").alias("level"), alert.getField("message").alias("message")
    )


def advice_table(max_aqi: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    return max_aqi.select(*keys, F.inline(health_advice(F.col("max_aqi"))))


def pollutant_unpivot(latest: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    """One row per pollutant that has a value."""
    cells = [
        F.struct(F.lit(label).alias("pollutant"), nan_to_null(F.col(c)).alias("value"))
        for label, c in POLLUTANT_LABELS.items()
        if c in latest.columns
    ]
    return latest.select(*keys, F.inline(F.array(*cells))).filter(F.col("value").isNotNull())


def weather_snapshot(latest: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    """Current weather as text with units; a missing value reads N/A."""
    cells = [
        F.struct(
            F.lit(label).alias("metric"),
            F.concat(
                F.coalesce(F.col(c).cast("string"), F.lit("N/A")), F.lit(unit)
            ).alias("reading"),
        )
        for label, c, unit in WEATHER_METRICS
    ]
    return latest.select(*keys, F.inline(F.array(*cells)))


def explain(attributions: DataFrame, value: str = "contribution") -> DataFrame:
    """Direction, size and a sentence per attribution."""
    amount = F.col(value)
    rounded = half_even(F.abs(amount), 1)
    verb = F.when(amount > 0, F.lit("increasing")).otherwise(F.lit("decreasing"))
    sentence = F.concat(
        F.col("feature"),
        F.lit(" is "),
        verb,
        F.lit(" the predicted AQI by "),
        F.format_string("%.1f", rounded),
        F.lit(" points"),
    )
    direction = F.when(amount > 0, F.lit("Increases AQI")).otherwise(F.lit("Decreases AQI"))
    return attributions.withColumns(
        {"direction": direction, "abs_value": F.abs(amount), "sentence": sentence}
    )
