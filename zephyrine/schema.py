"""Column lists, table schemas and fixed reference dimensions."""

from __future__ import annotations

from pyspark.sql import types as T

# The feature table's column order.
IDENTITY_COLUMNS = ["city", "timestamp"]
POLLUTANT_COLUMNS = ["pm25", "pm10", "no2", "o3", "so2", "co"]
WEATHER_COLUMNS = [
    "temperature",
    "humidity",
    "pressure",
    "wind_speed",
    "wind_direction",
    "visibility",
]
CALENDAR_COLUMNS = ["hour", "day", "month", "weekday", "season", "is_weekend"]
CYCLIC_COLUMNS = [
    "hour_sin",
    "hour_cos",
    "month_sin",
    "month_cos",
    "weekday_sin",
    "weekday_cos",
]
INTERACTION_COLUMNS = [
    "temp_humidity_index",
    "wind_dispersion",
    "atmospheric_stability",
    "aqi_change_rate",
]
TARGET_COLUMNS = ["target_aqi_1d", "target_aqi_2d", "target_aqi_3d"]
FEATURE_TABLE_COLUMNS = (
    IDENTITY_COLUMNS
    + ["aqi"]
    + POLLUTANT_COLUMNS
    + WEATHER_COLUMNS
    + CALENDAR_COLUMNS
    + CYCLIC_COLUMNS
    + INTERACTION_COLUMNS
)

# Columns that may be wholly missing but must stay DOUBLE.
NULLABLE_DOUBLE_COLUMNS = ["pm10", "no2", "o3", "so2", "co", "wind_direction", "visibility"]

# Columns a frame needs before row validation and before lag features.
REQUIRED_COLUMNS = [
    "city",
    "timestamp",
    "aqi",
    "temperature",
    "humidity",
    "pressure",
    "wind_speed",
]
LAG_INPUT_COLUMNS = ["timestamp", "aqi", "temperature", "humidity"]

# Columns that are never model inputs.
NON_FEATURE_COLUMNS = IDENTITY_COLUMNS + ["aqi"] + TARGET_COLUMNS + ["weather_desc"]


def feature_table_schema() -> T.StructType:
    fields = []
    for name in FEATURE_TABLE_COLUMNS:
        if name == "city":
            dtype: T.DataType = T.StringType()
        elif name == "timestamp":
            dtype = T.TimestampType()
        elif name in CALENDAR_COLUMNS:
            dtype = T.IntegerType()
        else:
            dtype = T.DoubleType()
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


# PM2.5 breakpoints (concentration low, high, index low, high).
PM25_BREAKPOINTS = [
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 350.4, 301, 400),
    (350.5, 500.4, 401, 500),
]
PM25_CAP = 500.4
AQI_CAP = 500.0

# Index categories (label, min, max, colour, advice).
AQI_CATEGORIES = [
    ("Good", 0, 50, "#00E400", "Air quality is satisfactory."),
    (
        "Moderate",
        51,
        100,
        "#FFFF00",
        "Unusually sensitive people should consider reducing prolonged outdoor exertion.",
    ),
    ("Unhealthy (SG)", 101, 150, "#FF7E00", "Sensitive groups should reduce outdoor activity."),
    ("Unhealthy", 151, 200, "#FF0000", "Everyone may begin to experience health effects."),
    (
        "Very Unhealthy",
        201,
        300,
        "#8F3F97",
        "Health alert: everyone may experience more serious effects.",
    ),
    ("Hazardous", 301, 500, "#7E0023", "Health warning of emergency conditions."),
]

# Monthly climate means (month, temperature, humidity, wind, pressure).
CLIMATOLOGY = [
    (1, 9.5, 68.0, 2.5, 1018.0),
    (2, 11.5, 65.0, 2.8, 1015.0),
    (3, 17.0, 60.0, 3.2, 1010.0),
    (4, 23.0, 55.0, 3.5, 1005.0),
    (5, 29.0, 40.0, 4.0, 1000.0),
    (6, 33.5, 45.0, 4.5, 996.0),
    (7, 31.0, 70.0, 3.8, 994.0),
    (8, 29.5, 72.0, 3.2, 995.0),
    (9, 26.0, 65.0, 2.8, 1000.0),
    (10, 21.0, 55.0, 2.2, 1008.0),
    (11, 14.5, 60.0, 2.0, 1014.0),
    (12, 10.0, 68.0, 2.2, 1017.0),
]
CLIMATOLOGY_SCHEMA = (
    "month INT, clim_temperature DOUBLE, clim_humidity DOUBLE, "
    "clim_wind_speed DOUBLE, clim_pressure DOUBLE"
)

# Raw payload files: one JSON object per line, wrapped in a small envelope.
_ENVELOPE = "city STRING, fetched_at TIMESTAMP, ingest_seq BIGINT"
_CONCENTRATION = "STRUCT<v: DOUBLE>"
AQI_PAYLOAD_SCHEMA = (
    f"{_ENVELOPE}, status STRING, data STRUCT<aqi: DOUBLE, iaqi: STRUCT<"
    + ", ".join(f"{p}: {_CONCENTRATION}" for p in POLLUTANT_COLUMNS)
    + ">>"
)
WEATHER_PAYLOAD_SCHEMA = (
    f"{_ENVELOPE}, main STRUCT<temp: DOUBLE, humidity: DOUBLE, pressure: DOUBLE>, "
    "wind STRUCT<speed: DOUBLE, deg: DOUBLE>, visibility DOUBLE, "
    "weather ARRAY<STRUCT<description: STRING>>"
)
MEASUREMENT_PAYLOAD_SCHEMA = (
    f"{_ENVELOPE}, date DATE, results ARRAY<STRUCT<value: DOUBLE>>"
)
