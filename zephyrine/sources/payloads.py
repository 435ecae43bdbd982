"""Raw JSON payload files to flat readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.functions.numeric import cast_nullable_doubles, nan_to_null
from zephyrine.schema import (
    AQI_PAYLOAD_SCHEMA,
    MEASUREMENT_PAYLOAD_SCHEMA,
    POLLUTANT_COLUMNS,
    WEATHER_COLUMNS,
    WEATHER_PAYLOAD_SCHEMA,
)

CORRUPT = "_corrupt"


def read_payload_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per line; an unreadable line is kept whole in ``_corrupt``."""
    return (
        spark.read.schema(f"{schema}, {CORRUPT} STRING")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def _corrupt(df: DataFrame) -> Column:
    return F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)


def _split(df: DataFrame, reason: Column, columns: list[Column]) -> tuple[DataFrame, DataFrame]:
    marked = df.withColumn("reject_reason", reason)
    accepted = marked.filter(F.col("reject_reason").isNull()).select(*columns)
    rejected = marked.filter(F.col("reject_reason").isNotNull())
    return accepted, rejected


def marked_payloads(raw: DataFrame, reason: Column, columns: list[Column]) -> DataFrame:
    """The parsed columns of every payload, with ``raw`` as it came and ``reject_reason``."""
    came = F.struct(*[F.col(f"`{c}`") for c in raw.columns])
    return raw.select(*columns, came.alias("raw"), reason.alias("reject_reason"))


def aqi_parts(raw: DataFrame) -> tuple[Column, list[Column]]:
    """Why a payload is rejected, and its columns."""
    reason = (
        F.when(_corrupt(raw), F.lit("malformed payload"))
        .when(~F.col("status").eqNullSafe(F.lit("ok")), F.lit("status is not ok"))
    )
    columns = [
        F.col("city"),
        F.col("fetched_at"),
        F.col("ingest_seq"),
        nan_to_null(F.col("data.aqi")).alias("aqi"),
        *[nan_to_null(F.col(f"data.iaqi.{p}.v")).alias(p) for p in POLLUTANT_COLUMNS],
    ]
    return reason, columns


def parse_aqi_payloads(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). Missing sub-objects become NULL; status must be ``ok``."""
    return _split(raw, *aqi_parts(raw))


def weather_parts(raw: DataFrame) -> tuple[Column, list[Column]]:
    """Why a payload is rejected, and its columns."""
    description = F.get(F.col("weather"), F.lit(0)).getField("description")
    mandatory = {
        "temperature": F.col("main.temp"),
        "humidity": F.col("main.humidity"),
        "pressure": F.col("main.pressure"),
        "wind_speed": F.col("wind.speed"),
    }
    reason = F.when(_corrupt(raw), F.lit("malformed payload"))
    for name, value in mandatory.items():
        reason = reason.when(value.isNull(), F.lit(f"missing {name}"))
    reason = reason.when(description.isNull(), F.lit("missing weather_desc"))
    columns = [
        F.col("city"),
        F.col("fetched_at"),
        F.col("ingest_seq"),
        *[nan_to_null(value).alias(name) for name, value in mandatory.items()],
        nan_to_null(F.col("wind.deg")).alias("wind_direction"),
        nan_to_null(F.col("visibility")).alias("visibility"),
        description.alias("weather_desc"),
    ]
    return reason, columns


def parse_weather_payloads(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). Main block, wind speed and a first description are mandatory."""
    return _split(raw, *weather_parts(raw))


def scan_aqi_payloads(spark: SparkSession, path: str) -> DataFrame:
    return parse_aqi_payloads(read_payload_lines(spark, path, AQI_PAYLOAD_SCHEMA))[0]


def scan_weather_payloads(spark: SparkSession, path: str) -> DataFrame:
    return parse_weather_payloads(read_payload_lines(spark, path, WEATHER_PAYLOAD_SCHEMA))[0]


def parse_measurement_payloads(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): one accepted row per measurement, all of them."""
    reason = F.when(_corrupt(raw), F.lit("malformed payload"))
    columns = [
        F.col("city"),
        F.col("ingest_seq"),
        F.col("date").alias("day"),
        F.posexplode("results").alias("position", "measurement"),
    ]
    accepted, rejected = _split(raw, reason, columns)
    value = nan_to_null(F.col("measurement.value")).alias("value")
    return accepted.select("city", "ingest_seq", "day", "position", value), rejected


def scan_measurement_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per measurement of every readable payload."""
    return parse_measurement_payloads(read_payload_lines(spark, path, MEASUREMENT_PAYLOAD_SCHEMA))[0]


def clean_readings(df: DataFrame) -> DataFrame:
    """NaN to NULL, once, at the scan; NULL is the only missing marker afterwards."""
    return cast_nullable_doubles(df, ["aqi", *POLLUTANT_COLUMNS, *WEATHER_COLUMNS])
