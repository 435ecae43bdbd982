"""Historical two-column CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.functions.calendar import parse_timestamp_utc
from zephyrine.functions.numeric import coerce_double

_CSV_SCHEMA = "date STRING, pm25 STRING"


def scan_history_csv(spark: SparkSession, path: str) -> DataFrame:
    """Columns by position; an unreadable date raises, a non-numeric PM2.5 row is dropped.

    Rows come back unordered: consumers order by ``timestamp`` where it matters.
    """
    raw = spark.read.schema(_CSV_SCHEMA).option("header", True).option(
        "enforceSchema", True
    ).csv(path)
    text = F.trim("date")
    parsed = F.coalesce(F.try_to_timestamp(text, F.lit("yyyy/M/d")), parse_timestamp_utc(text))
    message = F.concat(F.lit("unreadable date: "), F.coalesce(text, F.lit("NULL")))
    timestamp = F.when(parsed.isNotNull(), parsed).otherwise(
        F.raise_error(message).cast("timestamp")
    )
    parsed_rows = raw.select(timestamp.alias("timestamp"), coerce_double(F.col("pm25")).alias("pm25"))
    # Testing the date first makes a bad one raise even where PM2.5 is missing.
    return parsed_rows.filter(F.col("timestamp").isNotNull() & F.col("pm25").isNotNull())


def scan_named_history_csv(spark: SparkSession, path: str, city: str) -> DataFrame:
    """Local fallback: header names, strict year/month/day dates, one city per file set."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = sorted({"date", "pm25"}.difference(c.strip() for c in raw.columns))
    if missing:
        raise ValueError(f"Missing columns in history file: {missing}")
    named = raw.toDF(*[c.strip() for c in raw.columns])
    return named.select(
        F.lit(city).alias("city"),
        F.to_timestamp(F.trim("date"), "yyyy/M/d").alias("timestamp"),
        coerce_double(F.col("pm25")).alias("pm25"),
    ).filter(F.col("pm25").isNotNull())
