"""Data-quality reports, each one aggregate over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.functions.calendar import year_month
from zephyrine.functions.index import pm25_to_aqi
from zephyrine.functions.numeric import exact_mean, half_even
from zephyrine.operators.quality import filter_valid_measurements
from zephyrine.operators.quantiles import exact_quantiles


def daily_pm25_mean(
    df: DataFrame, keys: Sequence[str] = ("city", "day"), value: str = "value"
) -> DataFrame:
    """Mean of the valid measurements per key, two decimals, and its index; exact in any order."""
    mean = half_even(exact_mean(F.col(value)), 2)
    daily = filter_valid_measurements(df, value).groupBy(*keys).agg(mean.alias("pm25"))
    return daily.withColumn("aqi", pm25_to_aqi(F.col("pm25")))


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum."""
    low, middle, high = exact_quantiles(df, [column], [0.25, 0.5, 0.75])[column]
    return df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.lit(low).cast("double").alias("p25"),
        F.lit(middle).cast("double").alias("p50"),
        F.lit(high).cast("double").alias("p75"),
        F.max(column).alias("max"),
    )


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    counter = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(counter(column).alias("distinct_values"))


def monthly_stats(df: DataFrame, time_column: str = "timestamp", column: str = "aqi") -> DataFrame:
    return (
        df.groupBy(year_month(F.col(time_column)).alias("year_month"))
        .agg(
            F.avg(column).alias("mean"),
            F.min(column).alias("min"),
            F.max(column).alias("max"),
            F.stddev_samp(column).alias("std"),
        )
        .orderBy("year_month")
    )


def table_profile(df: DataFrame, column: str = "aqi") -> DataFrame:
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.lit(",".join(df.columns)).alias("column_names"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.count_distinct(column).alias("distinct_values"),
    )


def value_counts_by_value(df: DataFrame, column: str = "aqi") -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(column)


def missing_counts(df: DataFrame) -> DataFrame:
    """Columns with missing values and how many, from one pass."""

    def missing(name: str, dtype: str) -> Column:
        absent = F.col(name).isNull()
        return absent | F.isnan(name) if dtype in ("double", "float") else absent

    counts = df.agg(*[F.count_if(missing(n, t)).alias(n) for n, t in df.dtypes])
    cells = [
        F.struct(F.lit(n).alias("column_name"), F.col(n).alias("missing")) for n in df.columns
    ]
    return counts.select(F.inline(F.array(*cells))).filter(F.col("missing") > 0)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier full row; a missing value equals a missing value."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def time_range(df: DataFrame, time_column: str = "timestamp") -> DataFrame:
    return df.agg(F.min(time_column).alias("start"), F.max(time_column).alias("end"))


def backfill_summary(status: DataFrame) -> DataFrame:
    """Totals over the ``status`` column of the day-status join."""
    skipped = F.count_if(F.col("status") == "skipped")
    failed = F.count_if(F.col("status") == "failed")
    return status.agg(
        F.count("*").alias("total"),
        (F.count("*") - skipped - failed).alias("pushed"),
        skipped.alias("skipped"),
        failed.alias("failed"),
    )


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """RMSE, MAE and R² in one pass over the rows with both a label and a prediction.

    R² is measured against the mean of these rows.
    """
    error = F.col(label).cast("double") - F.col(prediction)
    residual = F.sum(error * error)
    total = F.var_pop(label) * F.count(label)
    r2 = F.when(total > 0, F.lit(1.0) - F.try_divide(residual, total)).otherwise(
        F.when(residual == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    )
    scored = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return scored.agg(
        F.count("*").alias("rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        r2.alias("r2"),
    )
