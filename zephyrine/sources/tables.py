"""Reads of the keyed feature table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.sources.store import DATE_COLUMN, latest_per_key


def read_feature_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    since: dt.date | None = None,
    until: dt.date | None = None,
    city: str | None = None,
) -> DataFrame:
    """Column- and partition-pruned read; dates hit the ``event_date`` partitions."""
    df = spark.read.parquet(path)
    if since is not None:
        df = df.filter(F.col(DATE_COLUMN) >= F.lit(since))
    if until is not None:
        df = df.filter(F.col(DATE_COLUMN) <= F.lit(until))
    if city is not None:
        df = filter_city(df, city)
    return df.select(*columns) if columns else df


def filter_city(df: DataFrame, city: str) -> DataFrame:
    return df.filter(F.col("city") == city)


def read_with_fallback(
    primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame]
) -> tuple[DataFrame, str]:
    """The primary source, or the fallback if the primary cannot be resolved and read.

    Reads are lazy, so one row is fetched to make a missing or broken source show.
    """
    try:
        df = primary()
        df.limit(1).collect()
        return df, "primary"
    except (PySparkException, OSError):
        return fallback(), "fallback"


def latest_rows(
    df: DataFrame, keys: Sequence[str] = ("city",), order: Sequence[str] = ("timestamp",)
) -> DataFrame:
    """Last row per key as one partial aggregate: a hot key never reaches one task whole.

    Select the needed columns first: all columns of ``df`` travel with the aggregate.
    """
    return latest_per_key(df, keys, order)


def previous_aqi(df: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Latest known index per city."""
    latest = F.max_by("aqi", F.struct(*order)).alias("previous_aqi")
    return df.groupBy("city").agg(latest)
