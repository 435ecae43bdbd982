from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UTC = dt.timezone.utc


def day(n: int, hour: int = 0) -> dt.datetime:
    return dt.datetime(2026, 1, 1, hour, tzinfo=UTC) + dt.timedelta(days=n)


def evaluate(
    spark: SparkSession, expression: Callable[[Column], Column], values: list, dtype: str = "DOUBLE"
) -> list:
    """The expression over column ``x``, in input order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i INT, x {dtype}")
    return [r["y"] for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def series(spark: SparkSession, values: list[float | None], city: str = "harbour") -> DataFrame:
    rows = [
        (city, day(i), v, 20.0 + i, 40.0 + i) for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "city STRING, timestamp TIMESTAMP, aqi DOUBLE, temperature DOUBLE, humidity DOUBLE"
    )


def physical_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def one(df: DataFrame, column: str) -> object:
    return df.select(F.col(column)).first()[0]
