"""Orderings, first and last rows, frequent values and the time split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zephyrine.session import scratch_path


def sort_by_time(df: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Global order, for output only: operators order inside their own windows."""
    return df.orderBy(*order)


def first_n(df: DataFrame, n: int = 10, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_n(df: DataFrame, n: int = 10, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    newest = df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return newest.orderBy(*order)


def last_n_per_key(
    df: DataFrame, n: int, keys: Sequence[str] = ("city",), order: Sequence[str] = ("timestamp",)
) -> DataFrame:
    """The newest ``n`` rows of each key; Spark keeps only those before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    ranked = df.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def top_values(df: DataFrame, column: str = "aqi", n: int = 20) -> DataFrame:
    """Most frequent values; equal counts come in value order."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(column)).limit(n)


def rank_models(metrics: DataFrame) -> DataFrame:
    """One row per model: rank by RMSE, then name."""
    best_first = Window.orderBy("rmse", "name")  # a handful of models, one row each
    return metrics.withColumn("rank", F.row_number().over(best_first)).orderBy("rank")


# Cities (about 40 bytes each) whose cutoffs may be broadcast, and parts a city is cut into
# beyond that, so that a hot one does not meet its cutoff in a single task.
BROADCAST_CITIES = 500_000
CITY_PARTS = 64


def _with_cutoffs(df: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Adds each city's ``_cutoff`` without gathering the rows of a city."""
    path = scratch_path(df.sparkSession, "cutoffs")
    cutoffs.write.parquet(path)
    stored = df.sparkSession.read.schema(cutoffs.schema).parquet(path)
    if stored.count() <= BROADCAST_CITIES:
        return df.join(F.broadcast(stored), "city")
    parts = stored.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(CITY_PARTS - 1))))
    dealt = df.withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(CITY_PARTS)).cast("int"))
    return dealt.join(parts, ["city", "_part"]).drop("_part")


def time_split(
    df: DataFrame, days: int = 365, time_column: str = "timestamp", per_city: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(train, test): test holds the rows after the latest timestamp minus ``days``.

    The cutoff is a scalar subquery, which Spark evaluates first and pushes to the scan.
    """
    back = F.expr(f"INTERVAL {int(days)} DAYS")
    if per_city:
        cutoffs = df.groupBy("city").agg((F.max(time_column) - back).alias("_cutoff"))
        marked = _with_cutoffs(df, cutoffs)
        train = marked.filter(F.col(time_column) <= F.col("_cutoff"))
        test = marked.filter(F.col(time_column) > F.col("_cutoff"))
        return train.drop("_cutoff"), test.drop("_cutoff")
    cutoff = df.agg((F.max(time_column) - back).alias("cutoff")).scalar()
    train = df.filter(F.col(time_column) <= cutoff)
    return train, df.filter(F.col(time_column) > cutoff)


def time_series_listing(df: DataFrame, time_column: str = "timestamp") -> DataFrame:
    return df.select(time_column, "aqi")


def top_attributions(
    df: DataFrame, n: int = 15, keys: Sequence[str] = ("city",), value: str = "contribution"
) -> DataFrame:
    """Per key the ``n`` largest contributions by size, ties in feature order."""
    size: Column = F.abs(F.col(value)).desc()
    window = Window.partitionBy(*keys).orderBy(size, "feature")
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)
