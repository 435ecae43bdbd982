"""Column selection and feature-row assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.functions.calendar import time_features
from zephyrine.functions.numeric import cast_nullable_doubles, change_rate
from zephyrine.functions.weather import interaction_features
from zephyrine.operators.series import add_change_rate
from zephyrine.schema import (
    FEATURE_TABLE_COLUMNS,
    NON_FEATURE_COLUMNS,
    NULLABLE_DOUBLE_COLUMNS,
    POLLUTANT_COLUMNS,
    WEATHER_COLUMNS,
    feature_table_schema,
)


def align_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``keep`` then ``columns``: missing ones become NULL doubles, extras go."""
    wanted = [*keep, *[c for c in columns if c not in keep]]
    return df.select(
        *[
            F.col(c) if c in df.columns else F.lit(None).cast("double").alias(c)
            for c in wanted
        ]
    )


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs: everything but identity, target and text columns."""
    return [c for c in df.columns if c not in NON_FEATURE_COLUMNS]


def intersect_columns(columns: Sequence[str], df: DataFrame) -> list[str]:
    return [c for c in columns if c in df.columns]


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def drop_all_missing_columns(df: DataFrame, candidates: Sequence[str] | None = None) -> DataFrame:
    """Removes columns without a single value, found in one aggregate over all of them."""
    candidates = list(candidates or df.columns)
    counts = df.agg(*[F.count(c).alias(c) for c in candidates]).first()
    return df.drop(*[c for c in candidates if counts[c] == 0])


def add_calendar_features(df: DataFrame, time_column: str = "timestamp") -> DataFrame:
    return df.withColumns(time_features(F.col(time_column)))


def add_interaction_features(df: DataFrame) -> DataFrame:
    return df.withColumns(interaction_features())


def assemble_feature_rows(
    df: DataFrame,
    calendar_column: str = "timestamp",
    keys: Sequence[str] = ("city",),
    order: Sequence[str] = ("timestamp",),
    extra: Sequence[str] = (),
    block_rows: int | None = None,
) -> DataFrame:
    """Readings with one row per key and time slot to the fixed feature-table columns.

    ``calendar_column`` may differ from the stored ``timestamp``: daily history rows
    are stamped at noon while their calendar features come from midnight.
    """
    rated = add_change_rate(_with_row_features(df, calendar_column), keys, order, block_rows)
    return _feature_columns(rated, extra)


def feature_rows_beside_previous(
    df: DataFrame, calendar_column: str = "timestamp", previous: str = "previous_aqi"
) -> DataFrame:
    """``assemble_feature_rows`` for rows that carry the index before theirs: no window."""
    rate = change_rate(F.col("aqi"), F.col(previous))
    return _feature_columns(_with_row_features(df, calendar_column).withColumn("aqi_change_rate", rate))


def _with_row_features(df: DataFrame, calendar_column: str) -> DataFrame:
    absent = [
        c for c in [*POLLUTANT_COLUMNS, *WEATHER_COLUMNS] if c not in df.columns
    ]
    full = df.withColumns({c: F.lit(None).cast("double") for c in absent}) if absent else df
    full = cast_nullable_doubles(full, NULLABLE_DOUBLE_COLUMNS)
    return add_interaction_features(add_calendar_features(full, calendar_column))


def _feature_columns(full: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    types = {f.name: f.dataType for f in feature_table_schema().fields}
    return full.select(
        *[F.col(c).cast(types[c]).alias(c) for c in FEATURE_TABLE_COLUMNS], *extra
    )
