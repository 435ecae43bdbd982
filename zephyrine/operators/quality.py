"""Schema checks, row rules and guards."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zephyrine.functions.calendar import parse_timestamp_utc
from zephyrine.operators.ranking import last_n_per_key
from zephyrine.schema import REQUIRED_COLUMNS


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a bad row and never NULL."""

    name: str
    message: str
    broken: Column


def _between(column: str, low: float, high: float) -> Column:
    """Closed range in which a missing value does not lie."""
    return F.coalesce(F.col(column).between(F.lit(low), F.lit(high)), F.lit(False))


def _true(condition: Column) -> Column:
    """A comparison with a missing value does not hold."""
    return F.coalesce(condition, F.lit(False))


def frame_rules() -> list[Rule]:
    """Checked in this order. Missing humidity or temperature is bad; missing pressure
    or wind is not."""
    return [
        Rule(
            "timestamp",
            "timestamp: rows without a readable time",
            F.col("timestamp").isNull(),
        ),
        Rule("aqi_missing", "AQI: no value", F.col("aqi").isNull()),
        Rule("aqi_range", "AQI: outside 0 to 500", ~_between("aqi", 0, 500)),
        Rule("humidity", "humidity: missing or outside 0 to 100", ~_between("humidity", 0, 100)),
        Rule(
            "temperature",
            "temperature: missing or outside -90 to 70",
            ~_between("temperature", -90, 70),
        ),
        Rule("pressure", "pressure: zero or less", _true(F.col("pressure") <= 0)),
        Rule("wind_speed", "wind speed: under zero", _true(F.col("wind_speed") < 0)),
    ]


def ingest_rules() -> list[Rule]:
    """The lighter guard in front of the store."""
    return [
        Rule("aqi_missing", "AQI: no value", F.col("aqi").isNull()),
        Rule("aqi_negative", "AQI: under zero", ~_true(F.col("aqi") >= 0)),
        Rule("aqi_high", "AQI: over 500", ~_true(F.col("aqi") <= 500)),
        Rule(
            "temperature",
            "temperature: -90 degrees or colder",
            ~_true(F.col("temperature") > -90),
        ),
    ]


def missing_columns(required: Sequence[str], df: DataFrame) -> list[str]:
    return sorted(set(required).difference(df.columns))


def validate_schema(df: DataFrame, required: Sequence[str] = tuple(REQUIRED_COLUMNS)) -> None:
    if df.isEmpty():
        raise ValueError("the frame is empty, nothing to check")
    missing = missing_columns(required, df)
    if missing:
        # Fixed value: callers match this opening.
        raise ValueError(f"Missing required columns: {missing}")


def with_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``violations``: the names of the broken rules, in rule order."""
    names = [F.when(rule.broken, F.lit(rule.name)) for rule in rules]
    return df.withColumn("violations", F.array_compact(F.array(*names)))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their violations)."""
    marked = with_violations(df, rules)
    valid = marked.filter(F.size("violations") == 0).drop("violations")
    return valid, marked.filter(F.size("violations") > 0)


def count_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One pass over the data; one row per rule, in rule order."""
    counts = df.agg(*[F.count_if(rule.broken).alias(rule.name) for rule in rules])
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("rule_no"),
                F.lit(rule.name).alias("rule"),
                F.col(rule.name).alias("broken_rows"),
            )
            for i, rule in enumerate(rules, 1)
        ]
    )
    return counts.select(F.inline(cells))


def require_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Raises on the first broken rule, else hands the frame on."""
    counts = df.agg(*[F.count_if(rule.broken).alias(rule.name) for rule in rules]).first()
    for rule in rules:
        if counts[rule.name]:
            raise ValueError(rule.message)
    return df


def validate_feature_frame(df: DataFrame) -> DataFrame:
    """Strict validation: schema, then rows; ``timestamp`` comes back as UTC TIMESTAMP."""
    validate_schema(df)
    parsed = df.withColumn("timestamp", parse_timestamp_utc(F.col("timestamp")))
    return require_valid(parsed, frame_rules())


def filter_valid_measurements(df: DataFrame, column: str = "value") -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) >= 0))


def min_rows_guard(df: DataFrame, rows: int = 50) -> DataFrame:
    found = df.limit(rows).count()
    if found < rows:
        raise ValueError(f"Not enough data to train ({found} rows). Run backfill first.")
    return df


def recent_above(
    df: DataFrame,
    threshold: float = 75,
    n: int = 90,
    min_rows: int = 6,
    order: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """Per city the last ``n`` rows above the threshold, if there are at least ``min_rows``.

    The rank filter prunes to ``n`` rows per city before the shuffle.
    """
    newest = last_n_per_key(df.filter(F.col("aqi") > threshold), n, ["city"], order)
    rows = F.count("*").over(Window.partitionBy("city"))
    return newest.withColumn("_rows", rows).filter(F.col("_rows") >= min_rows).drop("_rows")
