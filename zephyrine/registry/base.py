"""Registration, the readings view over ``events`` and shared SQL fragments."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.functions.numeric import half_even
from zephyrine.operators.series import resample_latest
from zephyrine.session import scratch_path, use_utc
from zephyrine.sources.payloads import clean_readings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(use_utc(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


READING_ORDER = ["ts", "reading_id"]
EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def as_readings(events: DataFrame) -> DataFrame:
    """``events`` in the shape of air-quality readings; ``value`` serves as PM2.5 and index."""
    number = F.col("event_id")
    user = F.col("user_id")
    return clean_readings(
        events.select(
            number.alias("reading_id"),
            F.col("event_type").alias("city"),
            user.alias("station_id"),
            F.col("ts").cast("timestamp").alias("ts"),
            F.col("value").alias("pm25"),
            F.col("value").alias("aqi"),
            F.get_json_object("props", "$.k").cast("double").alias("humidity"),
            ((number % 450).cast("double") / F.lit(10.0) - F.lit(5.0)).alias("temperature"),
            (F.lit(980) + number % 51).cast("double").alias("pressure"),
            ((user % 80).cast("double") / F.lit(10.0)).alias("wind_speed"),
            F.when(number % 3 != 0, (number % 200).cast("double")).alias("pm10"),
            F.lit(None).cast("double").alias("no2"),
        )
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(events(spark, sf_dir))


def _resampled(
    spark: SparkSession, sf_dir: str, key: str, grain: str, columns: Sequence[str] | None
) -> DataFrame:
    rows = readings(spark, sf_dir)
    if columns is not None:
        rows = rows.select(*dict.fromkeys([key, *READING_ORDER, *columns]))
    slots = resample_latest(rows, [key], grain, READING_ORDER, time_column="ts")
    return slots.withColumnRenamed("slot", "timestamp")


def daily(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Latest reading per station and day; ``timestamp`` is the day."""
    return _resampled(spark, sf_dir, "station_id", "day", columns)


def hourly(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Latest reading per city and hour; ``timestamp`` is the hour."""
    return _resampled(spark, sf_dir, "city", "hour", columns)


def written(df: DataFrame, label: str, file_format: str = "parquet", **options: object) -> str:
    """Writes input files for a scan query into the shared scratch folder."""
    path = scratch_path(df.sparkSession, label)
    df.write.format(file_format).options(**options).save(path)
    return path


def text(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def day_text(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def r6(value: str | Column) -> Column:
    return half_even(F.col(value) if isinstance(value, str) else value, 6)


def rounded(df: DataFrame, keep: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    return df.select(*keep, *[r6(c).alias(c) for c in columns])


READINGS_SQL = """readings AS (
  SELECT event_id AS reading_id, event_type AS city, user_id AS station_id, ts,
         value AS pm25, value AS aqi,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity,
         CAST(event_id % 450 AS DOUBLE) / 10 - 5 AS temperature,
         CAST(980 + event_id % 51 AS DOUBLE) AS pressure,
         CAST(user_id % 80 AS DOUBLE) / 10 AS wind_speed,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 200 AS DOUBLE) END AS pm10,
         CAST(NULL AS DOUBLE) AS no2
  FROM events)"""

DAILY_SQL = """daily AS (
  SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS "timestamp" FROM readings
  QUALIFY row_number() OVER (PARTITION BY station_id, CAST(ts AS DATE)
                             ORDER BY ts DESC, reading_id DESC) = 1)"""

HOURLY_SQL = """hourly AS (
  SELECT *, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp" FROM readings
  QUALIFY row_number() OVER (PARTITION BY city, date_trunc('hour', ts)
                             ORDER BY ts DESC, reading_id DESC) = 1)"""

TS_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def sql_text(column: str) -> str:
    return TS_TEXT.format(column)


def sql_day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def sql_r(column: str, digits: int = 6) -> str:
    return f"round_even({column}, {digits}) + 0.0"


def sql_exact_mean(column: str) -> str:
    """Mean from whole-number sums of the two parts of a value, so that no order of adding counts."""
    scaled = f"({column} * 1048576.0::DOUBLE)"
    coarse = f"CAST(floor({scaled}) AS HUGEINT)"
    fine = f"CAST(floor(({scaled} - floor({scaled})) * 4294967296.0::DOUBLE) AS HUGEINT)"
    total = f"CAST(sum({coarse}) AS DOUBLE) / 1048576 + CAST(sum({fine}) AS DOUBLE) / 4503599627370496"
    return f"(({total}) / count({column}))"


def sql_rounded(columns: Sequence[str]) -> str:
    return ", ".join(f"{sql_r(c)} AS {c}" for c in columns)


def on_readings(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([READINGS_SQL, *ctes]) + "\n" + body


def on_daily(body: str, *ctes: str) -> str:
    return on_readings(body, DAILY_SQL, *ctes)


def on_hourly(body: str, *ctes: str) -> str:
    return on_readings(body, HOURLY_SQL, *ctes)


AQI_LADDER_SQL = """CASE
  WHEN {c} IS NULL OR isnan({c}) THEN 500.0
  WHEN least({c}, 500.4) BETWEEN 0.0 AND 12.0
    THEN round_even(50.0::DOUBLE / 12.0::DOUBLE * least({c}, 500.4) + 0, 1)
  WHEN least({c}, 500.4) BETWEEN 12.1 AND 35.4
    THEN round_even(49.0::DOUBLE / (35.4::DOUBLE - 12.1::DOUBLE) * (least({c}, 500.4) - 12.1::DOUBLE) + 51, 1)
  WHEN least({c}, 500.4) BETWEEN 35.5 AND 55.4
    THEN round_even(49.0::DOUBLE / (55.4::DOUBLE - 35.5::DOUBLE) * (least({c}, 500.4) - 35.5::DOUBLE) + 101, 1)
  WHEN least({c}, 500.4) BETWEEN 55.5 AND 150.4
    THEN round_even(49.0::DOUBLE / (150.4::DOUBLE - 55.5::DOUBLE) * (least({c}, 500.4) - 55.5::DOUBLE) + 151, 1)
  WHEN least({c}, 500.4) BETWEEN 150.5 AND 250.4
    THEN round_even(99.0::DOUBLE / (250.4::DOUBLE - 150.5::DOUBLE) * (least({c}, 500.4) - 150.5::DOUBLE) + 201, 1)
  WHEN least({c}, 500.4) BETWEEN 250.5 AND 350.4
    THEN round_even(99.0::DOUBLE / (350.4::DOUBLE - 250.5::DOUBLE) * (least({c}, 500.4) - 250.5::DOUBLE) + 301, 1)
  WHEN least({c}, 500.4) BETWEEN 350.5 AND 500.4
    THEN round_even(99.0::DOUBLE / (500.4::DOUBLE - 350.5::DOUBLE) * (least({c}, 500.4) - 350.5::DOUBLE) + 401, 1)
  ELSE 500.0 END"""


def sql_aqi(column: str) -> str:
    return AQI_LADDER_SQL.format(c=column)


def sql_category(column: str) -> str:
    """Label of the closed integer bands; everything else is the last one."""
    return f"""CASE WHEN {column} BETWEEN 0 AND 50 THEN 'Good'
  WHEN {column} BETWEEN 51 AND 100 THEN 'Moderate'
  WHEN {column} BETWEEN 101 AND 150 THEN 'Unhealthy (SG)'
  WHEN {column} BETWEEN 151 AND 200 THEN 'Unhealthy'
  WHEN {column} BETWEEN 201 AND 300 THEN 'Very Unhealthy'
  ELSE 'Hazardous' END"""


def sql_calendar(ts: str) -> str:
    """The 12 calendar and cyclic columns of a timestamp expression."""
    parts = {
        "hour": (f"hour({ts})", 24),
        "month": (f"month({ts})", 12),
        "weekday": (f"(isodow({ts}) - 1)", 7),
    }
    columns = [
        f"hour({ts}) AS hour",
        f"day({ts}) AS day",
        f"month({ts}) AS month",
        f"isodow({ts}) - 1 AS weekday",
        f"CASE WHEN month({ts}) IN (12, 1, 2) THEN 0 WHEN month({ts}) IN (3, 4, 5) THEN 1 "
        f"WHEN month({ts}) IN (6, 7, 8) THEN 2 ELSE 3 END AS season",
        f"CASE WHEN isodow({ts}) >= 6 THEN 1 ELSE 0 END AS is_weekend",
    ]
    for name, (part, period) in parts.items():
        for wave in ("sin", "cos"):
            value = f"{wave}(2 * pi() * {part} / {period}.0::DOUBLE)"
            columns.append(f"{sql_r(value)} AS {name}_{wave}")
    return ", ".join(columns)


INTERACTION_SQL = (
    "round_even(temperature * humidity / 100, 4) + 0.0 AS temp_humidity_index, "
    "round_even(pow(wind_speed, 1.5), 4) + 0.0 AS wind_dispersion, "
    "round_even(pressure / (wind_speed + 0.1::DOUBLE), 4) + 0.0 AS atmospheric_stability"
)


def sql_change(current: str, previous: str) -> str:
    return (
        f"coalesce(round_even(({current} - {previous}) / nullif({previous}, 0) * 100, 4) + 0.0, 0.0)"
    )


CLIMATE_SQL = """clim(m, t, h, w, p) AS (VALUES
  (1, 9.5::DOUBLE, 68.0::DOUBLE, 2.5::DOUBLE, 1018.0::DOUBLE), (2, 11.5, 65, 2.8, 1015), (3, 17.0, 60, 3.2, 1010),
  (4, 23.0, 55, 3.5, 1005), (5, 29.0, 40, 4.0, 1000), (6, 33.5, 45, 4.5, 996), (7, 31.0, 70, 3.8, 994),
  (8, 29.5, 72, 3.2, 995), (9, 26.0, 65, 2.8, 1000), (10, 21.0, 55, 2.2, 1008), (11, 14.5, 60, 2.0, 1014),
  (12, 10.0, 68, 2.2, 1017))"""


def _sql_uniform(key: str, salt: str) -> str:
    digest = f"substr(md5(concat({key}, '|{salt}')), 1, 8)"
    return f"(CAST(concat('0x', {digest}) AS BIGINT) / 4294967296.0::DOUBLE)"


def _sql_normal(key: str, salt: str) -> str:
    radius = f"sqrt(-2 * ln(1 - {_sql_uniform(key, salt + '.r')}))"
    return f"({radius} * cos(2 * pi() * {_sql_uniform(key, salt + '.a')}))"


def sql_jitter(key: str) -> str:
    """Keyed weather around the climate columns t, h, w and p."""
    temperature = sql_r(f"t + 2 * {_sql_normal(key, 'temperature')}", 2)
    wind = sql_r(f"greatest(0.0::DOUBLE, w + 0.8::DOUBLE * {_sql_normal(key, 'wind')})", 2)

    def steps(salt: str, count: int) -> str:
        return f"floor({_sql_uniform(key, salt)} * {count})"

    return f"""{temperature} AS temperature,
  greatest(10.0::DOUBLE, least(100.0::DOUBLE, h + {steps('humidity', 16)} - 8)) AS humidity,
  greatest(980.0::DOUBLE, least(1030.0::DOUBLE, p + {steps('pressure', 10)} - 5)) AS pressure,
  {wind} AS wind_speed, {steps('direction', 360)} AS wind_direction,
  [5000.0::DOUBLE, 8000.0::DOUBLE, 10000.0::DOUBLE, 10000.0::DOUBLE, 10000.0::DOUBLE]
    [CAST({steps('visibility', 5)} AS INTEGER) + 1] AS visibility"""
