"""Streaming jobs run to the end over the given files, each against its batch twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.registry.base import (
    EVENTS_SCHEMA,
    INTERACTION_SQL,
    as_readings,
    day_text,
    events,
    on_hourly,
    on_readings,
    query,
    sql_aqi,
    sql_calendar,
    sql_change,
    sql_day,
    sql_exact_mean,
    sql_r,
    sql_text,
    text,
)
from zephyrine.registry.jobs import (
    CITY_BACKFILL_SQL,
    INGEST_SQL,
    PAYLOAD_SQL,
    REFUSED_SQL,
    STORED,
    city_measurements,
    cut_spans,
    deliveries,
    half_spans,
    payloads,
    stored_features,
)
from zephyrine.schema import CALENDAR_COLUMNS, CYCLIC_COLUMNS, INTERACTION_COLUMNS
from zephyrine.session import scratch_path
from zephyrine.streaming.jobs import (
    level_changes,
    read_rejects,
    read_stream,
    stream_alerts,
    stream_backfill,
    stream_change_rate,
    stream_daily_mean,
    stream_daily_mean_open,
    stream_dedup,
    stream_hourly_features,
    stream_payloads,
)


def reading_stream(spark: SparkSession, path: str) -> DataFrame:
    return as_readings(read_stream(spark, path, EVENTS_SCHEMA))


def arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading_stream(spark, f"{sf_dir}/events*.parquet")


DELIVERIES = 4


def delivered(rows: DataFrame, time: str = "ts") -> list[DataFrame]:
    """The rows in deliveries cut inside hours, with every eleventh row of all times last."""
    ends = rows.agg(F.unix_micros(F.min(F.col(time).cast("timestamp"))).alias("low"),
                    F.unix_micros(F.max(F.col(time).cast("timestamp"))).alias("high")).first()
    span = max(1, (ends["high"] or 0) - (ends["low"] or 0))
    share = (F.unix_micros(F.col(time).cast("timestamp")) - F.lit(ends["low"])) / F.lit(span)
    on_time = F.least(F.floor(share * (DELIVERIES - 1)), F.lit(DELIVERIES - 2))
    part = F.when(F.col("event_id") % 11 == 0, F.lit(DELIVERIES - 1)).otherwise(on_time)
    return [rows.filter(part == i) for i in range(DELIVERIES)]


def in_deliveries(spark: SparkSession, sf_dir: str, job: Callable[[DataFrame], None]) -> None:
    """Runs the job once per delivery of ``events`` into a growing folder."""
    source = scratch_path(spark, "arrivals")
    for part in delivered(events(spark, sf_dir)):
        part.write.mode("append").parquet(source)
        job(reading_stream(spark, source))


def with_invalid(readings: DataFrame) -> DataFrame:
    """Every 23rd reading lies outside the guard."""
    told = F.when(F.col("reading_id") % 23 == 0, F.col("aqi") + 1000).otherwise(F.col("aqi"))
    return readings.withColumn("aqi", told)


VALID_HOURLY_SQL = """hourly AS (
  SELECT *, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp" FROM readings
  WHERE reading_id % 23 <> 0 AND aqi BETWEEN 0 AND 500 AND temperature > -90
  QUALIFY row_number() OVER (PARTITION BY city, date_trunc('hour', ts)
                             ORDER BY ts DESC, reading_id DESC) = 1)"""
# Longer than the readings span: the last delivery holds some of every time.
ANY_TIME = "400 days"

HOUR_WINDOW = 'OVER (PARTITION BY city ORDER BY "timestamp")'


@query(
    "st1_stream_hourly_features",
    on_readings(
        f"SELECT city, {sql_text('\"timestamp\"')} AS ts, aqi, pm10, {sql_calendar('\"timestamp\"')}, "
        f"{INTERACTION_SQL}, {sql_change('aqi', f'lag(aqi) {HOUR_WINDOW}')} AS aqi_change_rate FROM hourly",
        VALID_HOURLY_SQL,
    ),
)
def _hourly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_path(spark, "stream-table")
    checkpoint = scratch_path(spark, "checkpoint")

    def job(readings: DataFrame) -> None:
        stream_hourly_features(with_invalid(readings), table, checkpoint, delay=ANY_TIME)

    in_deliveries(spark, sf_dir, job)
    columns = [*CALENDAR_COLUMNS, *CYCLIC_COLUMNS, *INTERACTION_COLUMNS]
    return spark.read.parquet(table).select(
        "city", text("timestamp").alias("ts"), "aqi", "pm10", *columns
    )


def _payload_stream(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Deliveries with partners apart, drained one after the other; table and rejects."""
    table, state, rejects = (scratch_path(spark, n) for n in ("stream-table", "state", "rejects"))
    sources = scratch_path(spark, "aqi-arrivals"), scratch_path(spark, "weather-arrivals")
    for parts in deliveries(*payloads(spark, sf_dir)):
        for part, source in zip(parts, sources):
            part.write.mode("append").json(source)
        stream_payloads(spark, *sources, table, state, rejects)
    return table, rejects


@query("st1_payload_stream", INGEST_SQL)
def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of payload files through the stream-stream join to the feature table."""
    table, _ = _payload_stream(spark, sf_dir)
    return spark.read.parquet(table).select("city", text("timestamp").alias("ts"), *STORED)


@query(
    "st1_payload_rejects",
    on_readings(
        f"SELECT source, reason, count(*) AS n FROM ({REFUSED_SQL} "
        "UNION ALL SELECT 'aqi', 'no weather of the hour' FROM air_payload a, mark "
        "WHERE h <= closed AND NOT EXISTS (FROM weather_payload w WHERE w.city = a.city AND w.h = a.h) "
        "UNION ALL SELECT 'weather', 'no air reading of the hour' FROM weather_payload w, mark "
        "WHERE h <= closed AND NOT EXISTS (FROM air_payload a WHERE w.city = a.city AND w.h = a.h)) GROUP BY ALL",
        *PAYLOAD_SQL[:3],
        "mark AS (SELECT least((SELECT max(h) FROM air_payload), (SELECT max(h) FROM weather_payload)) "
        "- INTERVAL 1 DAY AS closed)",
    ),
)
def _payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the payload stream turned down, by source and reason."""
    _, rejects = _payload_stream(spark, sf_dir)
    return read_rejects(spark, rejects).groupBy("source", "reason").agg(F.count("*").alias("n"))


@query(
    "st2_stream_dedup",
    on_readings(f"SELECT DISTINCT city, {sql_text("date_trunc('hour', ts)")} AS hour_ts FROM readings"),
)
def _dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-unique")
    stamped = arriving(spark, sf_dir).withColumn("hour_ts", F.date_trunc("hour", "ts"))
    stream_dedup(stamped, path, scratch_path(spark, "checkpoint"), ["city", "hour_ts"])
    return spark.read.parquet(path).select("city", text("hour_ts").alias("hour_ts"))


@query(
    "st3_stream_change_rate",
    on_hourly(
        f"SELECT city, {sql_text('\"timestamp\"')} AS ts, aqi, "
        f"{sql_change('aqi', f'lag(aqi) {HOUR_WINDOW}')} AS aqi_change_rate FROM hourly"
    ),
)
def _change(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, checkpoint = scratch_path(spark, "stream-change"), scratch_path(spark, "checkpoint")
    in_deliveries(spark, sf_dir, lambda readings: stream_change_rate(readings, table, checkpoint, delay=ANY_TIME))
    rows = spark.read.parquet(table)
    return rows.select("city", text("timestamp").alias("ts"), "aqi", "aqi_change_rate")


@query(
    "st4_stream_daily_mean",
    on_readings(
        f"SELECT city, {sql_day('day')} AS day, pm25, {sql_aqi('pm25')} AS aqi FROM ("
        f"SELECT city, CAST(ts AS DATE) AS day, {sql_r(sql_exact_mean('pm25'), 2)} AS pm25 FROM readings WHERE pm25 >= 0 "
        "GROUP BY ALL) WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM readings) - INTERVAL 1 HOUR"
    ),
)
def _daily_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days the watermark has closed; the last one is still open."""
    path = scratch_path(spark, "stream-daily")
    stream_daily_mean(arriving(spark, sf_dir), path, scratch_path(spark, "checkpoint"))
    return spark.read.parquet(path).withColumn("day", day_text("day"))


@query(
    "st4_stream_daily_mean_open",
    on_readings(
        f"SELECT city, {sql_day('day')} AS day, pm25, {sql_aqi('pm25')} AS aqi FROM ("
        f"SELECT city, CAST(ts AS DATE) AS day, {sql_r(sql_exact_mean('pm25'), 2)} AS pm25 FROM readings WHERE pm25 >= 0 "
        "GROUP BY ALL)"
    ),
)
def _daily_mean_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day, the open one included."""
    table = scratch_path(spark, "stream-daily")
    stream_daily_mean_open(arriving(spark, sf_dir), table, scratch_path(spark, "checkpoint"))
    return spark.read.parquet(table).select("city", day_text("day").alias("day"), "pm25", "aqi")


LEVEL_SQL = """CASE WHEN aqi <= 50 THEN 'good' WHEN aqi <= 100 THEN 'moderate'
  WHEN aqi <= 150 THEN 'unhealthy_sensitive' WHEN aqi <= 200 THEN 'unhealthy'
  WHEN aqi <= 300 THEN 'very_unhealthy' ELSE 'hazardous' END"""


@query(
    "st5_stream_alerts",
    on_hourly(
        f"SELECT city, {sql_text('\"timestamp\"')} AS ts, aqi, level, previous_level FROM ("
        f"SELECT *, lag(level) {HOUR_WINDOW} AS previous_level FROM (SELECT *, {LEVEL_SQL} AS level FROM hourly)) "
        "WHERE level IS DISTINCT FROM previous_level"
    ),
)
def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, checkpoint = scratch_path(spark, "stream-alerts"), scratch_path(spark, "checkpoint")
    in_deliveries(spark, sf_dir, lambda readings: stream_alerts(readings, table, checkpoint, delay=ANY_TIME))
    rows = level_changes(spark.read.parquet(table))
    return rows.select("city", text("timestamp").alias("ts"), "aqi", "level", "previous_level")


@query("st6_resumed_stream", CITY_BACKFILL_SQL)
def _resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill from files: the second run meets only those of the second half of the days."""
    source, table = scratch_path(spark, "arrivals"), scratch_path(spark, "features")
    processed, checkpoint = scratch_path(spark, "processed"), scratch_path(spark, "checkpoint")
    for part in half_spans(city_measurements(spark, sf_dir)):
        part.write.mode("append").parquet(source)
        stream = read_stream(spark, source, "city STRING, day DATE, value DOUBLE")
        stream_backfill(stream, table, processed, checkpoint)
    return stored_features(spark, table)


@query("st6_stream_cut_inside_days", CITY_BACKFILL_SQL)
def _resumed_inside_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from deliveries that each hold a part of every day, cities cut differently."""
    source, table = scratch_path(spark, "arrivals"), scratch_path(spark, "features")
    processed, checkpoint = scratch_path(spark, "processed"), scratch_path(spark, "checkpoint")
    for part in cut_spans(city_measurements(spark, sf_dir)):
        part.write.mode("append").parquet(source)
        stream = read_stream(spark, source, "city STRING, day DATE, value DOUBLE")
        stream_backfill(stream, table, processed, checkpoint)
    return stored_features(spark, table)
