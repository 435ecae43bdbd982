"""Whole jobs: live ingest from payload files and backfill from measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.plans.ingest import backfill, csv_backfill, ingest_payloads
from zephyrine.registry.base import (
    CLIMATE_SQL,
    INTERACTION_SQL,
    on_readings,
    query,
    readings,
    sql_aqi,
    sql_calendar,
    sql_change,
    sql_exact_mean,
    sql_jitter,
    sql_r,
    sql_text,
    text,
    written,
)
from zephyrine.registry.relations import SPINE_SQL, measurements, spine
from zephyrine.registry.scans import aqi_payloads, history_csv, weather_payloads
from zephyrine.schema import CALENDAR_COLUMNS, CYCLIC_COLUMNS, INTERACTION_COLUMNS
from zephyrine.session import scratch_path

ENGINEERED = [*CALENDAR_COLUMNS, *CYCLIC_COLUMNS, *INTERACTION_COLUMNS]

# Accepted payloads: latest valid air and weather per city and hour.
PAYLOAD_SQL = [
    """payload AS (SELECT *, date_trunc('hour', ts) AS h,
    CASE WHEN reading_id % 23 = 0 THEN aqi + 1000 ELSE aqi END AS told_aqi,
    CASE WHEN reading_id % 29 = 0 THEN -95 ELSE temperature END AS told_temperature FROM readings)""",
    """air_payload AS (SELECT * FROM payload WHERE reading_id % 17 <> 0 AND told_aqi BETWEEN 0 AND 500)""",
    """weather_payload AS (SELECT * FROM payload WHERE reading_id % 19 <> 0 AND reading_id % 13 <> 0
    AND humidity IS NOT NULL AND told_temperature > -90)""",
    """air AS (SELECT city, h, told_aqi AS aqi, pm10 FROM air_payload
  QUALIFY row_number() OVER (PARTITION BY city, h ORDER BY ts DESC, reading_id DESC) = 1)""",
    """weather AS (SELECT city, h, told_temperature AS temperature, humidity, pressure, wind_speed,
    CASE WHEN reading_id % 4 <> 0 THEN CAST(reading_id % 10000 AS DOUBLE) END AS visibility
  FROM weather_payload QUALIFY row_number() OVER (PARTITION BY city, h ORDER BY ts DESC, reading_id DESC) = 1)""",
    "valid AS (SELECT * FROM air JOIN weather USING (city, h))",
]
INGEST_SQL = on_readings(
    f"""SELECT city, {sql_text('h')} AS ts, aqi, pm10, temperature, visibility, {sql_calendar('h')},
  {INTERACTION_SQL}, {sql_change('aqi', 'lag(aqi) OVER (PARTITION BY city ORDER BY h)')} AS aqi_change_rate
FROM valid""",
    *PAYLOAD_SQL,
)
STORED = ["aqi", "pm10", "temperature", "visibility", *ENGINEERED]


def payloads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Air and weather payloads, some of them outside the ingest rules."""
    number = F.col("ingest_seq")
    air, weather = aqi_payloads(spark, sf_dir), weather_payloads(spark, sf_dir)
    aqi = F.when(number % 23 == 0, F.col("data.aqi") + 1000).otherwise(F.col("data.aqi"))
    temp = F.when(number % 29 == 0, F.lit(-95.0)).otherwise(F.col("main.temp"))
    return (
        air.withColumn("data", F.col("data").withField("aqi", aqi)),
        weather.withColumn("main", F.col("main").withField("temp", temp)),
    )


def deliveries(air: DataFrame, weather: DataFrame, count: int = 3) -> list[tuple[DataFrame, DataFrame]]:
    """Payloads cut at equal times inside hours, the weather always twelve hours later than the
    air: of the hours in between the partners come in different deliveries."""
    stamp = F.unix_micros("fetched_at")
    ends = air.agg(F.min(stamp).alias("low"), F.max(stamp).alias("high")).first()
    low, span = ends["low"] or 0, max(1, (ends["high"] or 0) - (ends["low"] or 0))
    half_day = 12 * 3_600_000_000

    def part(shift: int):
        share = F.floor((stamp - F.lit(low) - F.lit(shift)) * F.lit(count) / F.lit(span))
        return F.greatest(F.lit(0), F.least(share, F.lit(count - 1)))

    return [(air.filter(part(0) == k), weather.filter(part(half_day) == k)) for k in range(count)]


def _ingested(spark: SparkSession, sf_dir: str, rejects: str) -> DataFrame:
    """Deliveries of payload files, each upserted into the feature table."""
    table = scratch_path(spark, "features")
    for seq, (air, weather) in enumerate(deliveries(*payloads(spark, sf_dir)), 1):
        stored = ingest_payloads(
            spark,
            written(air, "aqi-payloads", "json"),
            written(weather, "weather-payloads", "json"),
            table,
            seq,
            rejects,
        )
    return stored


@query("e1_live_ingest", INGEST_SQL)
def _live_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ingested(spark, sf_dir, scratch_path(spark, "rejects"))
    return rows.select("city", text("timestamp").alias("ts"), *STORED)


REFUSED_SQL = """
  SELECT 'aqi' AS source, CASE WHEN reading_id % 17 = 0 THEN 'status is not ok'
    ELSE 'outside the ingest rules' END AS reason FROM payload
  WHERE reading_id % 17 = 0 OR NOT told_aqi BETWEEN 0 AND 500
  UNION ALL SELECT 'weather', CASE WHEN humidity IS NULL THEN 'missing humidity'
    WHEN reading_id % 19 = 0 THEN 'missing wind_speed' WHEN reading_id % 13 = 0 THEN 'missing weather_desc'
    ELSE 'outside the ingest rules' END FROM payload
  WHERE humidity IS NULL OR reading_id % 19 = 0 OR reading_id % 13 = 0 OR told_temperature <= -90"""


@query(
    "e1_live_ingest_rejects",
    on_readings(f"SELECT source, reason, count(*) AS n FROM ({REFUSED_SQL}) GROUP BY ALL", *PAYLOAD_SQL[:1]),
)
def _live_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the same deliveries turned down, by source and reason."""
    rejects = scratch_path(spark, "rejects")
    _ingested(spark, sf_dir, rejects)
    return spark.read.parquet(rejects).groupBy("source", "reason").agg(F.count("*").alias("n"))


BACKFILL_SQL = on_readings(
    f"""SELECT city, {sql_text('midnight + INTERVAL 12 HOUR')} AS ts, aqi, pm25, temperature, humidity,
  pressure, wind_speed, wind_direction, visibility, {sql_calendar('midnight')}, {INTERACTION_SQL},
  {sql_change('aqi', 'lag(aqi) OVER (ORDER BY midnight)')} AS aqi_change_rate FROM jittered""",
    SPINE_SQL,
    CLIMATE_SQL,
    f"""means AS (SELECT CAST(day AS TIMESTAMP) AS midnight, pm25, {sql_aqi('pm25')} AS aqi FROM (
    SELECT ts::DATE AS day, {sql_r(sql_exact_mean('pm25'), 2)} AS pm25 FROM readings
    WHERE day(ts) % 7 <> 0 AND pm25 >= 0 GROUP BY 1)),
jittered AS (SELECT 'harbour' AS city, midnight, pm25, aqi,
    {sql_jitter("concat('harbour|', CAST(CAST(epoch(midnight) AS BIGINT) AS VARCHAR))")}
  FROM means JOIN clim ON clim.m = month(midnight))""",
)


@query("e1_backfill", BACKFILL_SQL)
def _backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means of every day with data, with keyed weather, to the feature table."""
    table, done = scratch_path(spark, "features"), scratch_path(spark, "processed")
    backfill(
        spark, measurements(spark, sf_dir), spine(spark, sf_dir), table, done, seq=1, city="harbour"
    )
    raw = ["aqi", "pm25", "temperature", "humidity", "pressure", "wind_speed", "wind_direction", "visibility"]
    return spark.read.parquet(table).select("city", text("timestamp").alias("ts"), *raw, *ENGINEERED)


@query(
    "e1_backfill_summary",
    on_readings(
        "SELECT count(*) AS total, count(*) FILTER (WHERE day IN (SELECT day FROM valid)) AS pushed, "
        "0 AS skipped, count(*) FILTER (WHERE day NOT IN (SELECT day FROM valid)) AS failed FROM spine",
        SPINE_SQL,
    ),
)
def _backfill_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, done = scratch_path(spark, "features"), scratch_path(spark, "processed")
    return backfill(
        spark,
        measurements(spark, sf_dir),
        spine(spark, sf_dir),
        table,
        done,
        seq=1,
        city="harbour",
        dry_run=True,
    )


CITY_BACKFILL_SQL = on_readings(
    f"""SELECT city, {sql_text('midnight + INTERVAL 12 HOUR')} AS ts, aqi, pm25, temperature, humidity,
  pressure, wind_speed, wind_direction, visibility, {sql_calendar('midnight')}, {INTERACTION_SQL},
  {sql_change('aqi', 'lag(aqi) OVER (PARTITION BY city ORDER BY midnight)')} AS aqi_change_rate FROM jittered""",
    CLIMATE_SQL,
    f"""means AS (SELECT city, CAST(day AS TIMESTAMP) AS midnight, pm25, {sql_aqi('pm25')} AS aqi FROM (
    SELECT city, ts::DATE AS day, {sql_r(sql_exact_mean('pm25'), 2)} AS pm25 FROM readings
    WHERE day(ts) % 7 <> 0 AND pm25 >= 0 GROUP BY 1, 2)),
jittered AS (SELECT city, midnight, pm25, aqi,
    {sql_jitter("concat(city, '|', CAST(CAST(epoch(midnight) AS BIGINT) AS VARCHAR))")}
  FROM means JOIN clim ON clim.m = month(midnight))""",
)


def city_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements of every city that leave each seventh day without a valid value."""
    usable = F.dayofmonth("ts") % 7 != 0
    return readings(spark, sf_dir).select(
        "city",
        F.to_date("ts").alias("day"),
        F.when(usable, F.col("pm25")).otherwise(F.lit(-1.0)).alias("value"),
    )


def cut_spans(rows: DataFrame, count: int = 3) -> list[DataFrame]:
    """Rows in deliveries cut inside days and between cities."""
    part = F.pmod(F.xxhash64("city", F.floor(F.col("value") * 7)), F.lit(count))
    return [rows.filter(part == k) for k in range(count)]


def half_spans(rows: DataFrame) -> list[DataFrame]:
    """Rows before and from the middle day of their range."""
    ends = rows.agg(F.min("day").alias("low"), F.max("day").alias("high")).first()
    middle = ends["low"] + (ends["high"] - ends["low"]) / 2
    return [rows.filter(F.col("day") < F.lit(middle)), rows.filter(F.col("day") >= F.lit(middle))]


def stored_features(spark: SparkSession, table: str) -> DataFrame:
    raw = ["aqi", "pm25", "temperature", "humidity", "pressure", "wind_speed", "wind_direction", "visibility"]
    return spark.read.parquet(table).select("city", text("timestamp").alias("ts"), *raw, *ENGINEERED)


@query("e1_backfill_resumed", CITY_BACKFILL_SQL)
def _backfill_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every city in two spans: the second goes on from the first and repeats none of it."""
    table, done = scratch_path(spark, "features"), scratch_path(spark, "processed")
    rows = city_measurements(spark, sf_dir)
    first = half_spans(rows)[0]
    backfill(spark, first, first.select("day"), table, done, seq=1)
    backfill(spark, rows, rows.select("day"), table, done, seq=2)
    return stored_features(spark, table)


@query(
    "e1_csv_backfill",
    on_readings(
        f"""SELECT city, {sql_text('midnight + INTERVAL 12 HOUR')} AS ts, aqi, pm25, temperature,
  {sql_calendar('midnight')}, {sql_change('aqi', 'lag(aqi) OVER (ORDER BY midnight)')} AS aqi_change_rate
FROM jittered""",
        CLIMATE_SQL,
        f"""means AS (SELECT date_trunc('day', ts) AS midnight, max(pm25) AS pm25, {sql_aqi('max(pm25)')} AS aqi
  FROM readings WHERE reading_id % 7 <> 0 AND reading_id % 11 <> 0 GROUP BY 1),
jittered AS (SELECT 'harbour' AS city, midnight, pm25, aqi,
    {sql_jitter("concat('harbour|', CAST(CAST(epoch(midnight) AS BIGINT) AS VARCHAR))")}
  FROM means JOIN clim ON clim.m = month(midnight))""",
    ),
)
def _csv_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history CSV stored as daily feature rows."""
    table = scratch_path(spark, "features")
    csv_backfill(spark, history_csv(spark, sf_dir), "harbour", table, seq=1)
    return spark.read.parquet(table).select(
        "city", text("timestamp").alias("ts"), "aqi", "pm25", "temperature", *CALENDAR_COLUMNS, *CYCLIC_COLUMNS,
        "aqi_change_rate",
    )
