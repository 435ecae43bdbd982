"""Joins, set operations and the report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.operators.blocks import BLOCK_ROWS
from zephyrine.operators.joins import (
    breakpoint_join,
    climatology_join,
    combine_sources,
    dates_without_data,
    day_status,
    days_between,
    pending_dates,
    previous_reading,
    segment_join,
)
from zephyrine.operators.profiling import backfill_summary
from zephyrine.operators.ranking import top_attributions
from zephyrine.operators.reporting import (
    advice_table,
    alerts,
    category_columns,
    explain,
    pollutant_unpivot,
    weather_snapshot,
)
from zephyrine.registry.base import (
    CLIMATE_SQL,
    READING_ORDER,
    day_text,
    on_readings,
    query,
    r6,
    readings,
    sql_aqi,
    sql_category,
    sql_change,
    sql_day,
    sql_r,
    sql_text,
    text,
)
from zephyrine.sources.tables import latest_rows

ID = "reading_id"

@query(
    "j1_climatology_join",
    f"WITH {CLIMATE_SQL} SELECT o_orderkey, t AS temperature, h AS humidity, w AS wind_speed, p AS pressure "
    "FROM orders JOIN clim ON clim.m = month(o_orderdate)",
)
def _climatology(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    return climatology_join(orders, "o_orderdate").drop("o_orderdate")


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from five days before the first reading to the last one."""
    days = F.to_date("ts")
    bounds = readings(spark, sf_dir).agg(
        F.date_sub(F.min(days), 5).alias("first_day"), F.max(days).alias("last_day")
    )
    return days_between(spark, bounds)


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with a reading of station 8 count as done."""
    return readings(spark, sf_dir).filter("station_id = 8").select(F.to_date("ts").alias("day"))


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements that leave every seventh day without a valid value."""
    usable = F.dayofmonth("ts") % 7 != 0
    return readings(spark, sf_dir).select(
        F.to_date("ts").alias("day"), F.when(usable, F.col("pm25")).otherwise(F.lit(-1.0)).alias("value")
    )


SPINE_SQL = """spine AS (SELECT CAST(unnest(generate_series(min(ts)::DATE - INTERVAL 5 DAY,
    max(ts)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM readings),
done AS (SELECT DISTINCT ts::DATE AS day FROM readings WHERE station_id = 8),
valid AS (SELECT ts::DATE AS day, count(*) AS n FROM readings WHERE day(ts) % 7 <> 0 AND pm25 >= 0 GROUP BY 1),
status AS (SELECT day, CASE WHEN day IN (SELECT day FROM done) THEN 'skipped'
    WHEN n IS NULL THEN 'failed' ELSE 'pushed' END AS status, coalesce(n, 0) AS measurements
  FROM spine LEFT JOIN valid USING (day))"""


@query(
    "j2_pending_dates",
    on_readings(f"SELECT {sql_day('day')} AS day FROM spine WHERE day NOT IN (SELECT day FROM done)", SPINE_SQL),
)
def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pending_dates(spine(spark, sf_dir), processed(spark, sf_dir))
    return rows.select(day_text("day").alias("day"))


HOURLY_SOURCES_SQL = """air AS (SELECT city, date_trunc('hour', ts) AS h, aqi, pm25 FROM readings
  WHERE reading_id % 2 = 0
  QUALIFY row_number() OVER (PARTITION BY city, date_trunc('hour', ts) ORDER BY ts DESC, reading_id DESC) = 1),
weather AS (SELECT city, date_trunc('hour', ts) AS h, temperature, humidity FROM readings
  WHERE reading_id % 2 = 1
  QUALIFY row_number() OVER (PARTITION BY city, date_trunc('hour', ts) ORDER BY ts DESC, reading_id DESC) = 1)"""


@query(
    "j3_combine_sources",
    on_readings(
        f"SELECT city, {sql_text('h')} AS ts, aqi, pm25, temperature, humidity FROM air JOIN weather USING (city, h)",
        HOURLY_SOURCES_SQL,
    ),
)
def _combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir)
    envelope = ["city", F.col("ts").alias("fetched_at"), F.col(ID).alias("ingest_seq")]
    aqi = rows.filter(F.col(ID) % 2 == 0).select(*envelope, "aqi", "pm25")
    weather = rows.filter(F.col(ID) % 2 == 1).select(*envelope, "temperature", "humidity")
    joined = combine_sources(aqi, weather)
    return joined.select("city", text("timestamp").alias("ts"), "aqi", "pm25", "temperature", "humidity")


@query(
    "j4_dates_without_data",
    on_readings(f"SELECT {sql_day('day')} AS day FROM spine WHERE day NOT IN (SELECT day FROM valid)", SPINE_SQL),
)
def _without_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dates_without_data(spine(spark, sf_dir), measurements(spark, sf_dir))
    return rows.select(day_text("day").alias("day"))


@query(
    "j4_day_status",
    on_readings(f"SELECT {sql_day('day')} AS day, status, measurements FROM status", SPINE_SQL),
)
def _day_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = day_status(spine(spark, sf_dir), processed(spark, sf_dir), measurements(spark, sf_dir))
    return rows.withColumn("day", day_text("day"))


@query(
    "a13_backfill_summary",
    on_readings(
        "SELECT count(*) AS total, count(*) FILTER (WHERE status = 'pushed') AS pushed, "
        "count(*) FILTER (WHERE status = 'skipped') AS skipped, "
        "count(*) FILTER (WHERE status = 'failed') AS failed FROM status",
        SPINE_SQL,
    ),
)
def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill_summary(
        day_status(spine(spark, sf_dir), processed(spark, sf_dir), measurements(spark, sf_dir))
    )


@query("j5_breakpoint_join", on_readings(f"SELECT reading_id, {sql_aqi('pm25')} AS aqi FROM readings"))
def _breakpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breakpoint_join(readings(spark, sf_dir).select(ID, "pm25")).select(ID, "aqi")


@query(
    "j5_segment_join",
    "SELECT l_orderkey, l_linenumber, value, c_low, price FROM (SELECT l_orderkey, l_linenumber, "
    "l_orderkey + l_linenumber * 0.125::DOUBLE AS value FROM lineitem) LEFT JOIN (SELECT CAST(o_orderkey AS DOUBLE) "
    "AS c_low, o_orderkey + 0.5::DOUBLE AS c_high, o_totalprice AS price FROM orders) ON value BETWEEN c_low AND c_high",
)
def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment per order, and the one each line's number lies in, if any."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    segments = orders.select(
        F.col("o_orderkey").cast("double").alias("c_low"),
        (F.col("o_orderkey") + F.lit(0.5)).alias("c_high"),
        F.col("o_totalprice").alias("price"),
    )
    value = F.col("l_orderkey") + F.col("l_linenumber") * F.lit(0.125)
    rows = lines.select("l_orderkey", "l_linenumber", value.alias("value"))
    return segment_join(rows, segments, "value").drop("c_high")


@query(
    "j6_category_join",
    on_readings(
        f"SELECT city, {sql_category('aqi')} AS category, count(*) AS readings, max(aqi) AS max_aqi "
        "FROM readings GROUP BY ALL"
    ),
)
def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).select("city", "aqi", category_columns(F.col("aqi"))[0])
    return rows.groupBy("city", "category").agg(F.count("*").alias("readings"), F.max("aqi").alias("max_aqi"))


@query(
    "j7_previous_reading",
    on_readings(
        "SELECT reading_id, previous_aqi, aqi_change_rate FROM (SELECT reading_id, previous_aqi, "
        f"{sql_change('aqi', 'previous_aqi')} AS aqi_change_rate FROM (SELECT reading_id, aqi, "
        "lag(aqi) OVER (PARTITION BY city ORDER BY ts, reading_id) AS previous_aqi FROM readings)) "
        "WHERE reading_id % 10 = 3"
    ),
)
def _previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth reading arrives late and is placed into the history of the others."""
    rows = readings(spark, sf_dir)
    late = F.col(ID) % 10 == 3
    placed = previous_reading(
        rows.filter(~late), rows.filter(late), order=READING_ORDER, block_rows=BLOCK_ROWS
    )
    return placed.select(ID, "previous_aqi", "aqi_change_rate")


@query(
    "so4_processed_days_except",
    on_readings(
        f"SELECT {sql_day('day')} AS day FROM (SELECT DISTINCT ts::DATE AS day FROM readings "
        "EXCEPT SELECT DISTINCT ts::DATE FROM readings WHERE station_id = 8)"
    ),
)
def _except(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = readings(spark, sf_dir).select(F.to_date("ts").alias("day")).distinct()
    return pending_dates(seen, processed(spark, sf_dir)).select(day_text("day").alias("day"))


LATEST_SQL = """latest AS (SELECT * FROM readings
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY ts DESC, reading_id DESC) = 1)"""


def latest_by_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rows(readings(spark, sf_dir), ["station_id"], READING_ORDER)


@query(
    "s23_pollutant_unpivot",
    on_readings(
        "SELECT station_id, 'PM2.5' AS pollutant, pm25 AS value FROM latest WHERE pm25 IS NOT NULL "
        "UNION ALL SELECT station_id, 'PM10', pm10 FROM latest WHERE pm10 IS NOT NULL "
        "UNION ALL SELECT station_id, 'NO2', no2 FROM latest WHERE no2 IS NOT NULL",
        LATEST_SQL,
    ),
)
def _pollutants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pollutant_unpivot(latest_by_station(spark, sf_dir), ["station_id"])


@query(
    "s24_weather_snapshot",
    on_readings(
        "SELECT station_id, 'Temperature' AS metric, coalesce(CAST(temperature AS VARCHAR), 'N/A') || '°C' AS reading "
        "FROM latest UNION ALL SELECT station_id, 'Humidity', coalesce(CAST(humidity AS VARCHAR), 'N/A') || '%' "
        "FROM latest UNION ALL SELECT station_id, 'Wind Speed', coalesce(CAST(wind_speed AS VARCHAR), 'N/A') || ' m/s' "
        "FROM latest UNION ALL SELECT station_id, 'Pressure', coalesce(CAST(pressure AS VARCHAR), 'N/A') || ' hPa' "
        "FROM latest",
        LATEST_SQL,
    ),
)
def _weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_snapshot(latest_by_station(spark, sf_dir), ["station_id"])


# Fixed linear contributions, so that the ranking has an exact twin.
CONTRIBUTION_WEIGHTS = {"temperature": 0.5, "humidity": -0.25, "pressure": 0.125, "wind_speed": 2.0, "pm10": 0.0625}


@query(
    "t5_s25_top_attributions",
    on_readings(
        "SELECT station_id, feature, rank, contribution, abs(contribution) AS abs_value, "
        "CASE WHEN contribution > 0 THEN 'Increases AQI' ELSE 'Decreases AQI' END AS direction, "
        "feature || ' is ' || CASE WHEN contribution > 0 THEN 'increasing' ELSE 'decreasing' END || "
        "' the predicted AQI by ' || printf('%.1f', round_even(abs(contribution), 1)) || ' points' AS sentence "
        "FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY abs(contribution) DESC, feature) AS rank "
        "FROM ("
        + " UNION ALL ".join(
            f"SELECT station_id, '{c}' AS feature, {sql_r(f'coalesce({c}, 0) * {w}::DOUBLE')} AS contribution FROM latest"
            for c, w in CONTRIBUTION_WEIGHTS.items()
        )
        + ")) WHERE rank <= 3",
        LATEST_SQL,
    ),
)
def _attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = [
        F.struct(F.lit(c).alias("feature"), r6(F.coalesce(F.col(c), F.lit(0.0)) * F.lit(w)).alias("contribution"))
        for c, w in CONTRIBUTION_WEIGHTS.items()
    ]
    long = latest_by_station(spark, sf_dir).select("station_id", F.inline(F.array(*cells)))
    return explain(top_attributions(long, 3, ["station_id"]))


MAX_SQL = """peak AS (SELECT city, date_trunc('day', ts) AS day, max(aqi) AS max_aqi FROM readings GROUP BY ALL)"""


def daily_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.date_trunc("day", F.col("ts")).alias("day")
    return readings(spark, sf_dir).groupBy("city", days).agg(F.max("aqi").alias("max_aqi"))


@query(
    "s3_daily_peak_alerts",
    on_readings(
        f"SELECT city, {sql_day('day')} AS day, max_aqi, CASE WHEN max_aqi <= 50 THEN 'good' "
        "WHEN max_aqi <= 100 THEN 'moderate' WHEN max_aqi <= 150 THEN 'unhealthy_sensitive' "
        "WHEN max_aqi <= 200 THEN 'unhealthy' WHEN max_aqi <= 300 THEN 'very_unhealthy' ELSE 'hazardous' END AS level "
        "FROM peak",
        MAX_SQL,
    ),
)
def _peak_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alerts(daily_peaks(spark, sf_dir), ["city", "day"])
    return rows.select("city", day_text("day").alias("day"), "max_aqi", "level")


@query(
    "s4_advice_table",
    on_readings(
        "SELECT city, count(*) FILTER (WHERE max_aqi > 100) AS days_limited, count(*) AS days FROM peak GROUP BY city",
        MAX_SQL,
    ),
)
def _advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = advice_table(daily_peaks(spark, sf_dir), ["city", "day"]).filter(
        F.col("population") == "General Public"
    )
    limited = F.count_if(F.col("recommendation") == "Limit prolonged outdoor activity")
    return rows.groupBy("city").agg(limited.alias("days_limited"), F.count("*").alias("days"))
