"""Scalar functions and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.functions.calendar import (
    date_spine,
    default_backfill_start,
    floor_hour,
    forecast_label,
    in_day,
    noon_stamp,
    parse_target_date,
    parse_timestamp_utc,
    season,
    time_features,
    year_month,
)
from zephyrine.functions.index import alert_level, aqi_category, health_advice, pm25_to_aqi
from zephyrine.functions.numeric import clip, coerce_double
from zephyrine.functions.weather import interaction_features
from zephyrine.operators.joins import climatology_join
from zephyrine.operators.projection import (
    align_columns,
    assemble_feature_rows,
    drop_all_missing_columns,
    feature_columns,
    intersect_columns,
)
from zephyrine.functions.numeric import cast_nullable_doubles
from zephyrine.operators.scoring import format_horizons
from zephyrine.registry.base import (
    CLIMATE_SQL,
    INTERACTION_SQL,
    daily,
    day_text,
    hourly,
    on_daily,
    on_hourly,
    on_readings,
    query,
    readings,
    sql_aqi,
    sql_calendar,
    sql_category,
    sql_change,
    sql_jitter,
    sql_r,
    sql_text,
    text,
)
from zephyrine.schema import CALENDAR_COLUMNS, CYCLIC_COLUMNS, FEATURE_TABLE_COLUMNS

ID = "reading_id"


@query("s1_pm25_to_aqi", on_readings(f"SELECT reading_id, pm25, {sql_aqi('pm25')} AS index_value FROM readings"))
def _pm25_to_aqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select(ID, "pm25", pm25_to_aqi(F.col("pm25")).alias("index_value"))


@query(
    "s1_pm25_to_aqi_truncated",
    on_readings(
        f"SELECT reading_id, {sql_aqi('cut')} AS index_value "
        "FROM (SELECT reading_id, floor(pm25 * 10) / 10 AS cut FROM readings)"
    ),
)
def _pm25_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = pm25_to_aqi(F.col("pm25"), gap_policy="truncate")
    return readings(spark, sf_dir).select(ID, value.alias("index_value"))


CATEGORY_SQL = f"""SELECT reading_id, aqi, label, CASE label
  WHEN 'Good' THEN 0 WHEN 'Moderate' THEN 51 WHEN 'Unhealthy (SG)' THEN 101
  WHEN 'Unhealthy' THEN 151 WHEN 'Very Unhealthy' THEN 201 ELSE 301 END AS band_min,
  CASE label WHEN 'Good' THEN '#00E400' WHEN 'Moderate' THEN '#FFFF00'
  WHEN 'Unhealthy (SG)' THEN '#FF7E00' WHEN 'Unhealthy' THEN '#FF0000'
  WHEN 'Very Unhealthy' THEN '#8F3F97' ELSE '#7E0023' END AS color
FROM (SELECT reading_id, aqi, {sql_category('aqi')} AS label FROM readings)"""


@query("s2_aqi_category", on_readings(CATEGORY_SQL))
def _category(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = aqi_category(F.col("aqi"))
    return readings(spark, sf_dir).select(
        ID,
        "aqi",
        category.getField("label").alias("label"),
        category.getField("min").alias("band_min"),
        category.getField("color").alias("color"),
    )


ALERT_SQL = """SELECT reading_id, CASE WHEN aqi <= 50 THEN 'good' WHEN aqi <= 100 THEN 'moderate'
  WHEN aqi <= 150 THEN 'unhealthy_sensitive' WHEN aqi <= 200 THEN 'unhealthy'
  WHEN aqi <= 300 THEN 'very_unhealthy' ELSE 'hazardous' END AS level,
  CASE WHEN aqi <= 50 THEN 'Air quality is good for the next 3 days. Enjoy outdoor activities!'
  WHEN aqi <= 100 THEN 'Air quality is moderate. Unusually sensitive people should consider reducing prolonged outdoor exertion.'
  WHEN aqi <= 150 THEN 'Unhealthy for Sensitive Groups (AQI up to ' || shown || '). People with respiratory or heart conditions should limit outdoor activity.'
  WHEN aqi <= 200 THEN 'Unhealthy conditions expected (AQI up to ' || shown || '). Everyone should reduce prolonged outdoor exertion. Wear an N95 mask outdoors.'
  WHEN aqi <= 300 THEN 'Very Unhealthy (AQI up to ' || shown || '). Avoid all outdoor activity. Keep windows closed. Use air purifiers indoors.'
  ELSE 'HAZARDOUS conditions (AQI up to ' || shown || '). Stay indoors. This is a health emergency. Wear N95 mask if you must go out.' END AS message
FROM (SELECT reading_id, aqi, CAST(round_even(aqi, 0) AS BIGINT) AS shown FROM readings)"""


@query("s3_alert_level", on_readings(ALERT_SQL))
def _alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    alert = alert_level(F.col("aqi"))
    return readings(spark, sf_dir).select(
        ID, alert.getField("level").alias("level"), alert.getField("message").alias("message")
    )


@query(
    "s4_health_advice",
    on_readings(
        "SELECT reading_id, population, CASE WHEN aqi > 100 THEN high ELSE low END AS recommendation "
        "FROM readings CROSS JOIN (VALUES "
        "('General Public', 'Limit prolonged outdoor activity', 'Normal activity OK'), "
        "('Children & Elderly', 'Avoid outdoor play', 'Normal activity OK'), "
        "('Asthma / Heart Conditions', 'Stay indoors, use inhaler as needed', 'Monitor symptoms'), "
        "('Athletes / Outdoor Workers', 'Reschedule outdoor training', 'Normal activity OK')"
        ") AS advice(population, high, low)"
    ),
)
def _advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select(ID, F.inline(health_advice(F.col("aqi"))))


@query(
    "s5_calendar_parts",
    on_readings(
        "SELECT reading_id, hour(ts) AS hour, day(ts) AS day, month(ts) AS month, "
        "isodow(ts) - 1 AS weekday FROM readings"
    ),
)
def _calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = time_features(F.col("ts"))
    return readings(spark, sf_dir).select(
        ID, *[parts[c].alias(c) for c in ("hour", "day", "month", "weekday")]
    )


@query(
    "s6_season",
    "SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 0 "
    "WHEN month(o_orderdate) <= 5 THEN 1 WHEN month(o_orderdate) <= 8 THEN 2 ELSE 3 END AS season "
    "FROM orders",
)
def _season(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select("o_orderkey", season(F.month("o_orderdate")).alias("season"))


@query(
    "s7_is_weekend",
    "SELECT o_orderkey, CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM orders",
)
def _weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select("o_orderkey", time_features(F.col("o_orderdate"))["is_weekend"].alias("is_weekend"))


@query("s8_cyclic_features", on_readings(f"SELECT reading_id, {sql_calendar('ts')} FROM readings"))
def _cyclic(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = time_features(F.col("ts"))
    return readings(spark, sf_dir).select(
        ID, *[parts[c].alias(c) for c in CALENDAR_COLUMNS + CYCLIC_COLUMNS]
    )


for _name, _column in (
    ("s9_temp_humidity_index", "temp_humidity_index"),
    ("s10_wind_dispersion", "wind_dispersion"),
    ("s11_atmospheric_stability", "atmospheric_stability"),
):

    @query(
        _name, on_readings(f"SELECT reading_id, {_column} FROM (SELECT reading_id, {INTERACTION_SQL} FROM readings)")
    )
    def _interaction(spark: SparkSession, sf_dir: str, column: str = _column) -> DataFrame:
        return readings(spark, sf_dir).select(ID, interaction_features()[column].alias(column))


@query(
    "s12_floor_hour",
    on_readings(f"SELECT reading_id, {sql_text("date_trunc('hour', ts)")} AS hour_ts FROM readings"),
)
def _floor_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select(ID, text(floor_hour(F.col("ts"))).alias("hour_ts"))


@query(
    "s13_day_bounds",
    on_readings(
        "SELECT reading_id, aqi FROM readings WHERE ts >= TIMESTAMP '2024-01-12 00:00:00' "
        "AND ts < TIMESTAMP '2024-01-13 00:00:00'"
    ),
)
def _day_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date(F.lit("2024-01-12"))
    return readings(spark, sf_dir).filter(in_day(F.col("ts"), day)).select(ID, "aqi")


@query(
    "s14_noon_stamp",
    on_readings(
        f"SELECT reading_id, {sql_text("date_trunc('day', ts) + INTERVAL 12 HOUR")} AS noon FROM readings"
    ),
)
def _noon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select(ID, text(noon_stamp(F.col("ts"))).alias("noon"))


@query(
    "s15_parse_target_date",
    on_readings(
        f"SELECT reading_id, CASE WHEN reading_id % 2 = 0 THEN {sql_text("date_trunc('day', ts)")} "
        f"ELSE {sql_text('ts')} END AS parsed FROM readings"
    ),
)
def _target_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    written_as = F.when(F.col(ID) % 2 == 0, day_text("ts")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    )
    return readings(spark, sf_dir).select(ID, text(parse_target_date(written_as)).alias("parsed"))


@query(
    "s16_parse_timestamp_utc",
    on_readings(
        "SELECT reading_id, CASE WHEN reading_id % 5 = 0 THEN NULL "
        f"WHEN reading_id % 2 = 0 THEN {sql_text('ts')} "
        f"ELSE {sql_text('ts - INTERVAL 2 HOUR')} END AS parsed FROM readings"
    ),
)
def _timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col(ID)
    raw = (
        F.when(number % 5 == 0, F.lit("not a time"))
        .when(number % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
    )
    return readings(spark, sf_dir).select(ID, text(parse_timestamp_utc(raw)).alias("parsed"))


@query(
    "s17_coerce_double",
    on_readings(
        "SELECT reading_id, CASE WHEN reading_id % 7 = 0 OR reading_id % 11 = 0 THEN NULL "
        "ELSE pm25 END AS value FROM readings"
    ),
)
def _coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col(ID)
    raw = (
        F.when(number % 7 == 0, F.lit("-"))
        .when(number % 11 == 0, F.lit("NaN"))
        .otherwise(F.concat(F.lit(" "), F.col("pm25").cast("string")))
    )
    return readings(spark, sf_dir).select(ID, coerce_double(raw).alias("value"))


@query(
    "s18_year_month",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders",
)
def _year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select("o_orderkey", year_month(F.col("o_orderdate")).alias("year_month"))


@query(
    "s19_clip",
    on_readings(
        "SELECT reading_id, CASE WHEN pm10 IS NULL THEN NULL ELSE greatest(40.0::DOUBLE, "
        "least(150.0::DOUBLE, pm10)) END AS pm10_clipped, greatest(0.0::DOUBLE, least(500.0::DOUBLE, "
        "aqi * 3 - 100)) AS aqi_clipped FROM readings"
    ),
)
def _clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select(
        ID,
        clip(F.col("pm10"), 40, 150).alias("pm10_clipped"),
        clip(F.col("aqi") * 3 - 100, 0, 500).alias("aqi_clipped"),
    )


@query(
    "s20_date_spine",
    on_readings(
        "SELECT city, strftime(unnest(generate_series(last_day - INTERVAL 90 DAY, last_day, "
        "INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM (SELECT city, date_trunc('day', max(ts)) AS last_day "
        "FROM readings GROUP BY city)"
    ),
)
def _date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = readings(spark, sf_dir).groupBy("city").agg(F.max("ts").alias("last"))
    spine = date_spine(default_backfill_start(F.col("last"), 90), F.col("last"))
    return last.select("city", F.explode(spine).alias("day")).select("city", day_text("day").alias("day"))


@query(
    "s21_forecast_label",
    on_readings(
        "SELECT reading_id, step, strftime(ts + to_days(CAST(step AS INTEGER)), '%A, %b %d') AS label "
        "FROM readings CROSS JOIN (VALUES (1), (2), (3)) AS steps(step)"
    ),
)
def _forecast_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = F.explode(F.sequence(F.lit(1), F.lit(3))).alias("step")
    return readings(spark, sf_dir).select(ID, "ts", steps).select(
        ID, "step", forecast_label(F.col("ts"), F.col("step")).alias("label")
    )


@query(
    "s22_format_horizons",
    on_readings(
        f"SELECT reading_id, {sql_r('aqi / 3', 2)} AS aqi_pred_24h, {sql_r('aqi / 7', 2)} AS aqi_pred_48h, "
        f"{sql_r('aqi / 9', 2)} AS aqi_pred_72h FROM readings"
    ),
)
def _format_horizons(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = F.array(*[F.col("aqi") / F.lit(float(d)) for d in (3, 7, 9)])
    return readings(spark, sf_dir).select(ID, *format_horizons(predictions))


JITTER_SQL = on_readings(
    f"SELECT reading_id, {sql_jitter('CAST(reading_id AS VARCHAR)')} "
    "FROM (SELECT r.reading_id, c.t, c.h, c.w, c.p FROM readings r JOIN clim c ON c.m = month(r.ts))",
    CLIMATE_SQL,
)


@query("s26_seeded_weather", JITTER_SQL)
def _seeded_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["temperature", "humidity", "pressure", "wind_speed", "wind_direction", "visibility"]
    return climatology_join(readings(spark, sf_dir), "ts", F.col(ID)).select(ID, *columns)


CHANGE_SQL = sql_change("aqi", 'lag(aqi) OVER (PARTITION BY city ORDER BY "timestamp")')
PF1_SQL = on_hourly(
    f"""SELECT city, {sql_text('"timestamp"')} AS ts, aqi, pm25, pm10, no2,
  CAST(NULL AS DOUBLE) AS o3, CAST(NULL AS DOUBLE) AS so2, CAST(NULL AS DOUBLE) AS co,
  temperature, humidity, pressure, wind_speed, CAST(NULL AS DOUBLE) AS wind_direction,
  CAST(NULL AS DOUBLE) AS visibility, {sql_calendar('"timestamp"')}, {INTERACTION_SQL},
  {CHANGE_SQL} AS aqi_change_rate FROM hourly"""
)


@query("pf1_assemble_feature_row", PF1_SQL)
def _assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assemble_feature_rows(hourly(spark, sf_dir))
    rest = [c for c in FEATURE_TABLE_COLUMNS if c not in ("city", "timestamp")]
    return rows.select("city", text("timestamp").alias("ts"), *rest)


@query(
    "pf2_cast_nullable_doubles",
    on_readings(
        "SELECT reading_id, CASE WHEN reading_id % 3 = 0 OR reading_id % 5 = 0 THEN NULL "
        "ELSE CAST(reading_id % 200 AS DOUBLE) END AS pm10, CAST(NULL AS DOUBLE) AS no2, "
        "CAST(reading_id % 9 AS DOUBLE) AS o3 FROM readings"
    ),
)
def _nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    nan = F.lit(float("nan"))
    raw = readings(spark, sf_dir).select(
        ID,
        F.when(F.col(ID) % 5 == 0, nan).otherwise(F.col("pm10")).alias("pm10"),
        F.lit(None).alias("no2"),
        (F.col(ID) % 9).cast("int").alias("o3"),
    )
    return cast_nullable_doubles(raw, ["pm10", "no2", "o3", "so2"])


@query(
    "pf3_align_columns",
    on_readings(
        "SELECT reading_id, humidity, CAST(NULL AS DOUBLE) AS dew_point, aqi FROM readings"
    ),
)
def _align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_columns(readings(spark, sf_dir), ["humidity", "dew_point", "aqi"], keep=[ID])


@query(
    "pf4_pf5_model_input_columns",
    on_daily("SELECT reading_id, humidity, pm25, pm10 FROM daily"),
)
def _model_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = daily(spark, sf_dir, ["aqi", "humidity", "pm25", "pm10"])
    wanted = ["humidity", "city", "aqi", "dew_point", "pm25", "pm10"]
    return rows.select(ID, *[c for c in intersect_columns(wanted, rows) if c in feature_columns(rows)])


@query(
    "pf14_drop_all_missing_columns",
    on_readings("SELECT reading_id, pm25, pm10 FROM readings"),
)
def _drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_all_missing_columns(
        readings(spark, sf_dir).select(ID, "pm25", "pm10", "no2"), ["pm25", "pm10", "no2"]
    )
