"""Scans and sinks: payloads, history files, the feature table, predictions, bundles."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.registry.base import (
    READING_ORDER,
    daily,
    day_text,
    hourly,
    on_hourly,
    on_readings,
    query,
    r6,
    readings,
    sql_day,
    sql_r,
    sql_text,
    text,
    written,
)
from zephyrine.functions.calendar import floor_hour
from zephyrine.functions.numeric import half_even
from zephyrine.operators.learning import fit_medians, fit_ridge, predict
from zephyrine.operators.series import add_daily_lag_features
from zephyrine.session import scratch_path
from zephyrine.sources.bundle import best_bundle_path, load_model_bundle, save_model_bundle
from zephyrine.sources.history import scan_history_csv, scan_named_history_csv
from zephyrine.sources.payloads import (
    parse_aqi_payloads,
    parse_weather_payloads,
    read_payload_lines,
    scan_aqi_payloads,
    scan_measurement_payloads,
    scan_weather_payloads,
)
from zephyrine.sources.store import (
    load_processed_dates,
    merge_batches,
    save_processed_dates,
    upsert,
    upsert_predictions,
    write_predictions_json,
)
from zephyrine.sources.tables import (
    latest_rows,
    previous_aqi,
    read_feature_table,
    read_with_fallback,
)
from zephyrine.schema import AQI_PAYLOAD_SCHEMA, WEATHER_PAYLOAD_SCHEMA


def envelope() -> list:
    return [F.col("city"), F.col("ts").alias("fetched_at"), F.col("reading_id").alias("ingest_seq")]


def aqi_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as AQI payloads; every 17th one reports an error."""
    iaqi = F.struct(
        *[F.when(F.col(p).isNotNull(), F.struct(F.col(p).alias("v"))).alias(p) for p in ("pm25", "pm10", "no2")]
    )
    return readings(spark, sf_dir).select(
        *envelope(),
        F.when(F.col("reading_id") % 17 == 0, "error").otherwise("ok").alias("status"),
        F.struct(F.col("aqi"), iaqi.alias("iaqi")).alias("data"),
    )


def weather_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as weather payloads; some lack a description, the wind speed or its direction."""
    number = F.col("reading_id")
    described = F.array(F.struct(F.col("city").alias("description")))
    nothing = F.slice(described, 1, 0)
    return readings(spark, sf_dir).select(
        *envelope(),
        F.struct(F.col("temperature").alias("temp"), "humidity", "pressure").alias("main"),
        F.struct(
            F.when(number % 19 != 0, F.col("wind_speed")).alias("speed"),
            F.when(number % 3 != 0, (number % 360).cast("double")).alias("deg"),
        ).alias("wind"),
        F.when(number % 4 != 0, (number % 10000).cast("double")).alias("visibility"),
        F.when(number % 13 == 0, nothing).otherwise(described).alias("weather"),
    )


@query(
    "sc1_scan_aqi_payloads",
    on_readings(
        f"SELECT city, {sql_text('ts')} AS fetched_at, reading_id AS ingest_seq, aqi, pm25, pm10, "
        "no2, CAST(NULL AS DOUBLE) AS o3, CAST(NULL AS DOUBLE) AS so2, CAST(NULL AS DOUBLE) AS co "
        "FROM readings WHERE reading_id % 17 <> 0"
    ),
)
def _scan_aqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written(aqi_payloads(spark, sf_dir), "aqi-payloads", "json")
    return scan_aqi_payloads(spark, path).withColumn("fetched_at", text("fetched_at"))


@query(
    "sc1_rejected_aqi_payloads",
    on_readings(
        "SELECT reading_id AS ingest_seq, 'status is not ok' AS reject_reason "
        "FROM readings WHERE reading_id % 17 = 0"
    ),
)
def _rejected_aqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written(aqi_payloads(spark, sf_dir), "aqi-payloads", "json")
    _, rejected = parse_aqi_payloads(read_payload_lines(spark, path, AQI_PAYLOAD_SCHEMA))
    return rejected.select("ingest_seq", "reject_reason")


@query(
    "sc2_scan_weather_payloads",
    on_readings(
        "SELECT reading_id AS ingest_seq, city, temperature, humidity, pressure, wind_speed, "
        "CASE WHEN reading_id % 3 <> 0 THEN CAST(reading_id % 360 AS DOUBLE) END AS wind_direction, "
        "CASE WHEN reading_id % 4 <> 0 THEN CAST(reading_id % 10000 AS DOUBLE) END AS visibility, "
        "city AS weather_desc FROM readings "
        "WHERE reading_id % 19 <> 0 AND reading_id % 13 <> 0 AND humidity IS NOT NULL"
    ),
)
def _scan_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written(weather_payloads(spark, sf_dir), "weather-payloads", "json")
    return scan_weather_payloads(spark, path).drop("fetched_at")


@query(
    "sc2_rejected_weather_payloads",
    on_readings(
        "SELECT reject_reason, count(*) AS payloads FROM (SELECT CASE "
        "WHEN humidity IS NULL THEN 'missing humidity' "
        "WHEN reading_id % 19 = 0 THEN 'missing wind_speed' "
        "WHEN reading_id % 13 = 0 THEN 'missing weather_desc' END AS reject_reason FROM readings) "
        "WHERE reject_reason IS NOT NULL GROUP BY reject_reason"
    ),
)
def _rejected_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written(weather_payloads(spark, sf_dir), "weather-payloads", "json")
    _, rejected = parse_weather_payloads(read_payload_lines(spark, path, WEATHER_PAYLOAD_SCHEMA))
    return rejected.groupBy("reject_reason").agg(F.count("*").alias("payloads"))


@query(
    "sc3_scan_measurements",
    on_readings(
        f"SELECT {sql_day('ts')} AS day, reading_id AS ingest_seq, position, "
        "CASE position WHEN 0 THEN pm25 ELSE pm10 END AS value "
        "FROM readings CROSS JOIN (VALUES (0), (1)) AS slots(position)"
    ),
)
def _scan_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = readings(spark, sf_dir).select(
        *envelope(),
        F.to_date("ts").alias("date"),
        F.array(
            F.struct(F.col("pm25").alias("value")), F.struct(F.col("pm10").alias("value"))
        ).alias("results"),
    )
    path = written(payloads, "measurements", "json")
    rows = scan_measurement_payloads(spark, path)
    return rows.select(day_text("day").alias("day"), "ingest_seq", "position", "value")


def history_csv(spark: SparkSession, sf_dir: str) -> str:
    """Readings as a history file with blanks and non-numeric text."""
    number = F.col("reading_id")
    value = (
        F.when(number % 7 == 0, F.lit(""))
        .when(number % 11 == 0, F.lit("n/a"))
        .otherwise(F.col("pm25").cast("string"))
    )
    rows = readings(spark, sf_dir).select(
        F.date_format("ts", "yyyy/M/d").alias("date"), value.alias("pm25")
    )
    return written(rows, "history", "csv", header=True)


HISTORY_SQL = "FROM readings WHERE reading_id % 7 <> 0 AND reading_id % 11 <> 0"


@query(
    "sc4_scan_history_csv",
    on_readings(
        f"SELECT {sql_day('ts')} AS day, pm25, count(*) AS n {HISTORY_SQL} GROUP BY ALL"
    ),
)
def _scan_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_history_csv(spark, history_csv(spark, sf_dir))
    return rows.groupBy(day_text("timestamp").alias("day"), "pm25").agg(F.count("*").alias("n"))


@query(
    "sc5_scan_history_csv_fallback",
    on_readings(
        f"SELECT 'harbour' AS city, {sql_text('date_trunc(' + chr(39) + 'day' + chr(39) + ', ts)')} "
        f"AS ts, pm25, count(*) AS n {HISTORY_SQL} GROUP BY ALL"
    ),
)
def _scan_history_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_named_history_csv(spark, history_csv(spark, sf_dir), "harbour")
    return rows.groupBy("city", text("timestamp").alias("ts"), "pm25").agg(F.count("*").alias("n"))


def stored_hourly(spark: SparkSession, sf_dir: str) -> str:
    """The hourly readings as an ``event_date``-partitioned table."""
    path = scratch_path(spark, "features")
    rows = hourly(spark, sf_dir, ["aqi", "humidity"]).withColumn("ingest_seq", F.lit(1).cast("bigint"))
    upsert(spark, path, rows)
    return path


@query(
    "sc6_read_feature_table",
    on_hourly(
        f"SELECT city, {sql_text('\"timestamp\"')} AS ts, aqi, humidity FROM hourly "
        "WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'"
    ),
)
def _read_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_feature_table(
        spark,
        stored_hourly(spark, sf_dir),
        ["city", "timestamp", "aqi", "humidity"],
        since=dt.date(2024, 1, 10),
        until=dt.date(2024, 1, 19),
    )
    return rows.select("city", text("timestamp").alias("ts"), "aqi", "humidity")


@query(
    "sc7_read_with_fallback",
    on_readings("SELECT 'fallback' AS source, city, count(*) AS n FROM readings GROUP BY city"),
)
def _fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, source = read_with_fallback(
        lambda: spark.read.parquet(os.path.join(sf_dir, "no-such-table.parquet")),
        lambda: readings(spark, sf_dir),
    )
    return rows.groupBy(F.lit(source).alias("source"), "city").agg(F.count("*").alias("n"))


@query(
    "sc8_latest_feature_row",
    on_readings(
        f"SELECT city, reading_id, station_id, {sql_text('ts')} AS ts, aqi, humidity, pm10 "
        "FROM readings QUALIFY row_number() OVER (PARTITION BY city "
        "ORDER BY ts DESC, reading_id DESC) = 1"
    ),
)
def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_rows(readings(spark, sf_dir), ["city"], READING_ORDER)
    return rows.select("city", "reading_id", "station_id", text("ts").alias("ts"), "aqi", "humidity", "pm10")


@query(
    "sc8_previous_aqi",
    on_readings(
        "SELECT city, arg_max(aqi, struct_pack(ts := ts, id := reading_id)) AS previous_aqi "
        "FROM readings GROUP BY city"
    ),
)
def _previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return previous_aqi(readings(spark, sf_dir), READING_ORDER)


UPSERT_SQL = on_readings(
    f"SELECT city, {sql_text('hour_ts')} AS ts, reading_id, aqi, ingest_seq FROM batches "
    "QUALIFY row_number() OVER (PARTITION BY city, hour_ts ORDER BY ingest_seq DESC) = 1",
    """batches AS (
  SELECT city, date_trunc('hour', ts) AS hour_ts, reading_id, aqi, reading_id AS ingest_seq
  FROM readings WHERE reading_id % 2 = 1
  UNION ALL
  SELECT city, date_trunc('hour', ts), reading_id, aqi + 10, reading_id + 1000000000
  FROM readings WHERE reading_id % 2 = 0)""",
)


@query("sk1_upsert", UPSERT_SQL)
def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "features")
    rows = readings(spark, sf_dir).select(
        "city", floor_hour(F.col("ts")).alias("timestamp"), "reading_id", "aqi"
    )
    odd = F.col("reading_id") % 2 == 1
    first = rows.filter(odd).withColumn("ingest_seq", F.col("reading_id"))
    second = rows.filter(~odd).withColumns(
        {"ingest_seq": F.col("reading_id") + 1_000_000_000, "aqi": F.col("aqi") + 10}
    )
    upsert(spark, path, first)
    upsert(spark, path, second)
    stored = upsert(spark, path, second)  # a repeated batch changes nothing
    return stored.select("city", text("timestamp").alias("ts"), "reading_id", "aqi", "ingest_seq")


@query(
    "so2_merge_batches",
    on_readings(
        f"SELECT city, {sql_text('hour_ts')} AS ts, reading_id, aqi FROM ("
        "SELECT city, date_trunc('hour', ts) AS hour_ts, reading_id, aqi FROM readings) "
        "QUALIFY row_number() OVER (PARTITION BY city, hour_ts ORDER BY reading_id DESC) = 1"
    ),
)
def _merge_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).select(
        "city", floor_hour(F.col("ts")).alias("timestamp"), "reading_id", "aqi"
    ).withColumn("ingest_seq", F.col("reading_id"))
    batches = [rows.filter(F.col("reading_id") % 3 == i) for i in range(3)]
    stored = upsert(spark, scratch_path(spark, "features"), merge_batches(batches))
    return stored.select("city", text("timestamp").alias("ts"), "reading_id", "aqi")


PREDICTION_ROWS_SQL = f"""latest AS (
  SELECT city, "timestamp", aqi FROM hourly
  QUALIFY row_number() OVER (PARTITION BY city ORDER BY "timestamp" DESC) = 1),
predictions AS (
  SELECT city, {sql_text('"timestamp"')} AS ts,
         {sql_r('aqi * 0.9::DOUBLE + 10', 2)} AS aqi_pred_24h,
         {sql_r('aqi * 0.8::DOUBLE + 20', 2)} AS aqi_pred_48h,
         {sql_r('aqi * 0.7::DOUBLE + 30', 2)} AS aqi_pred_72h FROM latest)"""


def simple_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_rows(hourly(spark, sf_dir, ["aqi"]).select("city", "timestamp", "aqi"))
    return latest.select(
        "city",
        "timestamp",
        *[
            half_even(F.col("aqi") * F.lit(w) + F.lit(b), 2).alias(f"aqi_pred_{h}h")
            for h, w, b in ((24, 0.9, 10.0), (48, 0.8, 20.0), (72, 0.7, 30.0))
        ],
    )


@query(
    "sk2_upsert_predictions",
    on_hourly(
        "SELECT city, ts, '2024-02-01 06:00:00' AS predicted_at, aqi_pred_24h, aqi_pred_48h, "
        "aqi_pred_72h FROM predictions",
        PREDICTION_ROWS_SQL,
    ),
)
def _upsert_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    rows = simple_predictions(spark, sf_dir)
    upsert_predictions(spark, path, rows, dt.datetime(2024, 2, 1, 5, tzinfo=dt.timezone.utc), 1)
    stored = upsert_predictions(
        spark, path, rows, dt.datetime(2024, 2, 1, 6, tzinfo=dt.timezone.utc), 2
    )
    return stored.select(
        "city",
        text("timestamp").alias("ts"),
        text("predicted_at").alias("predicted_at"),
        "aqi_pred_24h",
        "aqi_pred_48h",
        "aqi_pred_72h",
    )


@query(
    "sk3_predictions_json",
    on_hourly(
        "SELECT city, ts AS based_on_data_at, '2024-02-01 06:00:00' AS generated_at, "
        "aqi_pred_24h, aqi_pred_48h, aqi_pred_72h, '24,48,72' AS horizons_hours FROM predictions",
        PREDICTION_ROWS_SQL,
    ),
)
def _predictions_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "predictions-json")
    made = dt.datetime(2024, 2, 1, 6, tzinfo=dt.timezone.utc)
    write_predictions_json(simple_predictions(spark, sf_dir), path, made)
    values = ", ".join(f"aqi_pred_{h}h: DOUBLE" for h in (24, 48, 72))
    document = (
        "generated_at TIMESTAMP, based_on_data_at TIMESTAMP, "
        f"predictions STRUCT<{values}>, horizons_hours ARRAY<INT>"
    )
    lines = spark.read.schema("city STRING, document STRING").json(path)
    back = lines.select("city", F.from_json("document", document).alias("document")).select("city", "document.*")
    return back.select(
        "city",
        text("based_on_data_at").alias("based_on_data_at"),
        text("generated_at").alias("generated_at"),
        "predictions.*",
        F.array_join(F.col("horizons_hours").cast("array<string>"), ",").alias("horizons_hours"),
    )


@query(
    "sk4_processed_dates",
    on_readings(f"SELECT DISTINCT {sql_day('ts')} AS day FROM readings WHERE aqi > 20"),
)
def _processed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "processed")
    days = readings(spark, sf_dir).filter(F.col("aqi") > 20).select(F.to_date("ts").alias("day")).distinct()
    save_processed_dates(days, path)
    save_processed_dates(days, path)
    return load_processed_dates(spark, path).select(day_text("day").alias("day"))


BUNDLE_FEATURES = ["aqi_lag_1d", "aqi_rolling_mean_7d", "temperature", "humidity", "pm10", "no2"]


@query("sk5_model_bundle")
def _model_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored bundles, the better one loaded and used on every row."""
    inputs = ["aqi", "temperature", "humidity", "pm10", "no2"]
    rows = add_daily_lag_features(daily(spark, sf_dir, inputs), keys=["station_id"])
    medians = fit_medians(rows, BUNDLE_FEATURES)
    effective = [c for c in BUNDLE_FEATURES if c in medians]
    base = scratch_path(spark, "models")
    paths = []
    for i, alpha in enumerate((1.0, 1e6)):
        bundle = fit_ridge(rows, effective, "target_aqi_1d", medians, alpha)
        bundle.metrics = {"rmse": float(i)}
        paths.append(f"{base}/model-{i}")
        save_model_bundle(spark, bundle, paths[-1])
    best = load_model_bundle(spark, best_bundle_path(spark, paths))
    return predict(rows, best).select(
        "station_id", day_text("timestamp").alias("day"), r6("prediction").alias("prediction")
    )
