"""Lags, rolling windows, change rates and the latest inference rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zephyrine.operators.blocks import BLOCK_ROWS
from zephyrine.operators.series import (
    add_change_rate,
    add_daily_lag_features,
    add_hourly_lag_features,
    calendar_lag,
    daily_lags,
    hourly_lags,
    hourly_rolling,
    latest_inference_rows,
    optional_hourly_lags,
    rolling_means,
    rolling_std,
    targets,
    weather_rolling,
)
from zephyrine.registry.base import (
    READING_ORDER,
    daily,
    day_text,
    hourly,
    on_daily,
    on_hourly,
    on_readings,
    query,
    readings,
    rounded,
    sql_change,
    sql_day,
    sql_rounded,
    sql_text,
    text,
)
from zephyrine.sources.store import latest_per_key

STATION = ["station_id"]
DAILY_INPUTS = ["aqi", "temperature", "humidity"]
HOURLY_INPUTS = ["aqi", "pm25", "wind_speed"]

DAY_WINDOW = 'OVER (PARTITION BY station_id ORDER BY "timestamp"'


def _prior(statistic: str, rows: int, window: str = DAY_WINDOW) -> str:
    return f"{statistic} {window} ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING)"


DAILY_COLUMNS_SQL = {
    **{f"aqi_lag_{k}d": f"lag(aqi, {k}) {DAY_WINDOW})" for k in (1, 2, 3, 7, 14)},
    **{f"aqi_rolling_mean_{n}d": _prior("avg(aqi)", n) for n in (3, 7, 14)},
    "aqi_rolling_std_7d": f"coalesce({_prior('stddev_samp(aqi)', 7)}, 0)",
    "temp_rolling_mean_3d": _prior("avg(temperature)", 3),
    "humidity_rolling_mean_3d": _prior("avg(humidity)", 3),
    **{f"target_aqi_{k}d": f"lead(aqi, {k}) {DAY_WINDOW})" for k in (1, 2, 3)},
}


def daily_cte(columns: dict[str, str]) -> str:
    listed = ", ".join(f"{v} AS {k}" for k, v in columns.items())
    return f'lagged AS (SELECT station_id, "timestamp", reading_id, aqi, {listed} FROM daily)'


def daily_sql(names: list[str], where: str = "") -> str:
    columns = {k: DAILY_COLUMNS_SQL[k] for k in names}
    return on_daily(
        f"SELECT station_id, {sql_day('\"timestamp\"')} AS day, {sql_rounded(names)} FROM lagged {where}",
        daily_cte(columns),
    )


def _station_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return rounded(df, ["station_id", day_text("timestamp").alias("day")], columns)


def _daily_window() -> Window:
    return Window.partitionBy("station_id").orderBy("timestamp")


for _name, _columns, _build in (
    ("w1_daily_lags", [f"aqi_lag_{k}d" for k in (1, 2, 3, 7, 14)], daily_lags),
    ("w2_rolling_means", [f"aqi_rolling_mean_{n}d" for n in (3, 7, 14)], rolling_means),
    ("w3_rolling_std", ["aqi_rolling_std_7d"], rolling_std),
    ("w4_weather_rolling", ["temp_rolling_mean_3d", "humidity_rolling_mean_3d"], weather_rolling),
    ("w5_targets", [f"target_aqi_{k}d" for k in (1, 2, 3)], targets),
):

    @query(_name, daily_sql(_columns))
    def _daily_part(
        spark: SparkSession, sf_dir: str, columns: list = _columns, build=_build
    ) -> DataFrame:
        return _station_rows(daily(spark, sf_dir, DAILY_INPUTS).withColumns(build(_daily_window())), columns)


ALL_DAILY = list(DAILY_COLUMNS_SQL)
COMPLETE = (
    "WHERE aqi_lag_1d IS NOT NULL AND aqi_rolling_mean_7d IS NOT NULL AND target_aqi_1d IS NOT NULL"
)


@query("w6_daily_lag_features", daily_sql(ALL_DAILY, COMPLETE))
def daily_lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: latest reading per station-day, then all daily features."""
    return _station_rows(add_daily_lag_features(daily(spark, sf_dir, DAILY_INPUTS), keys=STATION), ALL_DAILY)


@query("w6_daily_lag_features_no_drop", daily_sql(ALL_DAILY))
def _no_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_daily_lag_features(daily(spark, sf_dir, DAILY_INPUTS), keys=STATION, drop=False)
    return _station_rows(rows, ALL_DAILY)


LOOKBACK_7 = [c for c in ALL_DAILY if c != "aqi_lag_14d"]


@query("w6_daily_lag_features_lookback_7", daily_sql(LOOKBACK_7, COMPLETE))
def _lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_daily_lag_features(daily(spark, sf_dir, DAILY_INPUTS), lookback_days=7, keys=STATION)
    return _station_rows(rows, [c for c in ALL_DAILY if c in rows.columns])


READING_WINDOW = "OVER (PARTITION BY city ORDER BY ts, reading_id"


@query(
    "w6_reading_lag_features_blocked",
    on_readings(
        "SELECT reading_id, " + sql_rounded(ALL_DAILY) + " FROM (SELECT reading_id, "
        + ", ".join(f"{v.replace(DAY_WINDOW, READING_WINDOW)} AS {k}" for k, v in DAILY_COLUMNS_SQL.items())
        + f" FROM readings) {COMPLETE}"
    ),
)
def _blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row lags over raw readings: a few very long series, cut into blocks with halos."""
    rows = readings(spark, sf_dir).select(
        "city", *READING_ORDER, F.col("ts").alias("timestamp"), *DAILY_INPUTS
    )
    lagged = add_daily_lag_features(rows, order=READING_ORDER, block_rows=10_000)
    return rounded(lagged, ["reading_id"], ALL_DAILY)


HOUR_WINDOW = 'OVER (PARTITION BY city ORDER BY "timestamp"'


def _full(statistic: str, rows: int, window: str) -> str:
    count = _prior("count(aqi)", rows, window)
    return f"CASE WHEN {count} = {rows} THEN {_prior(statistic, rows, window)} END"


def hourly_columns_sql(window: str) -> dict[str, str]:
    return {
        **{f"aqi_lag_{k}h": f"lag(aqi, {k}) {window})" for k in (1, 6, 24, 48, 72)},
        **{f"aqi_rolling_mean_{n}h": _full("avg(aqi)", n, window) for n in (6, 24, 168)},
        "aqi_rolling_std_24h": _full("stddev_samp(aqi)", 24, window),
        **{f"pm25_lag_{k}h": f"lag(pm25, {k}) {window})" for k in (1, 24)},
        "wind_lag_1h": f"lag(wind_speed, 1) {window})",
    }


HOURLY_COLUMNS_SQL = hourly_columns_sql(HOUR_WINDOW)
ALL_HOURLY = list(HOURLY_COLUMNS_SQL)


def hourly_sql(names: list[str], where: str = "") -> str:
    listed = ", ".join(f"{HOURLY_COLUMNS_SQL[k]} AS {k}" for k in names)
    return on_hourly(
        f"SELECT city, {sql_text('\"timestamp\"')} AS ts, {sql_rounded(names)} FROM lagged {where}",
        f'lagged AS (SELECT city, "timestamp", {listed} FROM hourly)',
    )


def _city_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return rounded(df, ["city", text("timestamp").alias("ts")], columns)


def _hourly_window() -> Window:
    return Window.partitionBy("city").orderBy("timestamp")


for _name, _columns, _build in (
    ("w7_hourly_lags", [f"aqi_lag_{k}h" for k in (1, 6, 24, 48, 72)], hourly_lags),
    (
        "w8_w9_hourly_rolling",
        [*[f"aqi_rolling_mean_{n}h" for n in (6, 24, 168)], "aqi_rolling_std_24h"],
        hourly_rolling,
    ),
    (
        "w10_optional_lags",
        ["pm25_lag_1h", "pm25_lag_24h", "wind_lag_1h"],
        lambda w: optional_hourly_lags(w, ["pm25", "wind_speed"]),
    ),
):

    @query(_name, hourly_sql(_columns))
    def _hourly_part(
        spark: SparkSession, sf_dir: str, columns: list = _columns, build=_build
    ) -> DataFrame:
        return _city_rows(hourly(spark, sf_dir, HOURLY_INPUTS).withColumns(build(_hourly_window())), columns)


@query("w7_w10_hourly_lag_features", hourly_sql(ALL_HOURLY))
def hourly_lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _city_rows(add_hourly_lag_features(hourly(spark, sf_dir, HOURLY_INPUTS)), ALL_HOURLY)


@query(
    "w8_reading_lag_features_blocked",
    on_readings(
        f"SELECT reading_id, {sql_rounded(ALL_HOURLY)} FROM (SELECT reading_id, "
        + ", ".join(f"{v} AS {k}" for k, v in hourly_columns_sql(READING_WINDOW).items())
        + " FROM readings)"
    ),
)
def _hourly_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 168-row frames over raw readings in blocks smaller than one series."""
    rows = readings(spark, sf_dir).select("city", *READING_ORDER, *HOURLY_INPUTS)
    lagged = add_hourly_lag_features(rows, order=READING_ORDER, block_rows=2_000)
    return rounded(lagged, ["reading_id"], ALL_HOURLY)


INFERENCE_COLUMNS = [*ALL_HOURLY, "temperature", "humidity", "dew_point"]


@query(
    "w11_latest_inference_row",
    on_hourly(
        f"SELECT city, {sql_text('\"timestamp\"')} AS ts, {sql_rounded(ALL_HOURLY + ['temperature', 'humidity'])}, "
        "CAST(NULL AS DOUBLE) AS dew_point FROM lagged WHERE aqi_lag_72h IS NOT NULL "
        'QUALIFY row_number() OVER (PARTITION BY city ORDER BY "timestamp" DESC) = 1',
        'lagged AS (SELECT city, "timestamp", temperature, humidity, '
        + ", ".join(f"{v} AS {k}" for k, v in HOURLY_COLUMNS_SQL.items())
        + " FROM hourly)",
    ),
)
def latest_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_inference_rows(
        hourly(spark, sf_dir, [*HOURLY_INPUTS, "temperature", "humidity"]), INFERENCE_COLUMNS
    )
    return _city_rows(rows, INFERENCE_COLUMNS)


@query(
    "w12_aqi_change_rate",
    on_readings(
        f"SELECT reading_id, {sql_change('aqi', f'lag(aqi) {READING_WINDOW})')} AS aqi_change_rate FROM readings"
    ),
)
def _change_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).select("city", *READING_ORDER, "aqi")
    rated = add_change_rate(rows, order=READING_ORDER, block_rows=BLOCK_ROWS)
    return rated.select("reading_id", "aqi_change_rate")


@query(
    "w12_aqi_change_rate_blocked",
    on_readings(
        f"SELECT reading_id, {sql_change('aqi', f'lag(aqi) {READING_WINDOW})')} AS aqi_change_rate FROM readings"
    ),
)
def _change_rate_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).select("city", *READING_ORDER, "aqi")
    rated = add_change_rate(rows, order=READING_ORDER, block_rows=10_000)
    return rated.select("reading_id", "aqi_change_rate")


@query(
    "w13_key_dedup",
    on_readings(
        f"SELECT city, station_id, {sql_day('ts')} AS day, reading_id, aqi FROM readings QUALIFY row_number() OVER "
        "(PARTITION BY city, station_id, CAST(ts AS DATE) ORDER BY reading_id DESC) = 1"
    ),
)
def _key_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readings(spark, sf_dir).withColumn("day", F.to_date("ts"))
    kept = latest_per_key(rows, ["city", "station_id", "day"], ["reading_id"])
    return kept.select("city", "station_id", day_text("day").alias("day"), "reading_id", "aqi")


@query(
    "w14_calendar_lag",
    on_hourly(
        f"SELECT city, {sql_text('\"timestamp\"')} AS ts, "
        + ", ".join(
            f"last_value(aqi) OVER (PARTITION BY city ORDER BY epoch_us(\"timestamp\") RANGE BETWEEN "
            f"{(d + 1) * 86_400_000_000 - 1} PRECEDING AND {d * 86_400_000_000} PRECEDING) AS aqi_calendar_lag_{d}d"
            for d in (1, 7)
        )
        + " FROM hourly"
    ),
)
def _calendar_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = calendar_lag(calendar_lag(hourly(spark, sf_dir, ["aqi"]), 1), 7)
    return rows.select("city", text("timestamp").alias("ts"), "aqi_calendar_lag_1d", "aqi_calendar_lag_7d")
