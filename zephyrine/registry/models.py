"""Model fitting, scoring, forecasts and explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.operators.learning import (
    compare_models,
    fit_medians,
    fit_ridge,
    fit_scaler,
    metrics_table,
    predict,
    preprocess_inference,
)
from zephyrine.operators.projection import assemble_feature_rows, feature_columns
from zephyrine.operators.ranking import rank_models, time_split
from zephyrine.operators.reporting import alerts, max_horizon_aqi, today_plus_forecast
from zephyrine.operators.scoring import (
    attribute_linear,
    attribute_sampled,
    linear_predictor,
    recursive_forecast,
    score_batch,
)
from zephyrine.operators.series import add_change_rate, add_daily_lag_features
from zephyrine.plans.forecast import latest_feature_rows
from zephyrine.plans.training import training_rows
from zephyrine.registry.base import (
    daily,
    on_daily,
    query,
    rounded,
    sql_category,
    sql_change,
    sql_r,
    sql_text,
    written,
)
from zephyrine.registry.series import COMPLETE, DAILY_COLUMNS_SQL, DAILY_INPUTS, DAY_WINDOW
from zephyrine.sources.bundle import ModelBundle
from zephyrine.sources.tables import latest_rows

STATION = ["station_id"]
INPUTS = ["aqi", "temperature"]


def lagged_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once: fitting reads the rows several times."""
    rows = add_daily_lag_features(daily(spark, sf_dir, DAILY_INPUTS), keys=STATION)
    return spark.read.parquet(written(rows, "lagged"))


LAGGED_SQL = (
    "lagged AS (SELECT *, "
    + ", ".join(f"{v} AS {k}" for k, v in DAILY_COLUMNS_SQL.items())
    + " FROM daily),\nfit_rows AS (SELECT * FROM lagged "
    + COMPLETE
    + ")"
)


def ridge_sql(target: str, name: str) -> str:
    """Two standardized inputs: the penalized normal equations by Cramer's rule."""
    return f"""{name}_s AS (SELECT count(*) AS n, avg(aqi) AS m1, stddev_pop(aqi) AS d1,
    avg(temperature) AS m2, stddev_pop(temperature) AS d2, avg({target}) AS my
  FROM fit_rows WHERE {target} IS NOT NULL),
{name}_z AS (SELECT sum((aqi - m1) / d1 * (temperature - m2) / d2) AS s12,
    sum((aqi - m1) / d1 * ({target} - my)) AS s1, sum((temperature - m2) / d2 * ({target} - my)) AS s2
  FROM fit_rows, {name}_s WHERE {target} IS NOT NULL),
{name} AS (SELECT my, m1, d1, m2, d2, ((n + 1) * s1 - s12 * s2) / ((n + 1) * (n + 1) - s12 * s12) AS b1,
    ((n + 1) * s2 - s12 * s1) / ((n + 1) * (n + 1) - s12 * s12) AS b2 FROM {name}_s, {name}_z)"""


def ridge_value(name: str) -> str:
    return (
        f"{name}.my + {name}.b1 * (aqi - {name}.m1) / {name}.d1 "
        f"+ {name}.b2 * (temperature - {name}.m2) / {name}.d2"
    )


@query(
    "m3_ridge_two_inputs",
    on_daily(
        f"SELECT reading_id, {sql_r(ridge_value('ridge'))} AS prediction FROM fit_rows, ridge",
        LAGGED_SQL,
        ridge_sql("target_aqi_1d", "ridge"),
    ),
)
def _ridge_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lagged_daily(spark, sf_dir)
    return rounded(predict(rows, fit_ridge(rows, INPUTS)), ["reading_id"], ["prediction"])


@query("m3_fit_ridge")
def _ridge_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All inputs, held-out week; one row per input with its weight."""
    rows, train, _ = split_training(spark, sf_dir)
    inputs = feature_columns(rows)
    medians = fit_medians(train, inputs)
    bundle = fit_ridge(train, [c for c in inputs if c in medians], "target_aqi_1d", medians)
    weights = [(c, float(w)) for c, w in zip(bundle.features, bundle.model.coefficients)]
    return spark.createDataFrame(weights, "feature STRING, weight DOUBLE")


def split_training(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all rows, train, test) of the daily station features; the last week is the test."""
    stations = daily(spark, sf_dir).withColumn("city", F.col("station_id").cast("string"))
    rows = training_rows(assemble_feature_rows(stations))
    train, test = time_split(rows, 7)
    return rows, train, test


@query("m4_m5_m6_m7_compare_models")
def _compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ridge, forest and both boosted ensembles with full settings, ranked on the test week."""
    rows, train, test = split_training(spark, sf_dir)
    bundles = compare_models(train, test, feature_columns(rows))
    return rank_models(metrics_table(spark, bundles))


@query(
    "m8_score_batch",
    on_daily(
        f"SELECT station_id, {sql_text('\"timestamp\"')} AS ts, {sql_r(ridge_value('r1'), 2)} AS aqi_pred_24h, "
        f"{sql_r(ridge_value('r2'), 2)} AS aqi_pred_48h, {sql_r(ridge_value('r3'), 2)} AS aqi_pred_72h "
        "FROM (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY station_id "
        'ORDER BY "timestamp" DESC) = 1), r1, r2, r3',
        LAGGED_SQL,
        ridge_sql("target_aqi_1d", "r1"),
        ridge_sql("target_aqi_2d", "r2"),
        ridge_sql("target_aqi_3d", "r3"),
    ),
)
def _score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three direct models; the latest row of every station scored at all horizons."""
    rows = lagged_daily(spark, sf_dir)
    bundles = [fit_ridge(rows, INPUTS, f"target_aqi_{k}d") for k in (1, 2, 3)]
    latest = latest_rows(daily(spark, sf_dir, INPUTS), STATION)
    scored = score_batch(latest, bundles, keep=["station_id", "timestamp"])
    return scored.withColumn("ts", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).drop("timestamp")


@query(
    "m9_preprocess_inference",
    on_daily(
        f"SELECT reading_id, {sql_r('(coalesce(pm10, med) - m) / d')} AS pm10 FROM daily, "
        "(SELECT med, avg(coalesce(pm10, med)) AS m, stddev_pop(coalesce(pm10, med)) AS d FROM train, "
        "(SELECT median(pm10) AS med FROM train) GROUP BY med)",
        'train AS (SELECT * FROM daily WHERE "timestamp" <= (SELECT max("timestamp") FROM daily) - INTERVAL 7 DAY)',
    ),
)
def _preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train-time median and scale on all rows; the wholly empty input drops out."""
    rows = daily(spark, sf_dir, ["pm10", "no2"])
    train, _ = time_split(rows, 7)
    medians = fit_medians(train, ["pm10", "no2"])
    kept = list(medians)
    filled = train.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c])) for c in kept})
    means, deviations = fit_scaler(filled, kept)
    bundle = ModelBundle("preparation", None, kept, "aqi", medians, means, deviations)
    return rounded(preprocess_inference(rows, bundle), ["reading_id"], kept)


# Fixed weights, so that the recursion has an exact twin.
WEIGHTS = {
    "aqi_lag_1d": 0.4,
    "aqi_lag_2d": 0.1,
    "aqi_lag_3d": 0.05,
    "aqi_rolling_mean_3d": 0.2,
    "aqi_rolling_mean_7d": 0.15,
    "temperature": 0.3,
    "aqi_change_rate": 0.01,
}
INTERCEPT = 5.0


def latest_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_change_rate(daily(spark, sf_dir, DAILY_INPUTS), STATION)
    return latest_feature_rows(rows, STATION)


def fixed_forecast(latest: DataFrame, advance: str = "hold") -> DataFrame:
    return recursive_forecast(latest, linear_predictor(WEIGHTS, INTERCEPT), STATION, advance=advance)


FORECAST_COLUMNS = [
    "aqi", "temperature", "aqi_change_rate", "aqi_lag_1d", "aqi_lag_2d", "aqi_lag_3d",
    "aqi_rolling_mean_3d", "aqi_rolling_mean_7d",
]


def forecast_ctes(advance: str = "hold") -> list[str]:
    """Three nested steps; each sees the previous step's columns only."""
    predict_sql = f"{INTERCEPT}::DOUBLE" + "".join(
        f" + {w}::DOUBLE * coalesce({c}, 0)" for c, w in WEIGHTS.items()
    )
    clipped = f"greatest(0.0::DOUBLE, least(500.0::DOUBLE, {predict_sql}))"
    ctes = [
        "lagged AS (SELECT *, "
        + ", ".join(f"{v} AS {k}" for k, v in DAILY_COLUMNS_SQL.items())
        + f", {sql_change('aqi', f'lag(aqi) {DAY_WINDOW})')} AS aqi_change_rate FROM daily)",
        f"step0 AS (SELECT station_id, {', '.join(FORECAST_COLUMNS)} FROM lagged QUALIFY row_number() OVER "
        '(PARTITION BY station_id ORDER BY "timestamp" DESC) = 1)',
        "latest AS (SELECT station_id, aqi FROM step0)",
    ]
    first_lag = "p" if advance == "hold" else "aqi"
    for step in (1, 2, 3):
        ctes.append(f"day{step} AS (SELECT *, {clipped} AS p FROM step{step - 1})")
        ctes.append(
            f"step{step} AS (SELECT station_id, p AS aqi, temperature, "
            "round_even((p - aqi) / greatest(aqi, 1) * 100, 4) + 0.0 AS aqi_change_rate, "
            f"{first_lag} AS aqi_lag_1d, aqi_lag_1d AS aqi_lag_2d, aqi_lag_2d AS aqi_lag_3d, "
            "(aqi_rolling_mean_3d * 2 + p) / 3 AS aqi_rolling_mean_3d, "
            f"(aqi_rolling_mean_7d * 6 + p) / 7 AS aqi_rolling_mean_7d FROM day{step})"
        )
    rows = " UNION ALL ".join(
        f"SELECT station_id, {step} AS day, {sql_r('p', 1)} AS aqi, {sql_category('p')} AS category FROM day{step}"
        for step in (1, 2, 3)
    )
    return [*ctes, f"forecast AS ({rows})"]


@query("m10_recursive_forecast", on_daily("SELECT * FROM forecast", *forecast_ctes()))
def recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days for every station at once, prediction fed back."""
    return fixed_forecast(latest_daily(spark, sf_dir))


@query(
    "m10_recursive_forecast_consistent",
    on_daily("SELECT * FROM forecast", *forecast_ctes("consistent")),
)
def _consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixed_forecast(latest_daily(spark, sf_dir), "consistent")


@query(
    "so1_today_plus_forecast",
    on_daily(
        f"SELECT station_id, 0 AS day, aqi, {sql_category('aqi')} AS category FROM latest "
        "UNION ALL SELECT station_id, day, aqi, category FROM forecast",
        *forecast_ctes(),
    ),
)
def _today_plus(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = spark.read.parquet(written(latest_daily(spark, sf_dir), "latest"))
    return today_plus_forecast(latest, fixed_forecast(latest), STATION)


@query(
    "a14_max_horizon_alerts",
    on_daily(
        "SELECT station_id, max_aqi, CASE WHEN max_aqi <= 50 THEN 'good' WHEN max_aqi <= 100 THEN 'moderate' "
        "WHEN max_aqi <= 150 THEN 'unhealthy_sensitive' WHEN max_aqi <= 200 THEN 'unhealthy' "
        "WHEN max_aqi <= 300 THEN 'very_unhealthy' ELSE 'hazardous' END AS level FROM ("
        "SELECT station_id, max(aqi) AS max_aqi FROM (SELECT station_id, aqi FROM latest "
        "UNION ALL SELECT station_id, aqi FROM forecast) GROUP BY station_id)",
        *forecast_ctes(),
    ),
)
def _horizon_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = spark.read.parquet(written(latest_daily(spark, sf_dir), "latest"))
    peaks = max_horizon_aqi(latest, fixed_forecast(latest), STATION)
    return alerts(peaks, STATION).drop("message")


@query(
    "m11_attribute_linear",
    on_daily(
        " UNION ALL ".join(
            f"SELECT station_id, '{c}' AS feature, {sql_r(f'{w}::DOUBLE * coalesce({c} - mean_{c}, 0)')} "
            "AS contribution FROM latest_full, means"
            for c, w in WEIGHTS.items()
        ),
        forecast_ctes()[0],
        f"latest_full AS (SELECT station_id, {', '.join(FORECAST_COLUMNS)} FROM lagged QUALIFY row_number() OVER "
        '(PARTITION BY station_id ORDER BY "timestamp" DESC) = 1)',
        "means AS (SELECT " + ", ".join(f"avg({c}) AS mean_{c}" for c in WEIGHTS) + " FROM lagged)",
    ),
)
def _attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_change_rate(daily(spark, sf_dir, DAILY_INPUTS), STATION)
    lagged = add_daily_lag_features(rows, keys=STATION, drop=False)
    means, _ = fit_scaler(lagged, list(WEIGHTS))
    long = attribute_linear(latest_rows(lagged, STATION), WEIGHTS, means, STATION)
    return rounded(long, ["station_id", "feature"], ["contribution"])


@query(
    "m12_attribute_sampled",
    on_daily(
        f"SELECT station_id, 'aqi' AS feature, {sql_r('b1 / d1 * (aqi - g1)')} AS contribution "
        "FROM latest, ridge, ground UNION ALL SELECT station_id, 'temperature', "
        f"{sql_r('b2 / d2 * (temperature - g2)')} FROM latest, ridge, ground",
        LAGGED_SQL,
        ridge_sql("target_aqi_1d", "ridge"),
        "latest AS (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY station_id "
        'ORDER BY "timestamp" DESC) = 1)',
        "ground AS (SELECT avg(aqi) AS g1, avg(temperature) AS g2 FROM (SELECT aqi, temperature FROM daily "
        'ORDER BY "timestamp" DESC, reading_id DESC LIMIT 50))',
    ),
)
def _attribute_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For a linear model the sampled values must equal the closed form."""
    rows = lagged_daily(spark, sf_dir)
    bundle = fit_ridge(rows, INPUTS)
    days = spark.read.parquet(written(daily(spark, sf_dir, INPUTS), "daily"))
    long = attribute_sampled(
        latest_rows(days, STATION), bundle, days, STATION, order=["timestamp", "reading_id"]
    )
    return rounded(long, ["station_id", "feature"], ["contribution"])
