"""Stored and compared models by their properties, and column differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.operators.attribution import attribute_trees, expected_value
from zephyrine.operators.boosting import boost
from zephyrine.operators.learning import (
    VECTOR,
    assemble_vector,
    compare_models,
    evaluate,
    fit_medians,
    fit_ridge,
    predict,
)
from zephyrine.operators.profiling import regression_metrics
from zephyrine.operators.projection import feature_columns
from zephyrine.operators.quality import missing_columns
from zephyrine.operators.ranking import rank_models
from zephyrine.registry.base import daily, events, on_daily, query, rounded, sql_r
from zephyrine.registry.models import INPUTS, LAGGED_SQL, lagged_daily, ridge_sql, ridge_value, split_training
from zephyrine.schema import REQUIRED_COLUMNS
from zephyrine.session import scratch_path
from zephyrine.sources.bundle import ModelBundle, best_bundle_path, load_model_bundle, save_model_bundle
from zephyrine.sources.tables import latest_rows

# Predictors without a fit: the last value, the mean of a week, and the value of a week ago.
NAIVE = {"last value": "aqi", "week mean": "aqi_rolling_mean_7d", "week ago": "aqi_lag_7d"}


@query(
    "t4_rank_naive_models",
    on_daily(
        "SELECT name, rmse, mae, r2, row_number() OVER (ORDER BY rmse, name) AS rank FROM ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS name, {sql_r(f'sqrt(avg((target_aqi_1d - {c}) ** 2))', 4)} AS rmse, "
            f"{sql_r(f'avg(abs(target_aqi_1d - {c}))', 4)} AS mae, "
            f"{sql_r(f'1 - sum((target_aqi_1d - {c}) ** 2) / (var_pop(target_aqi_1d) * count(*))', 4)} AS r2 "
            f"FROM fit_rows WHERE {c} IS NOT NULL AND target_aqi_1d IS NOT NULL"
            for name, c in NAIVE.items()
        )
        + ")",
        LAGGED_SQL,
    ),
)
def _naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lagged_daily(spark, sf_dir)
    each = [
        regression_metrics(
            rows.select(F.col("target_aqi_1d").alias("label"), F.col(c).alias("prediction"))
        ).select(F.lit(name).alias("name"), *[F.bround(m, 4).alias(m) for m in ("rmse", "mae", "r2")])
        for name, c in NAIVE.items()
    ]
    return rank_models(reduce(DataFrame.unionByName, each))


ONE_INPUT_SQL = """one AS (SELECT my, m1, d1, s1 / (n + 1) AS b1 FROM ridge_s, ridge_z)"""
ONE_VALUE = "one.my + one.b1 * (aqi - one.m1) / one.d1"


@query(
    "sk5_stored_ridge",
    on_daily(
        f"SELECT reading_id, {sql_r('CASE WHEN e2 <= e1 THEN two ELSE one END')} AS prediction FROM ("
        f"SELECT *, avg((target_aqi_1d - two) ** 2) OVER () AS e2, avg((target_aqi_1d - one) ** 2) OVER () AS e1 "
        f"FROM (SELECT reading_id, target_aqi_1d, {ridge_value('ridge')} AS two, {ONE_VALUE} AS one "
        "FROM fit_rows, ridge, one))",
        LAGGED_SQL,
        ridge_sql("target_aqi_1d", "ridge"),
        ONE_INPUT_SQL,
    ),
)
def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bundles stored, the better one found by its metrics, loaded, checked and applied."""
    rows = lagged_daily(spark, sf_dir)
    paths = []
    for inputs in (INPUTS[:1], INPUTS):
        bundle = fit_ridge(rows, inputs)
        bundle.metrics = evaluate(bundle, rows)
        paths.append(scratch_path(spark, "bundle"))
        save_model_bundle(spark, bundle, paths[-1])
    best = load_model_bundle(spark, best_bundle_path(spark, paths))
    example = predict(best.input_example(spark), best)
    if example.count() != 1:
        raise ValueError("a bundle must score its own example")
    return rounded(predict(rows, best), ["reading_id"], ["prediction"])


@query(
    "m3_ridge_residuals",
    on_daily(
        "SELECT unnest(['aqi', 'temperature', 'humidity']) AS feature, true AS balanced WHERE EXISTS "
        "(SELECT 1 FROM fit_rows)",
        LAGGED_SQL,
    ),
)
def _residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At the optimum each input's product with the residuals equals the penalty's pull."""
    inputs = ["aqi", "temperature", "humidity"]
    rows = lagged_daily(spark, sf_dir).filter("humidity IS NOT NULL AND target_aqi_1d IS NOT NULL")
    bundle = fit_ridge(rows, inputs)
    rest = F.col("target_aqi_1d") - F.col("prediction")
    scaled = {c: (F.col(c) - bundle.means[c]) / bundle.deviations[c] for c in inputs}
    sums = predict(rows, bundle).agg(*[F.sum(scaled[c] * rest).alias(c) for c in inputs], F.count("*").alias("n")).first()
    weights = dict(zip(bundle.features, bundle.model.coefficients))
    told = [(c, bool(abs(sums[c] - weights[c]) <= 1e-6 * sums["n"])) for c in inputs]
    return spark.createDataFrame(told, "feature STRING, balanced BOOLEAN")


SMALL = {
    "Random Forest": {"numTrees": 20},
    "Gradient Boosting": {"maxIter": 10},
    "Regularised Boosting": {"rounds": 10},
}


@query(
    "m4_m5_m6_m7_model_properties",
    on_daily(
        "SELECT unnest(['Regularised Boosting', 'Gradient Boosting', 'Random Forest', 'Ridge Regression']) "
        "AS name, true AS beats_worst_guess, true AS ranked, true AS metrics_agree "
        "WHERE EXISTS (SELECT 1 FROM fit_rows)",
        LAGGED_SQL,
    ),
)
def _properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four kinds, with fewer trees: errors within the range of labels, ranks, own metrics."""
    rows, train, test = split_training(spark, sf_dir)
    bundles = compare_models(train, test, feature_columns(rows), settings=SMALL)
    ends = test.agg(F.max("target_aqi_1d") - F.min("target_aqi_1d")).first()[0]
    told = []
    for i, b in enumerate(bundles):
        again = evaluate(b, test)
        told.append(
            (
                b.name,
                0 < b.metrics["rmse"] < ends and b.metrics["mae"] <= b.metrics["rmse"] and b.metrics["r2"] <= 1,
                i == 0 or bundles[i - 1].metrics["rmse"] <= b.metrics["rmse"],
                all(abs(again[m] - b.metrics[m]) < 1e-9 for m in again),
            )
        )
    return spark.createDataFrame(
        told, "name STRING, beats_worst_guess BOOLEAN, ranked BOOLEAN, metrics_agree BOOLEAN"
    )


@query(
    "so3_missing_columns",
    "SELECT name AS missing FROM (VALUES "
    + ", ".join(f"('{c}')" for c in REQUIRED_COLUMNS)
    + ") AS r(name) WHERE name NOT IN (SELECT column_name FROM (DESCRIBE events))",
)
def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns that the raw table lacks."""
    absent = missing_columns(REQUIRED_COLUMNS, events(spark, sf_dir))
    return spark.createDataFrame([(c,) for c in absent], "missing STRING")


def _matrix(rows: DataFrame) -> tuple[DataFrame, ModelBundle]:
    """Labelled rows as vectors, and the bundle that prepares them."""
    known = rows.filter(F.col("target_aqi_1d").isNotNull())
    bundle = ModelBundle("", None, list(INPUTS), "target_aqi_1d", fit_medians(known, INPUTS))
    return assemble_vector(known, bundle), bundle


@query(
    "m6_boosting_identities",
    on_daily(
        "SELECT true AS leaf_values_hold, true AS error_falls WHERE EXISTS (SELECT 1 FROM lagged)", LAGGED_SQL
    ),
)
def _boosting_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each leaf of a tree on all rows is its residual sum over its rows and the L2 term; more
    trees lower the error."""
    matrix, bundle = _matrix(lagged_daily(spark, sf_dir))
    one = boost(matrix, VECTOR, "target_aqi_1d", rounds=1, rate=1.0, row_share=1.0, column_share=1.0)
    bundle.model = one
    residual = F.col("target_aqi_1d") - F.lit(one.base)
    leaves = predict(matrix, bundle).groupBy("prediction").agg(F.sum(residual) / (F.count("*") + 1.0))
    held = all(abs(r[0] - one.base - r[1]) < 1e-6 * max(1.0, abs(r[1])) for r in leaves.collect())
    errors = []
    for rounds in (0, 4, 12):
        bundle.model = boost(matrix, VECTOR, "target_aqi_1d", rounds=rounds, rate=0.3)
        errors.append(evaluate(bundle, matrix)["rmse"])
    return spark.createDataFrame(
        [(held, errors == sorted(errors, reverse=True))], "leaf_values_hold BOOLEAN, error_falls BOOLEAN"
    )


@query(
    "m12_tree_shapley",
    on_daily(
        "SELECT station_id, true AS adds_up FROM daily GROUP BY ALL",
    ),
)
def _tree_shapley(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contributions to the boosted prediction of every station's last row add up exactly."""
    rows = lagged_daily(spark, sf_dir)
    matrix, bundle = _matrix(rows)
    bundle.model = boost(matrix, VECTOR, "target_aqi_1d", rounds=6, depth=3, rate=0.3)
    last = latest_rows(daily(spark, sf_dir, INPUTS), ["station_id"])
    told = attribute_trees(last, bundle, ["station_id"]).groupBy("station_id").agg(F.sum("contribution").alias("total"))
    predicted = predict(last, bundle).select("station_id", "prediction")
    error = F.abs(F.col("prediction") - F.lit(expected_value(bundle.model)) - F.col("total"))
    return predicted.join(told, "station_id").select("station_id", (error < 1e-6).alias("adds_up"))
