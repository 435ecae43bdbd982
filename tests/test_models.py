from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import UTC, day, series
from zephyrine.operators.learning import (
    compare_models,
    fit_all,
    fit_medians,
    fit_ridge,
    fit_scaler,
    impute_median,
    metrics_table,
    predict,
    preprocess_inference,
    standardize,
)
from zephyrine.operators.projection import drop_all_missing_columns
from zephyrine.operators.ranking import top_attributions
from zephyrine.operators.reporting import (
    alerts,
    explain,
    max_horizon_aqi,
    pollutant_unpivot,
    today_plus_forecast,
    weather_snapshot,
)
from zephyrine.operators.scoring import (
    attribute_bundle,
    attribute_sampled,
    format_horizons,
    linear_predictor,
    recursive_forecast,
    score_batch,
    with_forecast_labels,
)
from zephyrine.operators.series import add_change_rate
from zephyrine.plans.forecast import forecast_with_alerts, hourly_predictions, latest_feature_rows
from zephyrine.plans.training import train, train_horizons, training_rows
from zephyrine.sources.bundle import ModelBundle, best_bundle_path, load_model_bundle, save_model_bundle

SMALL = {
    "Random Forest": {"numTrees": 5, "maxDepth": 4},
    "Gradient Boosting": {"maxIter": 5},
    "Regularised Boosting": {"rounds": 5},
}


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(5)
    rows = []
    for i in range(200):
        a, b = rng.uniform(0, 10), rng.gauss(0, 1)
        c = None if rng.random() < 0.2 else rng.uniform(0, 1)
        rows.append((f"s{i % 4}", day(i), a, b, c, None, 3 * a - 2 * b + 5 * (c or 0.5) + rng.gauss(0, 0.1)))
    schema = "city STRING, timestamp TIMESTAMP, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, y DOUBLE"
    return spark.createDataFrame(rows, schema).cache()


def test_imputation_and_scaling(spark, samples):
    medians = fit_medians(samples, ["a", "c", "d"])
    values = [r["c"] for r in samples.collect() if r["c"] is not None]
    assert set(medians) == {"a", "c"} and medians["c"] == pytest.approx(np.median(values))
    filled = impute_median(samples, medians)
    assert filled.filter("c IS NULL").count() == 0
    means, deviations = fit_scaler(filled, ["a", "c"])
    scaled = standardize(filled, means, deviations).agg(F.avg("c"), F.stddev_pop("c")).first()
    assert scaled[0] == pytest.approx(0, abs=1e-9) and scaled[1] == pytest.approx(1)
    assert "d" not in drop_all_missing_columns(samples).columns


def test_constant_columns_are_only_centred(spark):
    rows = spark.createDataFrame([(5.0,), (5.0,)], "x DOUBLE")
    assert [r[0] for r in standardize(rows, *fit_scaler(rows, ["x"])).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("alpha", [1.0, 50.0])
def test_ridge_equals_the_closed_form(spark, samples, alpha):
    medians = fit_medians(samples, ["a", "b", "c"])
    bundle = fit_ridge(samples, ["a", "b", "c"], "y", medians, alpha)
    rows = impute_median(samples, medians).collect()
    x = np.array([[r["a"], r["b"], r["c"]] for r in rows])
    y = np.array([r["y"] for r in rows])
    z = (x - x.mean(0)) / x.std(0)
    weights = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean()))
    assert np.allclose(bundle.model.coefficients.toArray(), weights, atol=1e-7)
    expected = z @ weights + y.mean()
    got = [r["prediction"] for r in predict(samples, bundle).collect()]
    assert np.allclose(got, expected, atol=1e-7)
    prepared = preprocess_inference(samples, bundle).select("a").agg(F.avg("a")).first()[0]
    assert prepared == pytest.approx(0, abs=1e-9)


def test_models_are_ranked_and_beat_the_mean(spark, samples):
    renamed = samples.withColumnRenamed("y", "target_aqi_1d")
    before, after = renamed.filter(F.col("timestamp") < F.lit(day(150))), renamed.filter(
        F.col("timestamp") >= F.lit(day(150))
    )
    bundles = compare_models(before, after, ["a", "b", "c", "d"], settings=SMALL)
    errors = [b.metrics["rmse"] for b in bundles]
    assert errors == sorted(errors) and bundles[0].name == "Ridge Regression"
    assert {b.name for b in bundles} == {"Ridge Regression", *SMALL}
    mean = before.agg(F.avg("target_aqi_1d")).first()[0]
    baseline = after.agg(F.sqrt(F.avg((F.col("target_aqi_1d") - mean) ** 2))).first()[0]
    assert all(e < baseline for e in errors)
    assert bundles[0].features == ["a", "b", "c"]
    assert metrics_table(spark, bundles).count() == 4


def test_bundles_survive_storage(spark, samples, tmp_path):
    fitted = fit_all(samples, ["a", "b", "c", "d"], "y", SMALL)
    paths = []
    for i, bundle in enumerate(fitted):
        bundle.metrics = {"rmse": abs(2.0 - i), "mae": 0.0, "r2": 0.0}
        paths.append(str(tmp_path / f"m{i}"))
        save_model_bundle(spark, bundle, paths[-1])
    best = best_bundle_path(spark, paths)
    assert best.endswith("/m2")
    loaded = load_model_bundle(spark, best)
    assert loaded.name == "Gradient Boosting" and loaded.features == ["a", "b", "c"]
    first = [r["prediction"] for r in predict(samples, fitted[2]).collect()]
    assert first == [r["prediction"] for r in predict(samples, loaded).collect()]
    example = loaded.input_example(spark)
    assert example.columns == loaded.features and predict(example, loaded).count() == 1


@pytest.mark.parametrize("index", [0, 1])
def test_attributions_add_up_to_the_prediction(spark, samples, index):
    bundle = fit_all(samples, ["a", "b", "c"], "y", SMALL)[index]
    latest = samples.filter(F.col("timestamp") >= F.lit(day(196)))
    long = attribute_sampled(latest, bundle, samples, background_rows=20, permutations=2)
    totals = {r["city"]: r["s"] for r in long.groupBy("city").agg(F.sum("contribution").alias("s")).collect()}
    background = samples.orderBy(F.col("timestamp").desc()).limit(20)
    mean = predict(background, bundle).agg(F.avg("prediction")).first()[0]
    for row in predict(latest, bundle).collect():
        assert totals[row["city"]] == pytest.approx(row["prediction"] - mean)
    assert long.count() == 4 * 3


def test_linear_attribution_adds_up(spark, samples):
    medians = fit_medians(samples, ["a", "b", "c"])
    bundle = fit_ridge(samples, ["a", "b", "c"], "y", medians)
    latest = samples.filter(F.col("timestamp") >= F.lit(day(196)))
    long = attribute_bundle(latest, bundle)
    totals = {r["city"]: r["s"] for r in long.groupBy("city").agg(F.sum("contribution").alias("s")).collect()}
    for row in predict(latest, bundle).collect():
        assert totals[row["city"]] == pytest.approx(row["prediction"] - bundle.model.intercept)


def test_horizons_are_rounded_to_two_decimals(spark):
    rows = spark.createDataFrame([([101.234, 130.5, 155.9],)], "p ARRAY<DOUBLE>")
    got = rows.select(*format_horizons(F.col("p"))).first().asDict()
    assert got == {"aqi_pred_24h": 101.23, "aqi_pred_48h": 130.5, "aqi_pred_72h": 155.9}


def python_forecast(row: dict, weights: dict, intercept: float, consistent: bool) -> list[float]:
    state, out = dict(row), []
    for _ in range(3):
        p = intercept + sum(w * (state[c] or 0) for c, w in weights.items())
        p = max(0.0, min(500.0, p))
        out.append(round(p, 1))
        one, two = state["aqi_lag_1d"], state["aqi_lag_2d"]
        state["aqi_lag_3d"], state["aqi_lag_2d"] = two, one
        state["aqi_lag_1d"] = state["aqi"] if consistent else p
        for n in (3, 7):
            mean = state[f"aqi_rolling_mean_{n}d"]
            state[f"aqi_rolling_mean_{n}d"] = None if mean is None else (mean * (n - 1) + p) / n
        state["aqi_change_rate"] = round((p - state["aqi"]) / max(state["aqi"], 1) * 100, 4)
        state["aqi"] = p
    return out


@pytest.mark.parametrize("advance", ["hold", "consistent"])
def test_forecast_feeds_predictions_back(spark, advance):
    rng = random.Random(9)
    rows = series(spark, [rng.uniform(0, 400) for _ in range(20)], "long").unionByName(
        series(spark, [120.0], "single")
    )
    weights = {
        "aqi_lag_1d": 0.5, "aqi_lag_2d": 0.2, "aqi_lag_3d": 0.1, "aqi_rolling_mean_3d": 0.3,
        "aqi_rolling_mean_7d": 0.2, "aqi_change_rate": 0.05, "aqi": 0.1,
    }
    latest = latest_feature_rows(add_change_rate(rows))
    got = recursive_forecast(latest, linear_predictor(weights, 4.0), advance=advance)
    for row in latest.collect():
        mine = got.filter(F.col("city") == row["city"]).orderBy("day").collect()
        expected = python_forecast(row.asDict(), weights, 4.0, advance == "consistent")
        assert [r["aqi"] for r in mine] == expected
    with pytest.raises(ValueError):
        recursive_forecast(latest, linear_predictor(weights, 4.0), advance="other")


def test_forecast_is_cut_to_the_valid_range(spark):
    latest = latest_feature_rows(add_change_rate(series(spark, [100.0, 110.0])))
    high = recursive_forecast(latest, linear_predictor({}, 900.0))
    assert {(r["aqi"], r["category"]) for r in high.collect()} == {(500.0, "Hazardous")}
    now = F.lit(dt.datetime(2026, 6, 8, 12, tzinfo=UTC))
    labels = with_forecast_labels(high, now).orderBy("day").collect()
    assert labels[0]["label"] == "Tuesday, Jun 09"
    strip = today_plus_forecast(latest, high).orderBy("day").collect()
    assert [r["day"] for r in strip] == [0, 1, 2, 3] and strip[0]["aqi"] == 110.0
    peak = max_horizon_aqi(latest, high.limit(0))
    assert alerts(peak).first()["level"] == "unhealthy_sensitive"


def test_report_tables(spark):
    rows = spark.createDataFrame(
        [("a", 40.5, None, float("nan"), 30.0, 60.0, None, 1000.0)],
        "city STRING, pm25 DOUBLE, pm10 DOUBLE, no2 DOUBLE, temperature DOUBLE, humidity DOUBLE, "
        "wind_speed DOUBLE, pressure DOUBLE",
    )
    assert [tuple(r) for r in pollutant_unpivot(rows).collect()] == [("a", "PM2.5", 40.5)]
    shown = {r["metric"]: r["reading"] for r in weather_snapshot(rows).collect()}
    assert shown["Temperature"] == "30.0°C" and shown["Wind Speed"] == "N/A m/s"
    long = spark.createDataFrame(
        [("a", "x", -3.25), ("a", "y", 3.25), ("a", "z", 1.0)], "city STRING, feature STRING, contribution DOUBLE"
    )
    top = explain(top_attributions(long, 2)).orderBy("rank").collect()
    assert [r["feature"] for r in top] == ["x", "y"]
    assert top[0]["direction"] == "Decreases AQI"
    assert top[1]["sentence"] == "y is increasing the predicted AQI by 3.2 points"


def test_training_to_forecast_end_to_end(spark, tmp_path):
    rng = random.Random(2)
    table = None
    for city in ("north", "south"):
        values = [100 + 30 * np.sin(i / 5) + rng.gauss(0, 5) for i in range(200)]
        rows = series(spark, [float(v) for v in values], city).withColumns(
            {"pressure": F.lit(1000.0), "wind_speed": F.lit(3.0)}
        )
        table = rows if table is None else table.unionByName(rows)
    bundles, ranks = train(spark, table, str(tmp_path), test_days=30, settings=SMALL)
    assert ranks.count() == 4 and ranks.first()["rank"] == 1
    forecast, alarm = forecast_with_alerts(table, bundles[0])
    assert forecast.count() == 6 and alarm.count() == 2
    assert forecast.filter("aqi < 0 OR aqi > 500").count() == 0
    horizons = train_horizons(training_rows(table), ["aqi_lag_1d", "temperature"])
    scored = score_batch(latest_feature_rows(table), horizons)
    assert scored.count() == 2 and "aqi_pred_72h" in scored.columns
    direct = [
        ModelBundle(b.name, b.model, b.features, b.target, b.medians, b.means, b.deviations) for b in horizons
    ]
    assert hourly_predictions(table, direct).count() == 2
