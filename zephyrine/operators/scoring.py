"""Batch scoring, recursive forecasts and prediction explanations."""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.functions.calendar import forecast_label, time_features
from zephyrine.functions.index import aqi_category
from zephyrine.functions.numeric import clip, half_even
from zephyrine.operators.boosting import BoostedTrees
from zephyrine.operators.learning import VECTOR, imputed, predict, scaled
from zephyrine.sources.bundle import ModelBundle
from zephyrine.sources.store import FORECAST_HORIZONS

Predictor = Callable[[DataFrame, str], DataFrame]


def format_horizons(predictions: Column) -> list[Column]:
    """An array of three predictions to the three rounded horizon columns."""
    return [
        half_even(F.get(predictions, F.lit(i)), 2).alias(f"aqi_pred_{h}h")
        for i, h in enumerate(FORECAST_HORIZONS)
    ]


def score_batch(
    df: DataFrame, bundles: Sequence[ModelBundle], keep: Sequence[str] = ("city", "timestamp")
) -> DataFrame:
    """One direct model per horizon, chained over the same rows: no join."""
    names = [f"_prediction_{i}" for i in range(len(bundles))]
    for bundle, name in zip(bundles, names):
        df = predict(df, bundle, name)
    return df.select(*keep, *format_horizons(F.array(*names)))


def linear_predictor(weights: Mapping[str, float], intercept: float) -> Predictor:
    """A fixed linear model; a missing input counts as 0."""

    def apply(df: DataFrame, name: str) -> DataFrame:
        total = F.lit(float(intercept))
        for column, weight in weights.items():
            total = total + F.lit(float(weight)) * F.coalesce(F.col(column), F.lit(0.0))
        return df.withColumn(name, total)

    return apply


def bundle_predictor(bundle: ModelBundle) -> Predictor:
    return lambda df, name: predict(df, bundle, name)


def _advance(columns: Sequence[str], prediction: Column, advance: str) -> dict[str, Column]:
    """The feature row of the next day. All right-hand sides see the old values."""
    aqi = F.col("aqi")
    updates = {
        "aqi_lag_3d": F.col("aqi_lag_2d"),
        "aqi_lag_2d": F.col("aqi_lag_1d"),
        "aqi_lag_1d": prediction,
        "aqi_rolling_mean_3d": (F.col("aqi_rolling_mean_3d") * 2 + prediction) / F.lit(3.0),
        "aqi_rolling_mean_7d": (F.col("aqi_rolling_mean_7d") * 6 + prediction) / F.lit(7.0),
        "aqi_change_rate": half_even(
            (prediction - aqi) / F.greatest(aqi, F.lit(1.0)) * F.lit(100.0), 4
        ),
        "aqi": prediction,
    }
    if advance == "consistent":
        updates["aqi_lag_1d"] = aqi
        next_day = F.col("timestamp") + F.expr("INTERVAL 1 DAY")
        updates["timestamp"] = next_day
        updates |= {k: v for k, v in time_features(next_day).items() if k in columns}
    elif advance != "hold":
        raise ValueError(f"unknown advance rule {advance!r}")
    return {k: v for k, v in updates.items() if k in columns}


def recursive_forecast(
    latest: DataFrame,
    predictor: Predictor,
    keys: Sequence[str] = ("city",),
    days: int = 3,
    advance: str = "hold",
) -> DataFrame:
    """Forecast of the next days for every series at once, one row per series and day.

    Each day's prediction, cut to 0..500, feeds the next day's lags. ``hold`` puts the
    prediction into the first lag and leaves weather and calendar as they are;
    ``consistent`` shifts the last actual value into the first lag, as in training, and
    advances the calendar.
    """
    df = latest
    names = []
    for day in range(1, days + 1):
        raw, name = f"_raw_{day}", f"_day_{day}"
        df = predictor(df, raw).withColumn(name, clip(F.col(raw), 0, 500)).drop(raw)
        names.append(name)
        if day < days:
            df = df.withColumns(_advance(df.columns, F.col(name), advance))
    cells = [F.struct(F.lit(i).alias("day"), F.col(n).alias("predicted")) for i, n in enumerate(names, 1)]
    return df.select(*keys, F.inline(F.array(*cells))).select(
        *keys,
        "day",
        half_even(F.col("predicted"), 1).alias("aqi"),
        aqi_category(F.col("predicted")).getField("label").alias("category"),
    )


def with_forecast_labels(forecast: DataFrame, now: Column) -> DataFrame:
    return forecast.withColumn("label", forecast_label(now, F.col("day")))


def attribute_linear(
    df: DataFrame,
    weights: Mapping[str, float],
    background: Mapping[str, float],
    keys: Sequence[str] = ("city",),
    deviations: Mapping[str, float] | None = None,
) -> DataFrame:
    """Contribution of each input of a linear model: its weight times the distance from
    the background mean, in deviations if the weights are per deviation. Long form; a
    missing input sits at the mean."""
    deviations = deviations or {}
    cells = []
    for name, weight in weights.items():
        mean = float(background[name])
        value = F.coalesce(F.col(name).cast("double"), F.lit(mean))
        score = scaled(value, mean, deviations.get(name, 1.0))
        cells.append(
            F.struct(F.lit(name).alias("feature"), (F.lit(float(weight)) * score).alias("contribution"))
        )
    return df.select(*keys, F.inline(F.array(*cells)))


def attribute_bundle(
    df: DataFrame, bundle: ModelBundle, keys: Sequence[str] = ("city",)
) -> DataFrame:
    """``attribute_linear`` for a fitted linear bundle against its training means."""
    weights = dict(zip(bundle.features, bundle.model.coefficients))
    filled = df.withColumns({c: imputed(c, bundle.medians) for c in bundle.features})
    return attribute_linear(filled, weights, bundle.means, keys, bundle.deviations)


def attribute_sampled(
    df: DataFrame,
    bundle: ModelBundle,
    background: DataFrame,
    keys: Sequence[str] = ("city",),
    background_rows: int = 50,
    order: Sequence[str] = ("timestamp",),
    permutations: int = 1,
    seed: int = 42,
) -> DataFrame:
    """Permutation-sampled Shapley values of any model.

    For every row, background row and seeded feature order, features switch one by one
    from the background row's value to the row's own; the change in the prediction at
    each switch is credited to that feature. Per row the values add up exactly to the
    prediction minus the mean prediction over the background.

    The background is a fixed number of latest rows, carried as literals, so each row
    grows by a constant factor and there is no join.
    """
    features = list(bundle.features)
    width = len(features)
    inputs = [imputed(c, bundle.medians) for c in features]
    newest = background.orderBy(*[F.col(c).desc() for c in order]).limit(background_rows)
    rows = newest.select(F.array(*inputs).alias("x")).collect()
    rng = random.Random(seed)
    cases = []
    for row in rows:
        for _ in range(permutations):
            ranks = list(range(1, width + 1))
            rng.shuffle(ranks)
            cases.append({"base": list(row["x"]), "ranks": ranks})
    literal = F.from_json(
        F.lit(json.dumps(cases)), "ARRAY<STRUCT<base: ARRAY<DOUBLE>, ranks: ARRAY<INT>>>"
    )
    # One small row per key becomes cases x steps rows: spread the keys first.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = df.select(*keys, F.array(*inputs).alias("_own")).repartition(parts, *keys)
    expanded = own.select(*keys, "_own", F.posexplode(literal).alias("_case", "_c"))
    stepped = expanded.select(
        *keys, "_case", "_own", "_c", F.explode(F.sequence(F.lit(0), F.lit(width))).alias("_step")
    )
    mixed = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.when(
            F.get(F.col("_c.ranks"), i) <= F.col("_step"), F.get(F.col("_own"), i)
        ).otherwise(F.get(F.col("_c.base"), i)),
    )
    hybrid = stepped.withColumn("_mixed", mixed)
    columns = {c: F.get(F.col("_mixed"), F.lit(i)) for i, c in enumerate(features)}
    predicted = predict_mixed(hybrid, columns, bundle)
    # A step's gain is its prediction minus the one before: +f at its own rank, -f at
    # the next feature's rank, which needs no window over the steps.
    arrived = F.array_position(F.col("_c.ranks"), F.col("_step")).cast("int")
    left = F.array_position(F.col("_c.ranks"), F.col("_step") + 1).cast("int")
    credits = F.array_compact(
        F.array(
            F.when(arrived > 0, F.struct(arrived.alias("i"), F.col("_f").alias("v"))),
            F.when(left > 0, F.struct(left.alias("i"), (-F.col("_f")).alias("v"))),
        )
    )
    names = F.array(*[F.lit(c) for c in features])
    return (
        predicted.select(*keys, F.inline(credits))
        .groupBy(*keys, F.get(names, F.col("i") - 1).alias("feature"))
        .agg((F.sum("v") / F.lit(float(len(cases)))).alias("contribution"))
    )


def predict_mixed(df: DataFrame, columns: Mapping[str, Column], bundle: ModelBundle) -> DataFrame:
    """Prediction ``_f`` from already imputed inputs held as expressions."""
    values = []
    for name, value in columns.items():
        if name in bundle.means:
            value = scaled(value, bundle.means[name], bundle.deviations[name])
        values.append(value)
    if isinstance(bundle.model, BoostedTrees):
        return df.withColumn("_f", bundle.model.margin(values))
    model = bundle.model.copy().setFeaturesCol(VECTOR).setPredictionCol("_f")
    return model.transform(df.withColumn(VECTOR, array_to_vector(F.array(*values)))).drop(VECTOR)
