"""Latest rows to forecasts, alerts and stored predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from zephyrine.operators.reporting import alerts, max_horizon_aqi
from zephyrine.operators.scoring import bundle_predictor, recursive_forecast, score_batch
from zephyrine.operators.ranking import last_n_per_key
from zephyrine.operators.series import DAILY_LAGS, add_daily_lag_features, latest_inference_rows
from zephyrine.session import scratch_path
from zephyrine.sources.bundle import ModelBundle
from zephyrine.sources.tables import latest_rows


def latest_feature_rows(
    features: DataFrame, keys: Sequence[str] = ("city",), order: Sequence[str] = ("timestamp",)
) -> DataFrame:
    """Newest row per series with its lag features.

    Only the rows its frames reach are shuffled, however long the history is.
    """
    reach = last_n_per_key(features, max(DAILY_LAGS) + 1, keys, order)
    lagged = add_daily_lag_features(reach, keys=keys, order=order, drop=False)
    return latest_rows(lagged, keys, order)


def forecast_with_alerts(
    features: DataFrame,
    bundle: ModelBundle,
    keys: Sequence[str] = ("city",),
    order: Sequence[str] = ("timestamp",),
    advance: str = "hold",
) -> tuple[DataFrame, DataFrame]:
    """(three forecast rows per series, one alert row per series).

    The latest rows, one per series, are written once: forecast and alerts both read them.
    """
    spark = features.sparkSession
    path = scratch_path(spark, "latest")
    latest_feature_rows(features, keys, order).write.parquet(path)
    latest = spark.read.parquet(path)
    forecast = recursive_forecast(latest, bundle_predictor(bundle), keys, advance=advance)
    return forecast, alerts(max_horizon_aqi(latest, forecast, keys), keys)


def hourly_predictions(features: DataFrame, bundles: Sequence[ModelBundle]) -> DataFrame:
    """Latest hourly row per city scored at all three horizons."""
    inputs = list(dict.fromkeys(c for b in bundles for c in b.features))
    return score_batch(latest_inference_rows(features, inputs), bundles)
