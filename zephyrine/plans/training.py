"""Feature table to ranked, stored models."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from zephyrine.operators.learning import compare_models, fit_all, metrics_table
from zephyrine.operators.projection import feature_columns
from zephyrine.operators.quality import min_rows_guard
from zephyrine.operators.ranking import rank_models, time_split
from zephyrine.operators.series import add_daily_lag_features
from zephyrine.schema import TARGET_COLUMNS
from zephyrine.session import scratch_path
from zephyrine.sources.bundle import ModelBundle, save_model_bundle


def training_rows(
    features: DataFrame,
    lookback_days: int = 7,
    keys: Sequence[str] = ("city",),
    order: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """Lagged rows, written once: every later pass reads the table, not the windows."""
    lagged = add_daily_lag_features(min_rows_guard(features), lookback_days, keys, order)
    path = scratch_path(features.sparkSession, "training")
    lagged.write.parquet(path)
    return features.sparkSession.read.parquet(path)


def train(
    spark: SparkSession,
    features: DataFrame,
    model_dir: str | None = None,
    lookback_days: int = 7,
    test_days: int = 365,
    settings: Mapping[str, Mapping[str, object]] | None = None,
    exclude: Sequence[str] = (),
) -> tuple[list[ModelBundle], DataFrame]:
    """(bundles best first, rank table); with ``model_dir`` each bundle is stored."""
    rows = training_rows(features, lookback_days)
    train_rows, test_rows = time_split(rows, test_days)
    inputs = [c for c in feature_columns(rows) if c not in exclude]
    bundles = compare_models(train_rows, test_rows, inputs, settings=settings)
    if model_dir:
        for bundle in bundles:
            name = bundle.name.lower().replace(" ", "_")
            save_model_bundle(spark, bundle, os.path.join(model_dir, name))
    return bundles, rank_models(metrics_table(spark, bundles))


def train_horizons(
    rows: DataFrame, inputs: Sequence[str], model: str = "Ridge Regression"
) -> list[ModelBundle]:
    """One direct model per target, for batch scoring."""
    from zephyrine.operators.learning import fit_medians, fit_ridge

    bundles = []
    for target in TARGET_COLUMNS:
        if model == "Ridge Regression":
            known = rows.dropna(subset=[target])
            medians = fit_medians(known, inputs)
            effective = [c for c in inputs if c in medians]
            bundles.append(fit_ridge(known, effective, target, medians))
        else:
            fitted = fit_all(rows, inputs, target)
            bundles.append(next(b for b in fitted if b.name == model))
    return bundles
