"""Imputation, scaling and regression models on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from zephyrine.operators.boosting import BoostedTrees, Ends, boost, column_ends
from zephyrine.operators.forest import grow_forest
from zephyrine.operators.profiling import regression_metrics
from zephyrine.operators.quantiles import exact_quantiles
from zephyrine.sources.bundle import ModelBundle

VECTOR = "_features"


def fit_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians; a column without any value has none and drops out of the model."""
    middles = exact_quantiles(train, columns, [0.5])
    return {c: q[0] for c, q in middles.items() if q[0] is not None}


def imputed(column: str, medians: Mapping[str, float]) -> Column:
    value = F.col(column).cast("double")
    return F.coalesce(value, F.lit(medians[column])) if column in medians else value


def impute_median(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: imputed(c, medians) for c in medians})


def scaler_aggregates(columns: Sequence[str]) -> list[Column]:
    means = [F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)]
    return means + [F.stddev_pop(c).alias(f"d_{i}") for i, c in enumerate(columns)]


def scaler_from(row: Row, columns: Sequence[str]) -> tuple[dict[str, float], dict[str, float]]:
    means = {c: row[f"m_{i}"] for i, c in enumerate(columns)}
    return means, {c: row[f"d_{i}"] for i, c in enumerate(columns)}


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, float], dict[str, float]]:
    """(means, population deviations) in one pass."""
    return scaler_from(df.agg(*scaler_aggregates(columns)).first(), columns)


def scaled(value: Column, mean: float, deviation: float) -> Column:
    """Standard score; a constant column is only centred."""
    return (value - F.lit(mean)) / F.lit(deviation if deviation else 1.0)


def standardize(
    df: DataFrame, means: Mapping[str, float], deviations: Mapping[str, float]
) -> DataFrame:
    return df.withColumns({c: scaled(F.col(c), means[c], deviations[c]) for c in means})


def prepared_columns(bundle: ModelBundle) -> dict[str, Column]:
    """Each model input, imputed and scaled the way the model was trained."""
    out = {}
    for c in bundle.features:
        value = imputed(c, bundle.medians)
        if c in bundle.means:
            value = scaled(value, bundle.means[c], bundle.deviations[c])
        out[c] = value
    return out


def preprocess_inference(df: DataFrame, bundle: ModelBundle) -> DataFrame:
    """Train-time imputation and scaling; never refitted on the rows to score."""
    return df.withColumns(prepared_columns(bundle))


def assemble_vector(df: DataFrame, bundle: ModelBundle) -> DataFrame:
    prepared = {f"_x_{i}": v for i, v in enumerate(prepared_columns(bundle).values())}
    assembler = VectorAssembler(inputCols=list(prepared), outputCol=VECTOR)
    return assembler.transform(df.withColumns(prepared)).drop(*prepared)


def linear_prediction(bundle: ModelBundle) -> Column:
    """A linear model as one generated-code expression instead of a vector transform."""
    total = F.lit(float(bundle.model.intercept))
    for value, weight in zip(prepared_columns(bundle).values(), bundle.model.coefficients):
        total = total + F.lit(float(weight)) * value
    return total


def predict(df: DataFrame, bundle: ModelBundle, name: str = "prediction") -> DataFrame:
    if isinstance(bundle.model, LinearRegressionModel):
        return df.withColumn(name, linear_prediction(bundle))
    if isinstance(bundle.model, BoostedTrees):
        return df.withColumn(name, bundle.model.margin(list(prepared_columns(bundle).values())))
    model = bundle.model.copy().setFeaturesCol(VECTOR).setPredictionCol(name)
    return model.transform(assemble_vector(df, bundle)).drop(VECTOR)


def fit_ridge(
    train: DataFrame,
    features: Sequence[str],
    label: str = "target_aqi_1d",
    medians: Mapping[str, float] | None = None,
    alpha: float = 1.0,
) -> ModelBundle:
    """Ridge on standardized inputs with penalty ``alpha`` on the sum of squares.

    Spark scales its penalty by the row count and by the label's deviation, hence the
    factor on ``regParam``. The normal solver needs one pass over the rows.
    """
    medians = dict(medians or {})
    filled = impute_median(train.filter(F.col(label).isNotNull()), medians)
    row = filled.agg(
        F.count("*").alias("rows"),
        F.stddev_pop(label).alias("spread"),
        *scaler_aggregates(features),
    ).first()
    means, deviations = scaler_from(row, features)
    bundle = ModelBundle(
        "Ridge Regression", None, list(features), label, medians, means, deviations
    )
    matrix = assemble_vector(filled, bundle).select(VECTOR, F.col(label).cast("double").alias(label))
    bundle.model = LinearRegression(
        featuresCol=VECTOR,
        labelCol=label,
        solver="normal",
        standardization=False,
        elasticNetParam=0.0,
        regParam=alpha / row["rows"] * (row["spread"] or 1.0),
    ).fit(matrix)
    return bundle


# Ensemble settings.
SEED = 42
ENSEMBLE_BINS = 32
FOREST = {"numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 3}
BOOSTING = {
    "maxIter": 200,
    "stepSize": 0.05,
    "maxDepth": 4,
    "minInstancesPerNode": 3,
    "subsamplingRate": 0.8,
}


def fit_random_forest(
    matrix: DataFrame, bundle: ModelBundle, ends: Ends | None = None, **settings: object
) -> ModelBundle:
    """Bootstrap samples, every split among all inputs."""
    own = {**FOREST, **settings}
    bundle.model = grow_forest(
        matrix,
        VECTOR,
        bundle.target,
        trees=own["numTrees"],
        depth=own["maxDepth"],
        least=own["minInstancesPerNode"],
        bins=ENSEMBLE_BINS,
        seed=SEED,
        ends=ends,
    )
    return bundle


def fit_gradient_boosting(
    matrix: DataFrame, bundle: ModelBundle, ends: Ends | None = None, **settings: object
) -> ModelBundle:
    """The first tree counts in full; the later ones follow the derivative of the squared error,
    twice the residual."""
    own = {**BOOSTING, **settings}
    bundle.model = boost(
        matrix,
        VECTOR,
        bundle.target,
        rounds=own["maxIter"],
        depth=own["maxDepth"],
        rate=2 * own["stepSize"],
        row_share=own["subsamplingRate"],
        column_share=1.0,
        l2=0.0,
        least=own["minInstancesPerNode"],
        bins=ENSEMBLE_BINS,
        seed=SEED,
        first_rate=1.0,
        ends=ends,
    )
    return bundle


def fit_regularised_boosting(
    matrix: DataFrame, bundle: ModelBundle, ends: Ends | None = None, **settings: object
) -> ModelBundle:
    """Boosting with second-order gains, leaves shrunk by an L2 term, and columns drawn per tree."""
    bundle.model = boost(matrix, VECTOR, bundle.target, ends=ends, **settings)
    return bundle


# The compared ensembles, in order.
TREE_MODELS: dict[str, Callable[..., ModelBundle]] = {
    "Random Forest": fit_random_forest,
    "Gradient Boosting": fit_gradient_boosting,
    "Regularised Boosting": fit_regularised_boosting,
}


def evaluate(bundle: ModelBundle, test: DataFrame) -> dict[str, float]:
    labelled = predict(test, bundle).withColumn("label", F.col(bundle.target))
    row = regression_metrics(labelled).first()
    return {"rmse": row["rmse"], "mae": row["mae"], "r2": row["r2"]}


def fit_all(
    train: DataFrame,
    features: Sequence[str],
    label: str = "target_aqi_1d",
    settings: Mapping[str, Mapping[str, object]] | None = None,
) -> list[ModelBundle]:
    """Fits every model on one prepared, cached matrix.

    The ensembles are fitted at the same time: each is a long chain of short jobs, so
    one alone leaves the cluster waiting between them.
    """
    settings = settings or {}
    known = train.filter(F.col(label).isNotNull())
    medians = fit_medians(known, features)
    effective = [c for c in features if c in medians]
    ridge = fit_ridge(known, effective, label, medians)
    plain = ModelBundle("", None, effective, label, medians)
    matrix = assemble_vector(known, plain).select(VECTOR, F.col(label).cast("double").alias(label))
    matrix.cache().count()
    ends = column_ends(matrix, VECTOR, label)

    def fit(name: str) -> ModelBundle:
        blank = ModelBundle(name, None, effective, label, medians)
        return TREE_MODELS[name](matrix, blank, ends, **settings.get(name, {}))

    pool = ThreadPool(len(TREE_MODELS))
    try:
        run = inheritable_thread_target(train.sparkSession)(fit)
        return [ridge, *pool.map(run, TREE_MODELS)]
    finally:
        pool.close()
        matrix.unpersist()


def compare_models(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str = "target_aqi_1d",
    settings: Mapping[str, Mapping[str, object]] | None = None,
) -> list[ModelBundle]:
    """Fitted bundles with test metrics, best (lowest RMSE) first."""
    bundles = fit_all(train, features, label, settings)
    for bundle in bundles:
        bundle.metrics = evaluate(bundle, test)
    return sorted(bundles, key=lambda b: (b.metrics["rmse"], b.name))


def metrics_table(spark, bundles: Sequence[ModelBundle]) -> DataFrame:
    """One row per model, metrics to four decimals."""
    rows = [
        (b.name, *[round(float(b.metrics[m]), 4) for m in ("rmse", "mae", "r2")]) for b in bundles
    ]
    return spark.createDataFrame(rows, "name STRING, rmse DOUBLE, mae DOUBLE, r2 DOUBLE")
