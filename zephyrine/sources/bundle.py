"""Model bundles: a fitted model with the preparation it was trained on."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrine.operators.boosting import BoostedTrees
from zephyrine.sources.store import read_table

_METADATA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("medians", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("means", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("deviations", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


@dataclass
class ModelBundle:
    """``features`` is the effective ordered input list, after dropping empty columns."""

    name: str
    model: object
    features: list[str]
    target: str = "target_aqi_1d"
    medians: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    deviations: dict[str, float] = field(default_factory=dict)
    metrics: dict[str, float] = field(default_factory=dict)

    def input_example(self, spark: SparkSession) -> DataFrame:
        """One row of zeros in the model's input schema."""
        schema = ", ".join(f"`{c}` DOUBLE" for c in self.features)
        return spark.createDataFrame([tuple(0.0 for _ in self.features)], schema)


def save_model_bundle(spark: SparkSession, bundle: ModelBundle, path: str) -> None:
    if isinstance(bundle.model, BoostedTrees):
        bundle.model.table(spark).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "trees"))
    else:
        bundle.model.write().overwrite().save(os.path.join(path, "model"))
    row = tuple(getattr(bundle, f.name) for f in _METADATA.fields)
    spark.createDataFrame([row], _METADATA).coalesce(1).write.mode("overwrite").parquet(
        os.path.join(path, "metadata")
    )


def load_model_bundle(spark: SparkSession, path: str) -> ModelBundle:
    """The stored bundle; fails if its model does not score its own input schema."""
    row = spark.read.parquet(os.path.join(path, "metadata")).first()
    trees = read_table(spark, os.path.join(path, "trees"))
    if trees is not None:
        model = BoostedTrees.from_table(trees)
    else:
        model = DefaultParamsReader.loadParamsInstance(os.path.join(path, "model"), spark)
    bundle = ModelBundle(model=model, **row.asDict())
    check_bundle(bundle)
    return bundle


def check_bundle(bundle: ModelBundle) -> None:
    """Names, preparation and model width must agree, before anything is scored."""
    if not bundle.features or len(set(bundle.features)) != len(bundle.features):
        raise ValueError(f"bundle {bundle.name}: inputs are missing or repeated")
    for part in ("medians", "means", "deviations"):
        known = getattr(bundle, part)
        absent = [f for f in bundle.features if f not in known]
        if known and absent:
            raise ValueError(f"bundle {bundle.name}: no {part} for {absent}")
    width = getattr(bundle.model, "numFeatures", -1)
    if width >= 0 and width != len(bundle.features):
        raise ValueError(f"bundle {bundle.name}: the model takes {width} inputs, not {len(bundle.features)}")


def best_bundle_path(spark: SparkSession, paths: list[str]) -> str:
    """The stored bundle with the lowest RMSE."""
    metadata = spark.read.parquet(*[os.path.join(p, "metadata") for p in paths])
    location = F.regexp_replace(F.input_file_name(), "/metadata/[^/]*$", "")
    row = metadata.select(location.alias("path"), F.col("metrics")["rmse"].alias("rmse")).agg(
        F.min_by("path", F.struct("rmse", "path")).alias("path")
    ).first()
    return row["path"]
