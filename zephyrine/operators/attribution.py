"""Exact Shapley values of tree ensembles, as column arithmetic over a table of leaf paths.

A leaf gives its value to a row that meets all conditions of its path. If a feature is not
known, a row goes on either side as often as the training rows did, so a leaf is a product
over the features of its path: one if the row lies in the feature's interval, else zero,
or, unknown, the share of the training rows that do. The Shapley values of such a product
follow from its coefficients, without listing subsets; leaves add up.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.operators.boosting import BoostedTrees
from zephyrine.operators.learning import imputed, scaled
from zephyrine.sources.bundle import ModelBundle

_FAR = 1.7976931348623157e308


@dataclass
class Leaf:
    """Value, and per feature of the path its interval (low, high] and the share of rows in it."""

    value: float
    path: dict[int, tuple[float, float, float]]


def _met(path: dict, feature: int, low: float, high: float, share: float) -> dict:
    before = path.get(feature, (-_FAR, _FAR, 1.0))
    return {**path, feature: (max(low, before[0]), min(high, before[1]), before[2] * share)}


def _own_leaves(tree: dict, at: int = 1, path: dict | None = None) -> Iterator[Leaf]:
    node = tree[at]
    if node.feature < 0:
        yield Leaf(node.value, path or {})
        return
    for child, low, high in ((2 * at, -_FAR, node.threshold), (2 * at + 1, node.threshold, _FAR)):
        share = tree[child].cover / node.cover if node.cover else 0.5
        yield from _own_leaves(tree, child, _met(path or {}, node.feature, low, high, share))


def _ml_leaves(node, weight: float, path: dict | None = None) -> Iterator[Leaf]:
    """Leaves of a fitted Spark tree; its splits are on numbers only."""
    if node.subtreeDepth() == 0:
        yield Leaf(weight * node.prediction(), path or {})
        return
    split, total = node.split(), node.impurityStats().count()
    feature, threshold = split.featureIndex(), split.threshold()
    for child, low, high in ((node.leftChild(), -_FAR, threshold), (node.rightChild(), threshold, _FAR)):
        share = child.impurityStats().count() / total
        yield from _ml_leaves(child, weight, _met(path or {}, feature, low, high, share))


def leaves_of(model: object) -> tuple[list[Leaf], float]:
    """All leaves of an ensemble, values weighted, and the constant beside them."""
    if isinstance(model, BoostedTrees):
        return [leaf for tree in model.trees for leaf in _own_leaves(tree)], model.base
    weights = list(model.treeWeights)
    if type(model).__name__.startswith("RandomForest"):
        weights = [w / sum(weights) for w in weights]
    trees = zip(model.trees, weights)
    return [leaf for tree, w in trees for leaf in _ml_leaves(tree._java_obj.rootNode(), w)], 0.0


def expected_value(model: object) -> float:
    """What the ensemble gives with no feature known: the cover-weighted mean of its leaves."""
    leaves, base = leaves_of(model)
    return base + sum(leaf.value * math.prod(p[2] for p in leaf.path.values()) for leaf in leaves)


def _weights(depth: int) -> list[list[float]]:
    """For paths of n features the weight of a coalition of s of the others."""
    f = math.factorial
    return [[f(s) * f(n - 1 - s) / f(n) for s in range(n)] for n in range(depth + 1)]


def _credit(path: Column, place: Column, weights: Column) -> Column:
    """The Shapley value of one feature of a path, for a leaf of value 1."""
    one = F.array(F.lit(1.0))
    others = F.filter(path, lambda p, i: i != place)

    def times(done: Column, p: Column) -> Column:
        zero = F.array(F.lit(0.0))
        return F.zip_with(
            F.concat(done, zero), F.concat(zero, done), lambda a, b: a * p["share"] + b * p["inside"]
        )

    coefficients = F.aggregate(others, one, times)
    weighed = F.zip_with(coefficients, F.get(weights, F.size(path)), lambda c, w: c * w)
    own = F.get(path, place)
    total = F.aggregate(weighed, F.lit(0.0), lambda a, b: a + b)
    return total * (own["inside"] - own["share"])


def attribute_trees(df: DataFrame, bundle: ModelBundle, keys: Sequence[str] = ("city",)) -> DataFrame:
    """``keys, feature, contribution`` of every row and feature, exact for its tree ensemble.

    Per row the contributions add up to the prediction minus ``expected_value``. A row becomes
    as many rows as the model has leaves, which are carried as a literal, and is added up
    again; there is no join. Rows with equal keys add up together.
    """
    leaves, _ = leaves_of(bundle.model)
    depth = max((len(leaf.path) for leaf in leaves), default=0)
    told = [
        {"v": leaf.value, "p": [{"f": f, "low": p[0], "high": p[1], "share": p[2]} for f, p in leaf.path.items()]}
        for leaf in leaves
        if leaf.path
    ]
    kind = "ARRAY<STRUCT<v: DOUBLE, p: ARRAY<STRUCT<f: INT, low: DOUBLE, high: DOUBLE, share: DOUBLE>>>>"
    literal = F.from_json(F.lit(json.dumps(told)), kind)
    weights = F.array(*[F.array(*[F.lit(w) for w in row]).cast("array<double>") for row in _weights(depth)])
    inputs = []
    for name in bundle.features:
        value = imputed(name, bundle.medians)
        inputs.append(scaled(value, bundle.means[name], bundle.deviations[name]) if name in bundle.means else value)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = df.select(*keys, F.array(*inputs).alias("_x")).repartition(parts, *keys)
    spread = own.select(*keys, "_x", F.explode(literal).alias("_leaf"))
    path = F.transform(
        F.col("_leaf.p"),
        lambda p: F.struct(
            p["f"].alias("f"),
            p["share"].alias("share"),
            ((F.get(F.col("_x"), p["f"]) > p["low"]) & (F.get(F.col("_x"), p["f"]) <= p["high"]))
            .cast("double")
            .alias("inside"),
        ),
    )
    met = spread.select(*keys, F.col("_leaf.v").alias("_v"), path.alias("_path"))
    each = met.select(*keys, "_v", "_path", F.posexplode("_path").alias("_at", "_p"))
    credit = F.col("_v") * _credit(F.col("_path"), F.col("_at"), weights)
    added = each.select(*keys, F.col("_p.f").alias("_f"), credit.alias("_c")).groupBy(*keys, "_f").agg(F.sum("_c").alias("_c"))
    names = F.array(*[F.lit(c) for c in bundle.features])
    every = F.transform(F.sequence(F.lit(0), F.lit(len(bundle.features) - 1)), lambda i: F.struct(i.alias("_f"), F.lit(0.0).alias("_c")))
    none = df.select(*keys, F.inline(every))
    whole = added.unionByName(none).groupBy(*keys, "_f").agg(F.sum("_c").alias("contribution"))
    return whole.select(*keys, F.get(names, F.col("_f")).alias("feature"), "contribution")
