"""Regularised boosting against a plain loop, and tree explanations against enumeration."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tests.helpers import physical_plan
from zephyrine.operators.attribution import attribute_trees, expected_value, leaves_of
from zephyrine.operators.boosting import BoostedTrees, best_split, boost
from zephyrine.operators.joins import breakpoint_join, segment_join
from zephyrine.operators.learning import VECTOR, fit_gradient_boosting, fit_random_forest, predict
from zephyrine.sources.bundle import ModelBundle, load_model_bundle, save_model_bundle

NAMES = ["a", "b", "c"]


def samples(n=200):
    rng = random.Random(17)
    x = [[rng.randrange(9) / 2, rng.randrange(7), rng.randrange(5) * 1.5] for _ in range(n)]
    return x, [2 * r[0] - r[1] + (r[2] > 3) * r[0] + rng.randrange(4) / 4 for r in x]


def plain_tree(x, gradient, depth, l2, rate):
    """Heap-numbered splits and leaves of one tree, rows listed."""
    tree, rows_of = {}, {1: list(range(len(x)))}
    for at in range(1, 2**depth):
        if at not in rows_of:
            continue
        rows = rows_of[at]
        total, best = sum(gradient[i] for i in rows), None
        for f in range(len(x[0])):
            for t in sorted({x[i][f] for i in rows})[:-1]:
                left = [i for i in rows if x[i][f] <= t]
                g, h = sum(gradient[i] for i in left), len(left)
                gain = (g * g / (h + l2) + (total - g) ** 2 / (len(rows) - h + l2) - total**2 / (len(rows) + l2)) / 2
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, t, left)
        if best:
            tree[at] = best[:3]
            rows_of[2 * at], rows_of[2 * at + 1] = best[3], [i for i in rows if i not in set(best[3])]
    values = {}
    for at, rows in rows_of.items():
        if at not in tree:
            for i in rows:
                values[i] = -rate * sum(gradient[k] for k in rows) / (len(rows) + l2)
    return tree, values


def matrix_of(spark, x, y):
    rows = [(i, Vectors.dense(r), float(v), *map(float, r)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["i", VECTOR, "y", *NAMES])
    return df.repartition(3)


def test_trees_equal_a_plain_loop(spark):
    x, y = samples()
    df = matrix_of(spark, x, y)
    model = boost(df, VECTOR, "y", rounds=12, depth=3, rate=0.4, row_share=1.0, column_share=1.0)
    margin = [sum(y) / len(y)] * len(y)
    for tree in model.trees:
        splits, values = plain_tree(x, [m - v for m, v in zip(margin, y)], 3, 1.0, 0.4)
        assert {k: (n.feature, n.threshold) for k, n in tree.items() if n.feature >= 0} == {
            k: s[1:] for k, s in splits.items()
        }
        assert all(n.gain == pytest.approx(splits[k][0]) for k, n in tree.items() if n.feature >= 0)
        margin = [m + values[i] for i, m in enumerate(margin)]
    bundle = ModelBundle("", model, NAMES, "y")
    got = {r["i"]: r["prediction"] for r in predict(df, bundle).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(margin)


def test_samples_of_rows_and_columns_repeat(spark):
    x, y = samples()
    df = matrix_of(spark, x, y).coalesce(1)
    one, two = (boost(df, VECTOR, "y", rounds=3, depth=2, column_share=0.4) for _ in range(2))
    assert one == two and all(len({n.feature for n in t.values() if n.feature >= 0}) <= 1 for t in one.trees)
    assert all(100 < t[1].cover < 200 for t in one.trees)


def test_splits_keep_the_least_hessian_and_constants_grow_no_tree(spark):
    cells = [(0, 0, -5.0, 1.0), (0, 1, 1.0, 1.0), (0, 2, 4.0, 3.0)]
    assert best_split(cells, 1.0, 1.0)[1:3] == (0, 0) and best_split(cells, 1.0, 2.0)[1:3] == (0, 1)
    assert best_split(cells, 1.0, 3.0) is None and best_split([], 1.0, 1.0) is None
    flat = boost(matrix_of(spark, [[1.0, 1.0, 1.0]] * 5, [3.0] * 5), VECTOR, "y", rounds=2)
    assert flat.trees == [] and flat.base == 3.0
    with pytest.raises(ValueError):
        boost(matrix_of(spark, *samples()).filter("y IS NULL"), VECTOR, "y")


def test_a_stored_model_scores_the_same(spark, tmp_path):
    df = matrix_of(spark, *samples())
    bundle = ModelBundle("Regularised Boosting", boost(df, VECTOR, "y", rounds=4), NAMES, "y")
    save_model_bundle(spark, bundle, str(tmp_path / "m"))
    loaded = load_model_bundle(spark, str(tmp_path / "m"))
    assert isinstance(loaded.model, BoostedTrees) and loaded.model.numFeatures == 3
    both = predict(predict(df, bundle), loaded, "again")
    assert both.filter(F.abs(F.col("prediction") - F.col("again")) > 1e-12).count() == 0


def enumerated(leaves, x):
    """Shapley values from all subsets of features."""
    def value(known):
        total = 0.0
        for leaf in leaves:
            part = leaf.value
            for f, (low, high, share) in leaf.path.items():
                part *= (low < x[f] <= high) if f in known else share
            total += part
        return total

    n, out = len(x), []
    for j in range(n):
        others = [k for k in range(n) if k != j]
        out.append(sum(
            math.factorial(s) * math.factorial(n - 1 - s) / math.factorial(n)
            * (value({*known, j}) - value(set(known)))
            for s in range(n) for known in itertools.combinations(others, s)
        ))
    return out


@pytest.mark.parametrize("kind", ["regularised", "gradient", "forest"])
def test_explanations_equal_enumeration_and_add_up(spark, kind):
    x, y = samples(120)
    df = matrix_of(spark, x, y)
    bundle = ModelBundle("", None, NAMES, "y")
    if kind == "regularised":
        bundle.model = boost(df, VECTOR, "y", rounds=4, depth=3, rate=0.5)
    else:
        fit = fit_gradient_boosting if kind == "gradient" else fit_random_forest
        size = {"maxIter": 3} if kind == "gradient" else {"numTrees": 3}
        fit(df, bundle, maxDepth=3, **size)
    chosen = df.filter("i < 25").drop(VECTOR)
    told = attribute_trees(chosen, bundle, ["i"]).collect()
    got = {}
    for r in told:
        got.setdefault(r["i"], {})[r["feature"]] = r["contribution"]
    leaves, _ = leaves_of(bundle.model)
    predicted = {r["i"]: r["prediction"] for r in predict(chosen, bundle).collect()}
    mean = expected_value(bundle.model)
    for i in range(25):
        assert [got[i][n] for n in NAMES] == pytest.approx(enumerated(leaves, x[i]), abs=1e-9)
        assert sum(got[i].values()) == pytest.approx(predicted[i] - mean, abs=1e-9)


def test_values_meet_their_segment_in_tables_of_any_size(spark):
    rng = random.Random(3)
    lows = sorted(rng.sample(range(0, 40_000, 4), 5_000))
    segments = spark.createDataFrame([(float(v), v + rng.choice([0.0, 1.5, 4.0]), f"s{v}") for v in lows],
                                     "c_low DOUBLE, c_high DOUBLE, name STRING")
    ends = {r["c_low"]: (r["c_high"], r["name"]) for r in segments.collect()}
    values = [None, float("nan"), -5.0, 1e9, *[7_777.0] * 3_000, *[rng.randrange(160_000) / 4 for _ in range(4_000)]]
    rows = spark.createDataFrame(list(enumerate(values)), "i INT, value DOUBLE").repartition(4)
    found = segment_join(rows, segments, "value")
    assert "NestedLoop" not in physical_plan(found) and "Cartesian" not in physical_plan(found)
    got = {r["i"]: r["name"] for r in found.collect()}
    assert len(got) == len(values)
    array = np.array(lows, float)
    for i, v in enumerate(values):
        k = -1 if v is None or v != v else int(np.searchsorted(array, v, "right")) - 1
        high, name = ends[array[k]] if k >= 0 else (-1.0, None)
        assert got[i] == (name if v is not None and v == v and v <= high else None), (i, v)
    assert segment_join(rows, segments.limit(0), "value").filter("name IS NOT NULL").count() == 0


def test_a_given_breakpoint_table_equals_the_fixed_one(spark):
    from zephyrine.schema import PM25_BREAKPOINTS

    table = spark.createDataFrame([tuple(map(float, r)) for r in PM25_BREAKPOINTS],
                                  "c_low DOUBLE, c_high DOUBLE, i_low DOUBLE, i_high DOUBLE")
    rows = spark.createDataFrame([(k / 20,) for k in range(0, 11_000, 7)] + [(None,), (-1.0,)], "pm25 DOUBLE")
    one, two = (sorted(map(tuple, breakpoint_join(rows, t).collect()), key=repr) for t in (None, table))
    assert one == two


def test_a_fit_starts_few_jobs_per_level_and_stores_margins_on_the_way(spark):
    """Levels need no plan of their own; 23 trees pass the point where margins are stored twice."""
    x, y = samples()
    df = matrix_of(spark, x, y)
    context = spark.sparkContext
    context.setJobGroup("fit", "boosting")
    model = boost(df, VECTOR, "y", rounds=23, depth=2, rate=0.3)
    jobs = context.statusTracker().getJobIdsForGroup("fit")
    context.setJobGroup("", "")
    assert len(model.trees) == 23 and len(jobs) <= 2 * 23 + 12
    bundle = ModelBundle("", model, NAMES, "y")
    squares = [
        predict(df, bundle).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
        for bundle.model.trees in (model.trees[:10], model.trees[:])
    ]
    assert squares[1] < squares[0] < sum((v - sum(y) / len(y)) ** 2 for v in y) / len(y)
