"""Forest and gradient boosting over stored blocks against plain loops."""

from __future__ import annotations

import numpy as np
import pytest

from tests.test_boosting import NAMES, matrix_of, samples
from zephyrine.operators.boosting import Cells, column_ends
from zephyrine.operators.forest import grow_forest, poisson
from zephyrine.operators.learning import VECTOR, fit_gradient_boosting, fit_random_forest, predict
from zephyrine.sources.bundle import ModelBundle, load_model_bundle, save_model_bundle


def best_of(x, y, weight, least):
    """Feature, value and gain of the split that lowers the squared error most."""
    best, whole = None, (weight * y).sum() ** 2 / weight.sum()
    for f in range(x.shape[1]):
        for t in np.unique(x[weight > 0, f])[:-1]:
            left = x[:, f] <= t
            a, b = weight[left].sum(), weight[~left].sum()
            if min(a, b) < least:
                continue
            gain = (weight * y)[left].sum() ** 2 / a + (weight * y)[~left].sum() ** 2 / b - whole
            if gain > 1e-9 and (best is None or gain > best[2] + 1e-9):
                best = f, t, gain
    return best


def plain(x, y, weight, depth, least):
    """What a tree fitted on weighted rows tells of every row."""
    told = np.full(len(y), (weight * y).sum() / weight.sum())
    found = best_of(x, y, weight, least) if depth else None
    if found:
        left = x[:, found[0]] <= found[1]
        for side in (left, ~left):
            told[side] = plain(x, y, np.where(side, weight, 0), depth - 1, least)[side]
    return told


def bootstrap(seed, salt, tree, n):
    return poisson(np.random.Generator(np.random.SFC64([seed, salt % (1 << 63), tree])), n, 1.0)


def test_a_forest_is_the_mean_of_trees_on_bootstrap_samples(spark, monkeypatch):
    x, y = samples(300)
    df = matrix_of(spark, x, y).coalesce(1).cache()
    order = [r["i"] for r in df.collect()]
    salt = df.selectExpr("xxhash64(monotonically_increasing_id(), 7) AS salt").first()["salt"]
    rows, labels = np.array(x)[order], np.array(y)[order]
    expected = [plain(rows, labels, bootstrap(7, salt, t, 300).astype(float), 4, 3) for t in range(5)]
    for held in (4 << 20, 1):  # all trees in step, and one by one
        monkeypatch.setattr("zephyrine.operators.forest.HELD", held)
        model = grow_forest(df, VECTOR, "y", trees=5, depth=4, least=3, bins=32, seed=7)
        got = {r["i"]: r["prediction"] for r in predict(df, ModelBundle("", model, NAMES, "y")).collect()}
        assert [got[i] for i in order] == pytest.approx(np.mean(expected, axis=0))
        assert all(n.cover >= 3 for tree in model.trees for n in tree.values())


def test_gradient_boosting_follows_twice_the_residual_after_a_full_first_tree(spark):
    x, y = samples()
    df, bundle = matrix_of(spark, x, y), ModelBundle("", None, NAMES, "y")
    fit_gradient_boosting(df, bundle, maxIter=7, maxDepth=3, subsamplingRate=1.0, stepSize=0.1)
    rows, labels, every = np.array(x), np.array(y), np.ones(len(y))
    margin = plain(rows, labels, every, 3, 3)
    for _ in range(6):
        margin = margin + 0.1 * plain(rows, 2 * (labels - margin), every, 3, 3)
    got = {r["i"]: r["prediction"] for r in predict(df, bundle).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(margin)


def test_columns_counted_together_are_told_apart():
    rng = np.random.default_rng(4)
    sizes, n = [2, 32, 7, 64, 5, 1], 5_000
    bins = np.stack([rng.integers(0, s, n) for s in sizes]).astype(np.uint8)
    columns = [0, 1, 2, 3, 4]
    for nodes in (1, 3, 200, 20_000):
        node, gradient, weight = rng.integers(0, nodes, n), rng.normal(size=n), rng.integers(1, 4, n).astype(float)
        cells = Cells(columns, sizes, nodes)
        for part in (slice(0, 2_000), slice(2_000, n)):
            cells.add(bins[:, part], node[part], gradient[part], weight[part])
        told = cells.apart()
        for j, c in enumerate(columns):
            for k, own in enumerate((gradient, weight)):
                alone = np.bincount(node * 64 + bins[c], own, nodes * 64).reshape(nodes, 64)
                assert np.allclose(told[k, j], alone)


def test_draws_have_the_distribution_and_few_bins_come_from_many():
    drawn = poisson(np.random.default_rng(1), 200_000, 1.0)
    shares = np.bincount(drawn, minlength=4)[:4] / 200_000
    assert shares == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=0.005)
    assert poisson(np.random.default_rng(1), 50_000, 0.5).mean() == pytest.approx(0.5, abs=0.02)


def test_quantiles_of_many_bins_hold_those_of_fewer(spark):
    df = matrix_of(spark, *samples())
    assert column_ends(df, VECTOR, "y", 64).edges(32) == column_ends(df, VECTOR, "y", 32).edges(32)


def test_ensembles_of_constant_columns_predict_the_mean_and_stored_ones_score_the_same(spark, tmp_path):
    flat = matrix_of(spark, [[1.0, 1.0, 1.0]] * 5, [1.0, 2.0, 3.0, 4.0, 5.0])
    for fit in (fit_random_forest, fit_gradient_boosting):
        bundle = fit(flat, ModelBundle("", None, NAMES, "y"))
        assert {r["prediction"] for r in predict(flat, bundle).collect()} == {3.0}
    df = matrix_of(spark, *samples())
    bundle = fit_random_forest(df, ModelBundle("Random Forest", None, NAMES, "y"), numTrees=4, maxDepth=9)
    save_model_bundle(spark, bundle, str(tmp_path / "m"))
    loaded = load_model_bundle(spark, str(tmp_path / "m"))
    both = predict(predict(df, bundle), loaded, "again")
    assert both.filter("abs(prediction - again) > 1e-12").count() == 0
