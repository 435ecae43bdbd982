"""Whitening against plain eigenvectors, and the contour filter against awkward spectra."""

from __future__ import annotations

import numpy as np
import pytest

from tests.llm.helpers import rows
from zephyrine.llm import queries, whitening

VECTOR = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, x STRING, whitened STRING, _vector STRING"


def vectors(spark, values, ids=None):
    ids = range(len(values)) if ids is None else ids
    data = [(i, v, 0, "x", "w", "v") for i, v in zip(ids, values)]
    return spark.createDataFrame(data, VECTOR)


def with_spectrum(values, seed=3):
    rng = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (turn * np.array(values, float)) @ turn.T


def test_tridiagonal_counts_are_inertia_counts():
    values = [9.0, 5.0, 5.0, 3.0, 1.0, 0.0, -2.0]
    bands = whitening.tridiagonal(with_spectrum(values))
    shifts = np.array([-3.0, -1.0, 0.5, 2.0, 4.0, 6.0, 10.0])
    assert whitening.above(bands, shifts).tolist() == [sum(v > s for v in values) for s in shifts]
    assert np.allclose(whitening.located(bands, 7), values, atol=1e-9)


def test_intervals_hold_what_their_counts_say():
    values = [100, 99, 60, 59, 58, 57, 30, 20, 19.9, 19.8, 5, 1]
    bands = whitening.tridiagonal(with_spectrum(values))
    spans = whitening.intervals(bands, 8)
    assert sum(count for _, _, count in spans) >= 8
    for low, high, count in spans:
        assert count == sum(low < v < high for v in values)


@pytest.mark.parametrize(
    "values",
    [
        [50, 40, 30, 20, 10, 9, 8, 7, 6, 5, 4, 3],
        [10, 10, 10, 9.9999999, 9.9999998, 5, 5, 5, 5, 5, 5, 1],
        [1.0] * 12,
        [1e6, 1, 1e-3, 1e-6, 0, 0, 0, 0, 0, 0, 0, 0],
        [3, 2],
        [4],
    ],
)
def test_contour_filter_finds_all_pairs(spark, values):
    matrix = with_spectrum(values)
    found, pairs = whitening.leading_pairs(spark, matrix, 8)
    wanted = [v for v in values if v > 0][:8]
    assert np.allclose(found, wanted, rtol=1e-9, atol=1e-9 * max(values))
    assert np.allclose(pairs @ pairs.T, np.eye(len(wanted)), atol=1e-12)
    assert np.abs(matrix @ pairs.T - pairs.T * found).max() <= 1e-12 * max(values)


def test_covariance_is_exact_whatever_the_size_of_the_numbers(spark):
    rng = np.random.default_rng(5)
    for scale in (1, 10**4, 10**9):
        x = (rng.integers(-1000, 1000, (40, 3)) * scale).tolist()
        df = spark.createDataFrame([(r,) for r in x], "x ARRAY<BIGINT>").repartition(5)
        n, sums = whitening._sums(df, "x")
        assert n == 40 and sums == [sum(c) for c in zip(*x)]
        got = whitening.covariance(df, n, sums)
        for i in range(3):
            for j in range(3):
                top = sum((40 * r[i] - sums[i]) * (40 * r[j] - sums[j]) for r in x)
                assert got[i, j] == top / (40 * 40 * 40)


def test_whitened_rows_are_white_and_keep_every_row(spark):
    rng = np.random.default_rng(7)
    values = (rng.standard_normal((300, 10)) @ rng.standard_normal((10, 10))).astype(float).tolist()
    values[5] = values[4]
    ids = [None, 1, 1, *range(3, 300)]
    bad = [None, [None] * 10, [float("nan")] * 10, [float("inf"), *[0.0] * 9]]
    df = vectors(spark, [*values, *bad], [*ids, 900, 901, 902, 903]).repartition(4)
    fixed = whitening.fixed_point(df)
    model = whitening.fit(fixed, 4)
    told = whitening.whiten(fixed, model)
    got = told.collect()
    assert sorted((r["vec_id"] for r in got), key=repr) == sorted(ids, key=repr)
    assert whitening.identity_error(told, model) < 1e-9
    x = np.floor(1024 * np.array(values, np.float32).astype(float)) + 100_000
    y = x - x.mean(axis=0)
    e, u = np.linalg.eigh(y.T @ y / len(y))
    plain = np.abs(y @ u[:, ::-1][:, :4] / np.sqrt(e[::-1][:4]))
    own = {r["vec_id"]: np.abs(r["whitened"]) for r in got}
    assert all(np.allclose(own[i], plain[k], atol=1e-9) for k, i in enumerate(ids) if i not in (None, 1))
    assert np.allclose(model.explained, e[::-1][:4] / e.sum(), rtol=1e-12)


@pytest.mark.parametrize("values", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[]], [None]])
def test_tables_without_spread_have_no_components(spark, values):
    fixed = whitening.fixed_point(vectors(spark, values))
    model = whitening.fit(fixed)
    assert len(model.eigenvalues) == 0 and model.explained == []
    told = whitening.whiten(fixed, model)
    assert [list(r["whitened"]) for r in told.collect()] == [[] for v in values if v is not None]
    assert whitening.identity_error(told, model) == 0.0


def test_vectors_of_several_lengths_are_told(spark):
    with pytest.raises(Exception, match="several lengths"):
        whitening.fit(whitening.fixed_point(vectors(spark, [[1.0], [1.0, 2.0], [3.0]])))


def test_query_on_an_empty_table_has_its_columns(spark, tmp_path):
    spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT").write.parquet(
        str(tmp_path / "embeddings.parquet")
    )
    got = queries.QUERIES["op11_whitening"](spark, str(tmp_path))
    assert got.count() == 0
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert rows(got, "vec_id") == []
