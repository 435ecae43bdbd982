"""Links among embeddings against comparing all pairs, with cells and blocks kept small."""

from __future__ import annotations

import numpy as np
import pytest

from zephyrine.llm import embedding_dedup

VECTOR = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, node STRING, key_a STRING, links STRING"


def vectors(spark, data):
    return spark.createDataFrame([(*r, "n", "k", "l") for r in data], VECTOR)


def brute(data, similarity):
    """``n_links`` and component per row position."""
    usable = []
    for _, v, label in data:
        whole = v is not None and label is not None and all(c is not None and np.isfinite(c) for c in v)
        usable.append(whole and any(v))
    units = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if u else None
             for (_, v, _), u in zip(data, usable)]
    links = [
        [j for j in range(len(data)) if j != i and usable[i] and usable[j] and data[i][2] == data[j][2]
         and float(units[i] @ units[j]) >= similarity]
        for i in range(len(data))
    ]
    out = []
    for i in range(len(data)):
        seen, ahead = {i}, [i]
        while ahead:
            ahead = [j for k in ahead for j in links[k] if j not in seen and not seen.add(j)]
        ids = [data[j][0] for j in seen if data[j][0] is not None]
        out.append((data[i][0], len(links[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def got_of(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in df.collect()), key=repr)


def groups(rng, sizes, dims, noise, labels=2):
    """Groups around random directions; noise sets how far their members lie apart."""
    data, at = [], 0
    for k, size in enumerate(sizes):
        centre = rng.standard_normal(dims)
        for _ in range(size):
            v = centre / np.linalg.norm(centre) + noise * rng.standard_normal(dims) / np.sqrt(dims)
            data.append((at, (v * rng.uniform(0.5, 3)).astype(np.float32).tolist(), k % labels))
            at += 1
    rng.shuffle(data)
    return [(int(i), v, label) for i, v, label in data]


@pytest.mark.parametrize("noise,dims,similarity", [(0.25, 8, 0.93), (0.6, 4, 0.93), (0.9, 3, 0.8), (0.05, 6, 0.99)])
def test_links_equal_all_pairs(spark, noise, dims, similarity):
    rng = np.random.default_rng(int(100 * noise) + dims)
    data = groups(rng, [40, 25, 10, 5, 2, 2, 1, 1, 1, 30], dims, noise)
    found = embedding_dedup.near_duplicates(vectors(spark, data), similarity, cell_rows=8, block_rows=7)
    assert got_of(found) == brute(data, similarity)


def test_a_chain_across_cells_is_one_group(spark):
    turn = [k * 0.3 for k in range(21)]
    data = [(50 - k, [float(np.cos(a)), float(np.sin(a))], 1) for k, a in enumerate(turn)]
    found = embedding_dedup.near_duplicates(vectors(spark, data), 0.95, cell_rows=2, block_rows=3)
    assert got_of(found) == brute(data, 0.95)
    assert {r["component_id"] for r in found.collect()} == {30}


def test_odd_rows_have_a_defined_result(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0),
        (6, [0.0, 0.0], 0), (7, [nan, 1.0], 0), (8, [1.0, None], 0), (9, [inf, 1.0], 0), (None, [1.0, 0.0], 0),
        (10, [1.0, 0.0], 0), (10, [1.0, 0.0], 0), (11, [1e30, 1e-30], 0), (12, [1e-30, 0.0], 0),
        (None, [0.0, 1.0], 3), (None, [0.0, 1.0], 3), (13, [-1.0, 0.0], 0),
    ]
    found = embedding_dedup.near_duplicates(vectors(spark, data))
    assert got_of(found) == brute(data, 0.93)
    kept = {r["vec_id"] for r in found.collect() if r["kept"]}
    assert kept == {1, 3, 4, 5, 6, 7, 8, 9, 13, None}
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]


def test_equal_vectors_are_counted_not_compared(spark):
    data = [(i, [1.0, 0.5, 0.25], 7) for i in range(500)] + [(900, [1.0, 0.5, 0.3], 7), (901, [0.0, 0.0, 1.0], 7)]
    found = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(vectors(spark, data)).collect()}
    assert found[17]["n_links"] == 500 and found[900]["n_links"] == 500 and found[901]["n_links"] == 0
    assert {r["component_id"] for r in found.values()} == {0, 901}


def test_core_members_are_linked_for_certain():
    rng = np.random.default_rng(1)
    data = groups(rng, [200, 50, 1, 1], 16, 0.25, 1)
    units = np.array([v for _, v, _ in data], float)
    units /= np.linalg.norm(units, axis=1)[:, None]
    home, guest, core = embedding_dedup.placed(units, embedding_dedup.centres_of(units, 6), 0.9)
    assert core.sum() > 20
    for cell in np.unique(home):
        own = units[(home == cell) & core]
        assert (own @ own.T >= 0.9).all()
    near = units @ units.T >= 0.9
    for i, j in zip(*np.nonzero(near)):
        assert home[i] == home[j] or guest[i, home[j]] or guest[j, home[i]]


def test_an_empty_table_and_a_wrong_bound(spark):
    assert embedding_dedup.near_duplicates(vectors(spark, [])).count() == 0
    with pytest.raises(ValueError):
        embedding_dedup.near_duplicates(vectors(spark, []), 0.0)
