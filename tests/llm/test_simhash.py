"""Fingerprints against the definition, links and groups against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import ODD_TEXTS, documents, words
from zephyrine.llm import simhash
from zephyrine.llm.components import connected_components


def plain_fingerprint(text: str | None) -> int:
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints: list[int], ids: list[int]) -> dict[int, int]:
    parent = {i: i for i in range(len(ids))}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least: dict[int, int] = {}
    for i in range(len(ids)):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return {ids[i]: least[root(i)] for i in range(len(ids))}


def test_fingerprints_follow_the_definition():
    rng = random.Random(3)
    texts = [words(rng, n) for n in (1, 2, 3, 4, 50, 300, 600, 2000)] + ["ÄB cd\x0bE", "A b C", "a b c", *ODD_TEXTS]
    for text in texts:
        assert int.from_bytes(simhash.fingerprint(text), "big") == plain_fingerprint(text), text
    assert simhash.fingerprint("A B C D") == simhash.fingerprint("a b\n c\td")


def test_the_hash_is_the_one_spark_has(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("wörd one two"))).first()[0]
    assert value % 2**64 == xxhash.xxh64_intdigest("wörd one two".encode(), 42)


@pytest.mark.parametrize("leaf", [2, 8, 50])
def test_every_link_meets_in_a_leaf(leaf):
    rng = np.random.default_rng(leaf)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64)
    near = [p ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for p in base for a, b in rng.integers(0, 63, (3, 2))]
    points = np.unique(np.concatenate([base, np.array(near, np.uint64)]))
    tree = simhash.VantageTree(points[::5], len(points), 2, leaf)
    at, leaves = tree.place(points)
    homes: dict[int, set] = {}
    for i, k in zip(at.tolist(), leaves.tolist()):
        homes.setdefault(i, set()).add(k)
    assert set(homes) == set(range(len(points)))
    for i in range(len(points)):
        close = np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 2)
        assert all(homes[i] & homes[int(j)] for j in close)


def test_leaf_groups_equal_brute_force():
    rng = np.random.default_rng(1)
    walk = np.cumsum(rng.integers(0, 2, 600)).astype(np.uint64) * np.uint64(2654435761)
    points = np.unique(np.concatenate([walk, np.arange(500, dtype=np.uint64)]))
    labels = simhash.linked(points, 2, compare=64)
    expected = plain_groups([int(p) for p in points], list(range(len(points))))
    assert labels.tolist() == [expected[i] for i in range(len(points))]


def test_groups_of_documents_equal_brute_force(spark):
    rng = random.Random(5)
    texts = [words(rng, rng.randrange(5, 200)) for _ in range(60)]
    for t in list(texts[:30]):
        split = t.split()
        for _ in range(3):
            split[rng.randrange(len(split))] = "changed"
            texts.append(" ".join(split))
    texts += texts[:5] + ["", None, " ", "one", "one"]
    ids = [7 * i % 1009 for i in range(len(texts))]
    found = simhash.near_duplicates(documents(spark, texts, ids), leaf_rows=8)
    got = {r["doc_id"]: (r["fp"] % 2**64, r["component_id"]) for r in found.collect()}
    prints = [plain_fingerprint(t) for t in texts]
    groups = plain_groups(prints, ids)
    assert got == {i: (p, groups[i]) for i, p in zip(ids, prints)}


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 200), (None, 3)]
    rng = random.Random(2)
    rng.shuffle(edges)
    found = connected_components(spark.createDataFrame(edges * 2, "a BIGINT, b BIGINT"))
    got = {r["node"]: r["component"] for r in found.collect()}
    assert {n: c for n, c in got.items() if n < 100} == {n: 0 for n in range(1, 41)}
    assert all(got[k] == 100 for k in range(101, 140))
    assert connected_components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def test_odd_rows_and_one_document_per_group(spark):
    docs = documents(spark, [None, "", "x y z w", "x y z w", "x y z w", "other words here now"], [5, 3, None, 9, 9, None])
    found = simhash.near_duplicates(docs)
    got = {(r["doc_id"], r["component_id"]) for r in found.collect()}
    assert got == {(5, 3), (3, 3), (None, 9), (9, 9), (None, None)} and found.count() == 6
    kept = simhash.first_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [
        (False, 3, ""), (False, 9, "x y z w"), (True, 0, "other words here now"),
    ]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.first_of_each_group(docs.limit(0)).count() == 0
