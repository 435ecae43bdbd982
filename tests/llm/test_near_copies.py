"""Near copies against all pairs of exact shingle sets."""

from __future__ import annotations

import random

import numpy as np

import corpus_pipeline
from tests.llm.helpers import ODD_TEXTS, documents, words
from zephyrine.llm import near_copies


def plain_set(text: str | None) -> frozenset:
    found = (text or "").lower().split()
    return frozenset(" ".join(found[i : i + 5]) for i in range(max(1, len(found) - 4)))


def share(a: str | None, b: str | None) -> float:
    one, two = plain_set(a), plain_set(b)
    return len(one & two) / len(one | two)


def variants(rng: random.Random, n: int, copies: int) -> list[str]:
    texts = []
    for _ in range(n):
        base = words(rng, 200).split()
        for _ in range(copies):
            changed = list(base)
            for _ in range(rng.randrange(1, 4)):
                changed[rng.randrange(200)] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(changed))
    return texts


def test_the_stage_takes_out_near_copies(spark):
    """No two near copies stay, and each document that goes has an earlier near copy."""
    rng = random.Random(4)
    texts = variants(rng, 30, 4) + [words(rng, 150) for _ in range(20)]
    ids = rng.sample(range(10_000), len(texts))
    docs = documents(spark, texts, ids)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    stay = {r["doc_id"] for r in kept.collect()}
    rows = sorted(zip(ids, texts))
    near = [(i, j) for k, (i, a) in enumerate(rows) for j, b in rows[k + 1 :] if share(a, b) >= 0.8]
    assert len(near) > 50 and not [p for p in near if stay.issuperset(p)]
    assert set(ids) - stay <= {j for _, j in near}


def test_a_large_group_is_compared_in_rounds(spark):
    rng = random.Random(8)
    texts = variants(rng, 2, 60)
    stay = {r["doc_id"] for r in near_copies.first_of_near_copies(documents(spark, texts)).collect()}
    pairs = [(i, j) for j in range(120) for i in range(j) if share(texts[i], texts[j]) >= 0.8]
    assert not [p for p in pairs if stay.issuperset(p)]
    assert set(range(120)) - stay <= {j for _, j in pairs}


def test_copies_and_odd_rows(spark):
    texts = [None, "", "x y z w", "X y z w", "x y z w", "other words here now", *ODD_TEXTS]
    ids = [5, 3, None, 9, 9, None, *range(20, 20 + len(ODD_TEXTS))]
    got = near_copies.first_of_near_copies(documents(spark, texts, ids)).select("doc_id", "text").collect()
    found = [(r["doc_id"], r["text"]) for r in got if r["doc_id"] is None or r["doc_id"] < 20]
    assert len(found) == 3 and (3, "") in found and (None, "other words here now") in found
    assert sum(r["text"] == "word" for r in got) == 1
    empty = documents(spark, texts, ids).limit(0)
    assert near_copies.first_of_near_copies(empty).count() == 0


def template_pages(rng: random.Random, n: int, own: int = 16) -> list[str]:
    """Pages of 120 words of which ``own`` at their end are their own: similar at about 0.75."""
    frame = words(rng, 120 - own)
    return [frame + " " + " ".join(f"own{rng.randrange(10**9)}" for _ in range(own)) for _ in range(n)]


def test_pages_of_a_template_are_not_compared_in_pairs(spark, monkeypatch):
    compared = []
    told = near_copies._told

    def counting(pairs, sets, similarity):
        compared.append(pairs.count())
        return told(pairs, sets, similarity)

    monkeypatch.setattr(near_copies, "_told", counting)
    sizes = {}
    for n in (200, 400):
        texts = template_pages(random.Random(n), n)
        assert 0.7 < share(texts[0], texts[1]) < 0.8
        compared.clear()
        assert near_copies.first_of_near_copies(documents(spark, texts)).count() == n
        sizes[n] = sum(compared)
    assert sizes[400] < 2.2 * sizes[200] and sizes[400] < 400 * 25


def test_similar_sets_share_a_rare_key():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 5, 64)
    for _ in range(400):
        n, m = rng.integers(1, 60, 2)
        common = int(rng.integers(0, min(n, m) + 1))
        pool = rng.choice(10**9, n + m - common, replace=False).astype(np.uint64)
        a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:common], pool[n:]]))
        for least in (0.5, 0.8, 0.95):
            if near_copies.similar(a, b, least):
                one, two = (
                    set(zip(*(v.tolist() for v in near_copies.prefix_keys(x, counts, least)))) for x in (a, b)
                )
                assert any((key, -side) in two for key, side in one), (n, m, common, least)
