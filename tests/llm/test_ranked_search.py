"""Ranked search against scoring every document, in plain Python."""

from __future__ import annotations

import math
import random
import re

import numpy as np

from tests.llm.helpers import ODD_TEXTS, documents, words
from zephyrine.llm import ranked_search

ITEM = "item_id BIGINT, text STRING, rank STRING, score STRING, term STRING"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def items(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "r", "s", "t") for i, t in zip(ids, texts)], ITEM)


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def brute(docs, queries, top):
    """``docs`` and ``queries`` are (id, text) lists."""
    split = [(i, TERM.findall(lowered(t or ""))) for i, t in docs]
    split = [(i, t) for i, t in split if t]
    n, length = len(split), sum(len(t) for _, t in split)
    df: dict[str, int] = {}
    for _, t in split:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    wanted: dict = {}
    for i, t in queries:
        wanted.setdefault(i, set()).update(TERM.findall(lowered(t or "")))
    out = []
    for item, its in wanted.items():
        scored = []
        for i, t in split:
            m = 10 + (90 * len(t) * n) // length
            score = 0
            for w in its & set(t):
                tf = t.count(w)
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                score += weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(scored[:top], 1)]
    return sorted(out, key=repr)


def got_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(rng, n):
    texts = [words(rng, 1 + rng.randrange(60)) for _ in range(n)]
    return texts + [texts[0]] * 40 + ["kalo KALO kalo, Mi", "mi"] + ODD_TEXTS


def test_ranking_equals_scoring_every_document(spark):
    rng = random.Random(4)
    texts = corpus(rng, 300)
    ids = [None, *range(5, len(texts) + 4)]
    questions = [words(rng, 8) for _ in range(12)] + ["Kalo mi", None, "", "?!", "zzz", "word É é", "kalo"]
    numbers = [*range(12), 30, 31, 32, 33, 34, None, 30]
    docs = documents(spark, texts, ids)
    found = ranked_search.rank_documents(docs.repartition(3), items(spark, questions, numbers), top=5)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert got_of(found) == brute(list(zip(ids, texts)), list(zip(numbers, questions)), 5)


def test_blocks_of_items_give_the_same_ranking(spark):
    rng = random.Random(6)
    texts, questions = corpus(rng, 80), [words(rng, 5) for _ in range(9)]
    docs, asked = documents(spark, texts), items(spark, questions)
    assert got_of(ranked_search.rank_documents(docs, asked, block_terms=12)) == got_of(
        ranked_search.rank_documents(docs, asked)
    )


def test_empty_tables_rank_nothing(spark):
    docs, asked = documents(spark, ["kalo mi"]), items(spark, ["kalo"])
    for d, q in ((docs.limit(0), asked), (docs, asked.limit(0)), (documents(spark, [None, "", " "]), asked)):
        found = ranked_search.rank_documents(d, q)
        assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]


def tree_of(rng, n, bucket=4, copies=0):
    ids = [np.array(sorted(rng.sample(range(30), rng.randrange(1, 12)))) for _ in range(n)]
    ids += [ids[0]] * copies
    tfs = [np.array([rng.randrange(1, 9) for _ in i]) for i in ids]
    norms = np.array([rng.randrange(10, 300) for _ in ids])
    return ranked_search.Tree(ids, tfs, norms, bucket), ids, tfs, norms


def test_bounds_hold_for_every_document_below():
    rng = random.Random(8)
    tree, ids, tfs, norms = tree_of(rng, 150, copies=20)

    def below(node):
        _, _, _, members, children = tree.nodes[node]
        return [*members, *[k for c in children for k in below(c)]]

    assert sorted(below(tree.root)) == list(range(170))
    for node, (known, most, norm, _, _) in enumerate(tree.nodes):
        held = dict(zip(known.tolist(), most.tolist()))
        for k in below(node):
            assert norm <= norms[k]
            assert all(held[i] >= t for i, t in zip(ids[k].tolist(), tfs[k].tolist()))


def test_branches_are_left_and_the_best_still_found():
    rng = random.Random(9)
    tree, ids, tfs, norms = tree_of(rng, 2000, 8)
    weights = np.array([w * w for w in range(30)], np.int64)
    item_terms = [np.array(sorted(rng.sample(range(30), 3))) for _ in range(3)]
    searcher = ranked_search.Searcher(item_terms, weights, 4)
    searcher.search(tree, list(range(2000)))
    assert searcher.scored < 2000
    for held, its in zip(searcher.best, item_terms):
        scores = []
        for k in range(2000):
            own = dict(zip(ids[k].tolist(), tfs[k].tolist()))
            score = sum(int(weights[t] * ranked_search.gains(np.int64(own[t]), int(norms[k]))) for t in its if t in own)
            scores.append((score, -k))
        assert sorted(held, reverse=True) == sorted(scores, reverse=True)[:4]


def test_terms_follow_the_stated_classes():
    text = "A-z 0É9_x\x7fé ｗ [b]`c{d}\x00e" + chr(0x80)
    assert [t.decode() for t in ranked_search.terms(text)] == TERM.findall(lowered(text))
    assert ranked_search.terms(None) == []
