"""Hits against brute force over all windows; phrase and proximity matches."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD_TEXTS, documents, words
from zephyrine.llm import decontaminate

UPPER = {ord(c): c.lower() for c in decontaminate.UPPER}


def split(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain(texts: list, ids: list, items: list[tuple]) -> set[tuple]:
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = split(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    found = set()
    for i, text in zip(ids, texts):
        w = split(text)
        hit, met = set(), set()
        for window, named in windows.items():
            n = len(window)
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) == window:
                    hit.update(range(at, at + n))
                    met |= {str(x) for x in named if x is not None}
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        found.add((i, len(w), len(hit), len(met), digest, bool(hit)))
    return found


def benchmark(spark, items):
    rows = [(i, t, "x", "y") for i, t in items]
    return spark.createDataFrame(rows, "item_id BIGINT, text STRING, window STRING, term STRING")


@pytest.mark.parametrize("seed", [1, 2])
def test_hits_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    items = [(i, words(rng, rng.randrange(8, 40))) for i in range(12)]
    items += [(20, "the"), (21, "Ärger, ärger!"), (22, "a b a b a b a b a b a b a"), (3, items[3][1]), (23, None), (24, "")]
    items += [(None, words(rng, 12)), (25, "the the")]
    texts = []
    for _ in range(50):
        t = words(rng, rng.randrange(0, 60), 90)
        if rng.random() < 0.6:
            piece = split(rng.choice(items)[1])
            at = rng.randrange(max(1, len(piece)))
            t += " " + ", ".join(piece[at : at + rng.randrange(5, 25)]).upper() + " THE! " + words(rng, 3)
        texts.append(t)
    texts += [*ODD_TEXTS, "ärger ÄRGER Ärger ärger", "a b " * 30, "the " * 5]
    ids = list(range(len(texts)))
    got = decontaminate.contamination(documents(spark, texts, ids), benchmark(spark, items)).drop("text_hash")
    assert {tuple(r) for r in got.collect()} == plain(texts, ids, items)


def test_more_terms_than_one_broadcast(spark, monkeypatch):
    rng = random.Random(5)
    items = [(i, words(rng, 15)) for i in range(10)]
    texts = [words(rng, 20) + " " + items[i % 10][1] + " tail" for i in range(20)]
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 3)
    got = decontaminate.contamination(documents(spark, texts), benchmark(spark, items)).drop("text_hash")
    assert {tuple(r) for r in got.collect()} == plain(texts, list(range(20)), items)


def test_proximity_matches(spark):
    window = "alpha beta gamma delta epsilon".split()
    windows = spark.createDataFrame([(7, window)], "window_id BIGINT, window ARRAY<STRING>")
    texts = [
        "x alpha beta gamma delta epsilon y",
        "x beta alpha gamma delta epsilon y",
        "alpha beta and then gamma delta epsilon",
        "alpha beta one two three four gamma delta epsilon",
        "alpha beta gamma delta",
    ]
    _, matches = decontaminate.positional_matches(documents(spark, texts), windows, length=5, slop=2)
    got = {(r["doc_id"], r["exact"]) for r in matches.collect()}
    assert got == {(0, True), (1, False), (2, False)}


def test_repeated_null_and_empty_rows(spark):
    items = [(1, "one two three four five six seven eight nine ten eleven")]
    hit = "zero " + items[0][1]
    docs = documents(spark, [hit, hit, hit, None, "clean"], [4, 4, None, None, 5])
    got = decontaminate.contamination(docs, benchmark(spark, items))
    assert sorted((repr(r["doc_id"]), r["n_hit"]) for r in got.collect()) == [
        ("4", 11), ("4", 11), ("5", 0), ("None", 0), ("None", 11),
    ]
    kept = decontaminate.without_contaminated(docs, benchmark(spark, items))
    assert kept.columns == docs.columns
    assert sorted((repr(r["doc_id"]), r["text"]) for r in kept.collect()) == [("5", "clean"), ("None", None)]
    assert decontaminate.contamination(docs.limit(0), benchmark(spark, items)).count() == 0
    nothing = decontaminate.contamination(docs, benchmark(spark, items).limit(0))
    assert nothing.filter(F.col("contaminated")).count() == 0 and nothing.count() == 5
