"""Statistics against the definition; estimates against planted outliers."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import ODD_TEXTS, documents, words
from zephyrine.llm import outliers


def plain(text: str | None) -> tuple:
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    n = len(found)
    return (
        n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated),
        n < 50 or 100 * len(repeated) > 50 * n,
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_statistics_follow_the_definition(spark):
    rng = random.Random(1)
    texts = [words(rng, n, 3) for n in (3, 49, 50, 51, 200, 2000)] + [*ODD_TEXTS, "a b c a b c", "a a a a", "x y z " * 40]
    texts += ["l1 é#\n\nl1 é#\n l1 é#\n \n \n", "a|b <c> & $%*#" * 20, words(rng, 30) + "\n" + words(rng, 30)]
    got = outliers.judge(documents(spark, texts)).collect()
    assert {(r["doc_id"], *[r[n] for n in NAMES]) for r in got} == {(i, *plain(t)) for i, t in enumerate(texts)}
    # Few rows are judged too, held against all of them.
    assert all(r["distance"] is not None and r["kept"] == (r["distance"] <= 40) for r in got if not r["base_failed"])
    assert not any(r["kept"] for r in got if r["base_failed"])


def clean(rng: random.Random) -> str:
    n = rng.randrange(60, 200)
    return "\n".join(words(rng, 12) for _ in range(n // 12 + 1))


def test_outliers_of_a_group_are_rejected_and_clean_rows_stay(spark):
    rng = random.Random(2)
    texts = [clean(rng) for _ in range(400)]
    junk = [re.sub(r" ", "%%% ", clean(rng)) for _ in range(60)]
    langs = ["en"] * 200 + [None] * 200 + ["en"] * 30 + [None] * 30
    got = outliers.judge(documents(spark, texts + junk, langs=langs), pool_rows=100).orderBy("doc_id").collect()
    assert all(r["kept"] for r in got[:400])
    assert not any(r["kept"] for r in got[400:])


def test_estimates_resist_a_quarter_of_outliers(spark):
    rng = np.random.default_rng(3)
    good = rng.multivariate_normal([1.0, 2.0], [[1.0, 0.6], [0.6, 1.0]], 900)
    bad = rng.multivariate_normal([9.0, -9.0], [[0.1, 0], [0, 0.1]], 200)
    rows = [(i, "p", float(a), float(b)) for i, (a, b) in enumerate(np.vstack([good, bad]))]
    frame = spark.createDataFrame(rows, "i INT, pool STRING, x DOUBLE, y DOUBLE")
    told = outliers.robust_distances(
        frame, ["x", "y"], [0.01, 0.01], F.xxhash64("i"), frame, median=1.386
    )
    got = np.array([r["d2"] for r in told.orderBy("i").collect()])
    centred = good - good.mean(axis=0)
    exact = np.einsum("ij,jk,ik->i", centred, np.linalg.inv(np.cov(good.T)), centred)
    assert got[900:].min() > 50 and got[:900].max() < 30
    assert np.corrcoef(got[:900], exact)[0, 1] > 0.97


def test_salted_groups_give_the_same_distances(spark, monkeypatch):
    rng = random.Random(4)
    docs = documents(spark, [clean(rng) for _ in range(120)], sources=["a", "b"] * 60)
    columns = ["doc_id", "kept", F.round("distance", 6).alias("distance")]
    plain_join = sorted(map(tuple, outliers.judge(docs, pool_rows=20).select(*columns).collect()))
    monkeypatch.setattr(outliers, "BROADCAST_GROUPS", 0)
    assert sorted(map(tuple, outliers.judge(docs, pool_rows=20).select(*columns).collect())) == plain_join


def test_odd_rows(spark):
    docs = documents(spark, [None, "", "a b", "a b"], [None, 1, 2, 2], [None, "en", "en", "en"], [None, None, "s", "s"])
    got = outliers.judge(docs)
    assert got.count() == 4 and got.filter("kept").count() == 0
    assert outliers.judge(docs.limit(0)).count() == 0


def test_rows_of_rare_languages_are_judged_against_all(spark):
    rng = random.Random(6)
    texts = [clean(rng) for _ in range(220)]
    junk = [re.sub(r" ", "%%% ", clean(rng)) for _ in range(6)]
    langs = ["en"] * 200 + ["de"] * 12 + ["fr"] * 8 + ["de", "fr", None, "en", "xx", "xy"]
    got = outliers.judge(documents(spark, texts + junk, langs=langs), pool_rows=100).orderBy("doc_id").collect()
    assert all(r["distance"] is not None for r in got)
    assert [r["kept"] for r in got] == [True] * 220 + [False] * 6


def test_one_row_and_equal_rows_are_kept(spark):
    text = clean(random.Random(7))
    for n in (1, 2, 7):
        got = outliers.judge(documents(spark, [text] * n)).collect()
        assert len(got) == n and all(r["kept"] and r["distance"] < 1e-9 for r in got)
