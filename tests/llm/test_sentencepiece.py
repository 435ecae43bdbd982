"""Ids against the model's own library, the scan against encoding in one piece, round trips."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD_TEXTS, documents, words
from zephyrine.llm import sentencepiece as pieces_of

pytestmark = pytest.mark.skipif(not os.path.exists(pieces_of.MODEL), reason="no model file")


@pytest.fixture(scope="module")
def pieces():
    return pieces_of.load_pieces()


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces_of.MODEL)


def texts() -> list[str]:
    rng = random.Random(11)
    found = [" " * k + "x" + " " * k for k in range(0, 60, 7)] + ["a" * k for k in range(1, 120, 9)]
    marks = "aeinrst ▁ \n=-*/#xé梦\U0001f600\x00\t\r²."
    for n in (5, 30, 120):
        found += ["".join(rng.choice(marks) for _ in range(n)) for _ in range(60)]
    pool = ["the", "ing", "er", "on", "tion", "____", "----", "  ", " ", "ß", "for", "HELLO", ",", "!!"]
    found += ["".join(rng.choice(pool) for _ in range(n)) for n in (40, 300) for _ in range(30)]
    return found + [words(rng, 400)] + [t for t in ODD_TEXTS if t is not None]


def test_ids_are_those_of_the_library(pieces, library):
    for text in texts():
        assert pieces.encode(text).tolist() == library.encode(text), repr(text)


def test_chunks_give_the_ids_of_the_whole(pieces):
    for text in texts():
        whole = pieces_of.marked(text)
        if len(whole) < 70:
            continue
        for size in (32, 33, 61):
            chunks = list(pieces_of.cut(whole, size, pieces.longest))
            matrices = [pieces_of.transfer(pieces, c) for c in chunks]
            borders = pieces_of.inner_states(matrices, 0, 0)
            packed = b"".join(pieces_of.traced(pieces, c, a, b) for c, (a, b) in zip(chunks, borders))
            assert np.frombuffer(packed, np.int32).tolist() == pieces.encode(text).tolist()


def test_products_are_associative(pieces):
    chunks = list(pieces_of.cut(pieces_of.marked("abcabc" * 60), 32, pieces.longest))
    a, b, c = (pieces_of.transfer(pieces, k) for k in chunks[:3])
    left = pieces_of.product(pieces_of.product(a, b), c)
    assert np.array_equal(left, pieces_of.product(a, pieces_of.product(b, c)))


def test_texts_come_back(pieces):
    for text in texts():
        assert pieces.decode(pieces.encode(text).tolist()) == text.replace("▁", " ")


def test_documents_of_many_chunks(spark, pieces, library):
    rng = random.Random(4)
    giant = [words(rng, 3000), "ab" * 9000, "=" * 5000 + words(rng, 10), "no" + "space" * 900]
    given = [*ODD_TEXTS, *giant, giant[0], "short text"]
    ids = [None, None, *range(2, len(given) - 2), 50, 50]
    got = pieces_of.encode(documents(spark, given, ids), pieces, chunk=40)
    found = {(r["doc_id"], r["text_hash"]): r["ids"] for r in got.collect()}
    hashes = [r[0] for r in documents(spark, given, ids).select(F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    assert got.count() == len(given)
    for i, h, text in zip(ids, hashes, given):
        assert found[i, h] == library.encode(text or ""), repr(text)[:50]
    # 3000 words need a third level of products.
    assert len(giant[0]) // 40 > pieces_of.FAN


def test_round_trip_of_rows(spark, pieces):
    docs = documents(spark, [*ODD_TEXTS, "twice", "twice"], [None, *range(1, len(ODD_TEXTS)), 99, 99])
    got = pieces_of.encode_and_check(docs, pieces).collect()
    assert len(got) == len(ODD_TEXTS) + 2 and all(r["round_trip"] is not False for r in got)
    assert pieces_of.encode_and_check(docs.limit(0), pieces).count() == 0
    tokens = spark.createDataFrame([(1, None), (2, [])], "doc_id BIGINT, ids ARRAY<INT>")
    assert [r["text"] for r in pieces_of.decode(tokens, pieces).orderBy("doc_id").collect()] == [None, ""]


def test_a_chunk_must_hold_pieces(spark, pieces):
    with pytest.raises(ValueError, match="two pieces"):
        pieces_of.encode(documents(spark, ["a"]), pieces, chunk=10)
