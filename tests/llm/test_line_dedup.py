"""Dropped lines against brute force over all pairs of lines."""

from __future__ import annotations

import random

import pytest

from tests.llm.helpers import ODD_TEXTS, documents, words
from zephyrine.llm import line_dedup


def one_edit(a: str, b: str) -> bool:
    if a == b:
        return True
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(texts: list, ids: list, least: int) -> set[tuple]:
    lines = [
        ((i is None, i or 0), n, line, i)
        for i, t in zip(ids, texts)
        if t is not None
        for n, line in enumerate(t.split("\n"))
        if line.strip(" \t\n\v\f\r")
    ]
    long = [x for x in lines if len(x[2]) >= least]
    lines.sort(key=lambda x: x[:2])
    long.sort(key=lambda x: x[:2])
    found = set()
    for k, (_, n, line, i) in enumerate(lines):
        equal = next((x for x in lines[:k] if x[2] == line), None)
        # A copy counts as exact; the first of equal lines may be near an earlier one.
        earlier = [x for x in long if x[2] != line and x[:2] < first(lines, line)[:2]] if len(line) >= least else []
        near = next((x for x in earlier if one_edit(x[2], line)), None)
        if equal:
            found.add((i, n, "exact", equal[3], equal[1]))
        elif near:
            found.add((i, n, "near", near[3], near[1]))
    return found


def first(lines: list, line: str) -> tuple:
    return next(x for x in lines if x[2] == line)


def edited(rng: random.Random, line: str) -> str:
    at = rng.randrange(len(line) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return line[:at] + rng.choice("xyzé") + line[at:]
    at = min(at, len(line) - 1)
    return line[:at] + (rng.choice("xyz") if kind == 1 else "") + line[at + 1 :]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lines_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [words(rng, rng.randrange(2, 30)) for _ in range(25)] + ["a" * k for k in (19, 20, 21, 22, 23, 300)]
    pool += ["item number 1234567", "item number 1234568", "item number 1234569", "item number 123456"]
    for line in list(pool):
        pool += [edited(rng, line), edited(rng, edited(rng, line))]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 8))) for _ in range(40)]
    ids = rng.sample(range(1000), len(texts))
    got = line_dedup.repeated_lines(documents(spark, texts, ids), min_chars=12).drop("text_hash")
    assert {tuple(r) for r in got.collect()} == plain(texts, ids, 12)


def test_long_lines_use_wide_segments(spark):
    rng = random.Random(9)
    long = words(rng, 3000)
    texts = [long, long[:9000] + "q" + long[9000:], long[:-1], long[1:], long + "!", long[:50] + "##" + long[52:]]
    got = line_dedup.repeated_lines(documents(spark, texts)).drop("text_hash")
    assert {tuple(r) for r in got.collect()} == plain(texts, list(range(6)), 20)


def test_many_lines_of_one_template(spark):
    """Lines that share a half and a variant: a large group, one witness each."""
    texts = [f"the same long beginning of a line, then {i:05d}" for i in range(300)]
    got = line_dedup.repeated_lines(documents(spark, texts)).drop("text_hash")
    assert {tuple(r) for r in got.collect()} == plain(texts, list(range(300)), 20)


def test_texts_without_their_repeated_lines(spark):
    line, other = "a line that is long enough", "another line, long enough too"
    texts = [f"{line}\n\nshort\n{other}", f"{other}\nshort\n\nmy own words are long enough", line, None, "", "short", line]
    ids = [1, 2, 3, 4, None, 5, 3]
    docs = documents(spark, texts, ids)
    kept = line_dedup.without_repeated_lines(docs)
    assert kept.columns == docs.columns
    got = sorted((repr(r["doc_id"]), r["text"]) for r in kept.collect())
    assert got == [
        ("1", texts[0]), ("2", "\nmy own words are long enough"), ("4", None), ("None", ""),
    ]


def test_odd_rows(spark):
    docs = documents(spark, [*ODD_TEXTS, "word " * 9, "word " * 9], [None, *range(1, len(ODD_TEXTS)), 50, 50])
    got = line_dedup.repeated_lines(docs)
    found = [(r["doc_id"], r["kept_doc_id"]) for r in got.collect()]
    assert found == [(7, 6)]  # a repeated word; rows equal in id and text are one document
    assert line_dedup.repeated_lines(docs.limit(0)).count() == 0
    assert line_dedup.without_repeated_lines(docs).count() == docs.count() - 1
