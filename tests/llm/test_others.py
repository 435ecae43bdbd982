"""Toxicity, sharding, chunks, URL rules, the classifier and the pipeline."""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHING, DOCUMENT, ODD_TEXTS, documents, words
from zephyrine.llm import chunk_dedup, common, factorisation, sharding, toxicity, url_filter

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


# --- toxicity ------------------------------------------------------------------------------


def model_of(text: str) -> list:
    import pandas as pd

    codes, counts = np.unique(toxicity.trigram_codes(text), return_counts=True)

    class Counts:
        def toPandas(self):
            return pd.DataFrame({"code": codes, "n": counts})

    return toxicity.language_model(Counts()).tolist()


def test_disguised_words_are_restored():
    rng = random.Random(1)
    model = model_of(words(rng, 4000) + " idiot stupid moron loser scum " * 60)
    disguises = {
        "idiot": ["1d10t", "i.d.i.o.t", "idiooot", "!d!ot", "iiidiot", "i-d-i-o-t", "id1ot!!!", "idiot***"],
        "stupid": ["5tup1d", "$tupid", "sstupid", "st.up.id", "stuuuupid"],
        "moron": ["m0r0n", "m.o.r.o.n", "mo_ron"],
        "scum": ["$cum", "scuuum", "s-c-u-m"],
    }
    for word, forms in disguises.items():
        for form in forms:
            assert toxicity.words_of(form, model) == [word], form
    assert [toxicity.words_of(r, model, True) for r in toxicity.spaced_runs("an i d i o t, l o s e r!")] == [
        ["idiot"], ["loser"],
    ]
    for text in ("so i  d  i  o  t", "i\td\ti\to\tt x1y", "i \n d i o  t"):
        assert [toxicity.words_of(r, model, True) for r in toxicity.spaced_runs(text)] == [["idiot"]], text
    for form, word in (
        ("iidiiott", "idiot"), ("loosser", "loser"), ("i---d---i---o---t", "idiot"), ("m***o***r***o***n", "moron"),
        ("4$$", None), ("70$3|2", None), ("!!!moron$$$", "moron"),
    ):
        found = toxicity.words_of(form, model)
        assert found == [word] if word else found, form
    for word in ("plain", "straße", "汉字", "о"):
        assert toxicity.words_of(word, model) == [word]
    assert toxicity.words_of("12345", model) == [] and toxicity.words_of("?!", model) == []


def test_the_decoder_finds_the_best_path():
    """Viterbi against all readings of short tokens."""
    rng = random.Random(2)
    model = model_of(words(rng, 3000))

    def best(token: str) -> float:
        def readings(runs):
            if not runs:
                yield "", 0.0
                return
            (char, run), *rest = runs
            for text, cost in toxicity._options(char, run, False):
                for tail, more in readings(rest):
                    yield text + tail, cost + more

        scores = []
        for text, cost in readings(list(toxicity._runs(token))):
            a = b = 0
            score = -cost
            for c in text + " ":
                k = 0 if c == " " else toxicity._CLASS[c]
                if k or b:
                    score += model[a][b][k]
                a, b = (0, 0) if not k else (b, k)
            scores.append((score, text.split()))
        return max(scores)

    for token in ("k4lo", "m1ren", "0r", "v3l.an", "tuss", "p@@r4", "|sh"):
        assert toxicity.restore(token, model) == best(token)[1], token


def toxic_corpus(spark, n=240):
    rng = random.Random(3)
    texts, labels = [], []
    for i in range(n):
        t = words(rng, 40)
        toxic = i % 6 == 0
        texts.append(t + (" moron " if toxic else " ") + words(rng, 5))
        labels.append((i, int(toxic)))
    frame = spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")
    return documents(spark, texts), frame


def test_scores_tell_disguised_insults(spark):
    docs, labels = toxic_corpus(spark)
    scorer = toxicity.fit(docs, labels)
    assert scorer.score("so m0r0n it is") > 0.5 and scorer.score("a m o r o n") > 0.5
    assert scorer.score("kalo mirenor") < 0.5 and scorer.score(None) == scorer.score("") == scorer.base
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    got = {r["doc_id"] for r in kept.collect()}
    assert not got & set(range(0, 240, 6)) and len(got) == 200


def test_toxicity_without_labels_and_odd_rows(spark):
    docs = documents(spark, ODD_TEXTS, [None, *range(1, len(ODD_TEXTS))])
    none = spark.createDataFrame([], "doc_id BIGINT, toxic INT")
    scorer = toxicity.fit(docs, none)
    assert {r["score"] for r in toxicity.score(docs.drop("score"), scorer).collect()} == {0.0}
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0)], "doc_id BIGINT, toxic INT")
    assert toxicity.fit(docs, odd).base == 1.0
    assert toxicity.fit(docs.limit(0), none).score("x") == 0.0


def test_trigrams_are_counted_over_every_text(spark):
    texts = ["ab c", "ab", None, "ÄB", "x" * 60_000]
    got = toxicity.trigram_counts(documents(spark, texts)).agg(F.sum("n")).first()[0]
    assert got == sum(len(t) + 1 for t in texts if t)


# --- sharding ------------------------------------------------------------------------------


def test_shards_are_near_equal_gapless_and_keep_copies(spark):
    rng = random.Random(5)
    texts = [words(rng, rng.randrange(1, 400)) for _ in range(600)] + ["copy of a text"] * 300 + [None, "", ""]
    sources = [f"s{rng.randrange(9)}" if rng.random() < 0.6 else "hot" for _ in texts]
    langs = [rng.choice(["en", "de", None]) for _ in texts]
    docs = documents(spark, texts, [None, *range(1, len(texts))], langs, sources)
    got = sharding.shards(docs, leaves=24).collect()
    assert len(got) == len(texts)
    total = sum(len((t or "").encode()) + 8 for t in texts)
    largest = max(len((t or "").encode()) + 8 for t in texts)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r)
    assert sorted(by_shard) == list(range(24))
    for rows in by_shard.values():
        assert abs(sum(r["size"] for r in rows) - total / 24) <= 2 * largest
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    sizes = {i: len((t or "").encode()) + 8 for i, t in enumerate(texts) if i}
    assert all(r["size"] == sizes[r["doc_id"]] for r in got if r["doc_id"])
    assert {r["text_crc32"] for r in got if r["size"] == 8} == {0}
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in got if r["doc_id"] and r["size"] > 8)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}


def test_copies_stay_together_and_placement_repeats(spark):
    rng = random.Random(6)
    texts = [words(rng, 50) for _ in range(120)] * 2
    docs = documents(spark, texts, sources=["a"] * 120 + ["b"] * 120)
    first = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shards(docs, leaves=6).collect()}
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shards(docs.repartition(5), leaves=6).collect()}
    assert first == again
    assert sum(first[i][0] != first[i + 120][0] for i in range(120)) <= 6


def test_target_bytes_and_odd_tables(spark):
    docs = documents(spark, ["x" * 92] * 10)
    got = sharding.shards(docs, target_bytes=250)
    assert sorted(r["count"] for r in got.groupBy("shard").count().collect()) == [2, 2, 3, 3]
    assert sharding.shards(docs.limit(0), leaves=3).count() == 0
    assert sharding.shards(docs.limit(1), leaves=3).count() == 1
    with pytest.raises(ValueError):
        sharding.shards(docs)


def test_equal_rows_are_spread_over_shards_and_blocks(spark):
    rng = random.Random(12)
    texts = [None] * 1500 + [words(rng, 6) for _ in range(500)] + ["same"] * 500
    ids = [None] * 1500 + list(range(500)) + [7] * 500
    docs = documents(spark, texts, ids, langs=["en"] * 2500).repartition(4)
    got = sharding.shards(docs, leaves=5)
    sizes = {r["shard"]: r["total"] for r in got.groupBy("shard").agg(F.sum("size").alias("total")).collect()}
    mean = sum(sizes.values()) / 5
    assert len(sizes) == 5 and max(abs(v - mean) for v in sizes.values()) < 0.05 * mean
    placed = sharding.shard(common.written(sharding.document_rows(docs), "t"), 2, 3)
    numbered = sharding.numbered(common.written(placed, "t"), block_rows=20).collect()
    for shard in (0, 1):
        slots = sorted(r["slot"] for r in numbered if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert len({(r["block"], r["part"]) for r in numbered if r["doc_id"] is None}) > 5


def test_slots_of_many_blocks(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.lit(1).alias("text_hash"), (F.col("id") % 2).cast("int").alias("shard"),
        F.xxhash64("id").alias("salt"),
    )
    got = sharding.numbered(rows, block_rows=100)
    for shard in (0, 1):
        assert sorted(r["slot"] for r in got.filter(F.col("shard") == shard).collect()) == list(range(2500))


# --- chunks --------------------------------------------------------------------------------


def test_gear_hashes_follow_the_definition():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 300, dtype=np.uint8)
    got = chunk_dedup.gear_hashes(data)
    for i in (0, 1, 5, 15, 16, 200, 299):
        expected = sum(int(chunk_dedup._GEAR[data[i - k]]) << k for k in range(min(16, i + 1))) % 2**32
        assert int(got[i]) == expected


def test_chunks_cover_whole_characters_and_have_bounds():
    rng = random.Random(7)
    for text in [*filter(None, ODD_TEXTS), words(rng, 3000), "é汉\U0001f600" * 700, "a" * 5000]:
        data = text.encode()
        ends = chunk_dedup.chunk_ends(data)
        sizes = np.diff([0, *ends])
        assert ends[-1] == len(data) and sizes.max() <= chunk_dedup.MOST + 3
        assert all(s >= chunk_dedup.LEAST for s in sizes[:-1])
        "".join(data[i:j].decode() for i, j in zip([0, *ends], ends))
    assert chunk_dedup.chunk_ends(b"") == []


def test_an_insertion_moves_chunks_but_keeps_them():
    data = words(random.Random(8), 2000).encode()
    cut = lambda d: {d[i:j] for i, j in zip([0, *chunk_dedup.chunk_ends(d)], chunk_dedup.chunk_ends(d))}
    moved = cut(data[:5000] + b"something new" + data[5000:])
    assert len(cut(data) - moved) <= 5


def test_shared_passages_are_found_and_clean_texts_left(spark):
    rng = random.Random(9)
    passages = [words(rng, 55) for _ in range(30)]
    texts = [f"{words(rng, 60)} {p} {words(rng, 40)}" for p in passages for _ in range(3)]
    clean = [words(rng, 100) for _ in range(60)]
    docs = documents(spark, texts + clean)
    spans = chunk_dedup.copied_spans(docs).collect()
    caught = {r["doc_id"] for r in spans}
    expected = {3 * k + i for k in range(30) for i in (1, 2)}
    assert len(caught & expected) >= 59 and caught <= expected
    for r in spans:
        data = texts[r["doc_id"]].encode()[r["start"] : r["start"] + r["size"]]
        assert texts[r["first_doc_id"]].encode()[r["first_start"] : r["first_start"] + r["size"]] == data
        assert r["doc_id"] // 3 * 3 <= r["first_doc_id"] < r["doc_id"]
    kept = chunk_dedup.without_copied_spans(docs)
    assert kept.columns == docs.columns and kept.count() == 150
    left = {r["doc_id"]: r["text"] for r in kept.collect()}
    cut = {}
    for r in spans:
        cut.setdefault(r["doc_id"], []).append((r["start"], r["size"]))
    for i, text in enumerate(texts + clean):
        data = text.encode()
        for start, size in sorted(cut.get(i, []), reverse=True):
            data = data[:start] + data[start + size :]
        assert left[i] == data.decode()


def plain_spans(texts: list[str], least: int) -> set[tuple]:
    """Runs of chunks seen before whose neighbours were seen side by side before."""
    seen, pairs, out = set(), set(), set()
    for i, text in enumerate(texts):
        data, ends, run, before = text.encode(), chunk_dedup.chunk_ends(text.encode()), None, None
        for begin, end in zip([0, *ends[:-1]], ends):
            chunk = data[begin:end]
            if chunk in seen and run and before is not None and (before, chunk) in pairs:
                run[1] = end
            else:
                if run and run[1] - run[0] >= least:
                    out.add((i, run[0], run[1] - run[0]))
                run = [begin, end] if chunk in seen else None
            seen.add(chunk)
            pairs.add((before, chunk))
            before = chunk
        if run and run[1] - run[0] >= least:
            out.add((i, run[0], run[1] - run[0]))
    return out


def test_spans_equal_brute_force_and_chance_makes_none(spark):
    rng = random.Random(21)
    texts = [words(rng, rng.randrange(20, 120)) for _ in range(60)]
    passage = words(rng, 60)
    for k in range(0, 60, 4):
        texts[k] += " " + passage + " " + words(rng, 5)
    pieces = []
    for text in texts[:40]:  # chunks of many documents, one after another
        ends = chunk_dedup.chunk_ends(text.encode())
        at = rng.randrange(1, len(ends) - 1)
        pieces.append(text.encode()[ends[at - 1] : ends[at]].decode("utf-8", "ignore"))
    texts += ["".join(pieces[k : k + 8]) for k in range(0, 40, 8)] + [texts[3] + texts[5], texts[8][100:]]
    texts += [texts[1] + texts[1], passage[:50] + passage]
    got = chunk_dedup.copied_spans(documents(spark, texts), 60)
    found = {(r["doc_id"], r["start"], r["size"]) for r in got.collect()}
    assert found == plain_spans(texts, 60) and len(found) > 15


def test_chunks_of_odd_rows(spark):
    whole = words(random.Random(10), 100)
    docs = documents(spark, [*ODD_TEXTS, whole, whole, whole, whole], [None, *range(1, len(ODD_TEXTS)), 90, 90, 91, None])
    got = chunk_dedup.copied_spans(docs).collect()
    # The whole text is one span of each later document; equal rows are one document.
    assert sorted((repr(r["doc_id"]), r["start"], r["size"], r["first_doc_id"]) for r in got) == [
        ("91", 0, len(whole), 90), ("None", 0, len(whole), 90),
    ]
    assert chunk_dedup.copied_spans(docs.limit(0)).count() == 0
    assert {r["text"] for r in chunk_dedup.without_copied_spans(docs).filter("doc_id = 91").collect()} == {""}


# --- URL rules -----------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame(
        [(i, u, h, "x", "y") for i, u, h in rows], "page_id BIGINT, url STRING, html STRING, host STRING, own STRING"
    )


def test_hosts_paths_and_rules(spark):
    urls = {
        "http://a.example.com/x": ("a.example.com", "/x", "com/", "allow"),
        "https://EXAMPLE.com/en/1?q#f": ("example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://m.www.example.com/en/a": ("m.www.example.com", "/en/a", "www.example.com/en/", "allow"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://x.net/es/": ("x.net", "/es/", "net/es/", "block"),
        "http://x.net/ES/": ("x.net", "/ES/", None, "allow"),
        "http://x.com": ("x.com", "", None, "allow"),
        "http://x.org?a=/b": ("x.org", "", None, "allow"),
        "no address": ("", "", None, "allow"),
        "://h.net/fr/x": ("h.net", "/fr/x", "net/fr/", "block"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u, None) for i, u in enumerate(urls)]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages(spark, rows)).collect()}
    assert got == dict(enumerate(urls.values()))


def test_blocks_reach_aliases_and_allowing_comes_first(spark):
    def canonical(to):
        return f"<html><HEAD><link href='{to}' rel=\"canonical\"></head>"

    rows = [
        (0, "http://a.net/es/1", ""),  # blocked by rule
        (1, "http://b.org/1", canonical("http://a.net/es/1")),
        (2, "http://b.org/2", '<meta http-equiv="refresh" content="0; url=/1">'),
        (3, "http://b.org/3", None),
        (4, "https://b.org/1#part", None),  # the plain form of page 1
        (5, "http://c.org/5", canonical("http://c.net/fr/5")),
        (6, "http://c.net/fr/5", canonical("http://c.com/5")),  # blocked, but an alias is allowed
        (7, "http://c.com/5", ""),
        (8, "http://d.org/8?utm_source=x&a=1", None),
        (9, "http://d.org/8/?a=1", canonical("//e.net/es/9")),
        (10, "http://far.org/", None),
    ]
    redirects = spark.createDataFrame([("http://far.org", "http://b.org/2")], "from_url STRING, to_url STRING")
    found = url_filter.judge(pages(spark, rows), redirects=redirects)
    verdicts = {r["page_id"]: r["verdict"] for r in found.collect()}
    blocked = {i for i, v in verdicts.items() if v == "block"}
    # Page 9 links to a blocked address no page has; only judged pages block.
    assert blocked == {0, 1, 2, 4, 6, 10}
    assert url_filter.judge(pages(spark, rows).limit(0)).count() == 0
    twice = pages(spark, rows[:2] * 2 + [(None, "http://b.org/1", None)])
    assert sorted(r["verdict"] for r in url_filter.judge(twice).collect()) == ["block"] * 5


@pytest.mark.parametrize(
    "page",
    ["http://a.org/x/y.html?q=1#f", "https://b.net", "http://c.com/", "http://d.org/a/b/c/", "HTTP://E.org/p;q/r"],
)
def test_targets_resolve_by_the_usual_rules(spark, page):
    from urllib.parse import urljoin

    targets = [
        "next.html", "../a", "../../../z", "./", ".", "..", "../", "?id=2", "/r/./s/../t", "//h.org/k?x", "g;x=1/../y",
        "https://t.org/u/../v", "/login?next=http://x/", "a/b/../../c/", "/", "sub/?a=b&amp;c=d", " spaced ", "/..",
    ]
    rows = spark.createDataFrame([(page, t) for t in targets], "url STRING, target STRING")
    got = rows.select("target", url_filter.resolved(F.col("target"), F.col("url")).alias("to")).collect()
    scheme = page.split(":")[0]
    for r in got:
        plain = r["target"].replace("&amp;", "&").strip()
        if "://" in plain.split("?")[0]:
            assert r["to"] == plain  # an absolute address stays as it is written
            continue
        expected = urljoin(page.replace(scheme, "http", 1), plain).replace("http", scheme, 1)
        assert r["to"].rstrip("/") == expected.rstrip("/"), (page, r["target"])


def test_every_link_form_of_a_page_is_an_edge(spark):
    blocked = "http://a.net/es/1"
    forms = {
        "quoted": f"<meta content=\"0; url='{blocked}'\" http-equiv=refresh>",
        "double": f"<META HTTP-EQUIV='Refresh' CONTENT='5;URL=\"{blocked}\"'>",
        "bare": f"<meta http-equiv=refresh content=0;url={blocked}>",
        "no name": f'<meta http-equiv="refresh" content="0; {blocked}">',
        "second": f'<link rel="canonical" href="http://own.org/"><link rel="canonical" href="{blocked}">',
        "many": f'<link rel="alternate canonical" title="a > b" href={blocked} />',
        "broken": f"<link\nrel='canonical'\nhref='{blocked}'\n>",
    }
    others = {
        "other": f'<link rel="stylesheet" href="{blocked}">',
        "data": f'<link rel="canonical" data-href="{blocked}" href="http://mine.org/">',
        "name": f'<meta name="refresh" content="0; url={blocked}">',
    }
    rows = [(0, blocked, "")]
    rows += [(k, f"http://p{k}.org/", html) for k, html in enumerate([*forms.values(), *others.values()], 1)]
    rows += [(50, "http://a.net/es/x/p.html", ""), (51, "http://q.org/1", '<link rel=canonical href="../2?u=http://x">')]
    rows += [(52, "http://q.org/2?u=http://x", '<meta http-equiv=refresh content="0;url=//a.net/es/x/p.html">')]
    verdicts = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages(spark, rows)).collect()}
    assert {i for i, v in verdicts.items() if v == "block"} == {*range(len(forms) + 1), 50, 51, 52}


# --- the classifier ------------------------------------------------------------------------


def test_margins_equal_the_sum_over_all_pairs():
    rng = np.random.default_rng(1)
    inputs = factorisation.Inputs(16)
    width = 16 + len(factorisation.STATISTICS)
    machine = factorisation.Machine(
        inputs, 0.3, rng.normal(size=width), rng.normal(size=(width, 4)),
        np.zeros(width - 16), np.ones(width - 16),
    )
    positions, values = machine.arrange(*inputs.of("some words, some WORDS | and 12 more\nsome words"))
    pairs = sum(
        machine.vectors[i] @ machine.vectors[j] * x * y
        for a, (i, x) in enumerate(zip(positions, values))
        for j, y in list(zip(positions, values))[a + 1 :]
    )
    expected = 0.3 + machine.weights[positions] @ values + pairs
    assert machine.margin(positions, values) == pytest.approx(expected)


def test_the_machine_learns_and_scores_odd_rows(spark):
    rng = random.Random(11)
    texts = [words(rng, 60) if i % 2 else words(rng, 6) + " ###" * 40 for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)], "doc_id BIGINT, quality INT")
    docs = documents(spark, texts)
    machine = factorisation.fit(docs, labels)
    assert np.mean([(machine.score(t) >= 0.5) == bool(i % 2) for i, t in enumerate(texts[150:], 150)]) > 0.95
    assert machine.score(texts[1]) == factorisation.fit(docs.repartition(7), labels).score(texts[1])
    scored = factorisation.score(documents(spark, ODD_TEXTS).drop("score"), machine).collect()
    assert len(scored) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in scored)
    none = factorisation.fit(docs, labels.limit(0))
    assert none.score("x") == pytest.approx(0.5, abs=0.2) or 0 <= none.score("x") <= 1
    assert factorisation.score(docs.drop("score").limit(0), machine).count() == 0


def test_samples_are_bounded_and_repeat(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    drawn = common.hashed_sample(rows, "doc_id", 20_000, 500)
    assert 350 < drawn.count() < 650
    assert drawn.exceptAll(common.hashed_sample(rows.repartition(3), "doc_id", 20_000, 500)).count() == 0
    assert common.hashed_sample(rows, "doc_id", 20_000, 20_000).count() == 20_000


# --- whole tables --------------------------------------------------------------------------


@needs_tables
def test_held_out_accuracy(spark):
    from zephyrine.llm.queries import QUERIES

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    for name, column, least in (("op1_toxicity", "toxic", 0.9), ("op10_factorisation_machine", "quality", 0.9)):
        told = QUERIES[name](spark, SF_DIR).join(labels, "doc_id").filter("held_out")
        right = told.agg(F.avg((F.col("predicted") == F.col(column)).cast("double"))).first()[0]
        assert right >= least, (name, right)


@needs_tables
def test_clean_documents_are_kept(spark):
    from zephyrine.llm.queries import QUERIES

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    told = QUERIES["op9_outliers"](spark, SF_DIR).filter("NOT base_failed").join(labels, "doc_id")
    assert told.filter("quality = 1 AND NOT kept").count() == 0
    assert told.filter("quality = 0 AND kept").count() <= 0.25 * told.filter("quality = 0").count()


@needs_tables
def test_pipeline_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = common.written(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
        assert docs.columns == columns or name == "sentencepiece"
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > counts[4] == counts[5]
    assert docs.filter("NOT round_trip").count() == 0


def test_pipeline_of_nothing_and_of_odd_rows(spark, tmp_path):
    import corpus_pipeline

    for name, texts in (("none", []), ("odd", [*ODD_TEXTS, "plain words here " * 9])):
        path = str(tmp_path / name)
        ids = [None, *range(1, len(texts))] if texts else []
        rows = spark.createDataFrame([], f"{DOCUMENT}, {CLASHING}") if not texts else documents(spark, texts, ids)
        rows.write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{path}/labels.parquet")
        spark.createDataFrame([], "item_id BIGINT, text STRING").write.parquet(f"{path}/benchmark.parquet")
        assert corpus_pipeline.run(spark, path).count() == (0 if not texts else len(set(map(bool, texts))) + 7)


def test_copies_of_a_toxic_text_teach_nothing_new(spark):
    rng = random.Random(12)
    copied = words(rng, 80) + " rareword anotherone"
    texts = [words(rng, 60) + (" moron " if i % 5 == 0 else " ") + words(rng, 3) for i in range(200)]
    near = []
    for i in range(40):
        split = (copied + " moron").split()
        split[rng.randrange(78)] = f"w{i}"
        near.append(" ".join(split))
    labels = [(i, int(i % 5 == 0)) for i in range(200)] + [(200 + i, 1) for i in range(40)]
    frame = spark.createDataFrame(labels, "doc_id BIGINT, toxic INT")
    scorer = toxicity.fit(documents(spark, texts + near), frame)
    assert scorer.score("a moron") > 0.5 and scorer.score("rareword anotherone") < 0.5
