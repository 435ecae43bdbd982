"""Toxicity scores of deobfuscated text.

A noisy-channel decoder restores disguised words: each odd token becomes a lattice of what
its characters may stand for (look-alike digits and symbols, letters repeated twice or more,
separators of any length between letters, single spaced letters), and the Viterbi path under
a character trigram model gives the words. The model is counted over every document. Words,
as they stand and restored, and their beginnings are then weighed by how often they occur in
documents labelled toxic.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from zephyrine.llm.common import hashed_sample, small_batches, spare_name, written

# Labelled documents the weights are learned from, about.
SAMPLE_ROWS = 20_000
# Tokens, and features being counted, that a worker remembers (about 200 bytes each).
REMEMBERED = 50_000

# Look-alikes: what a digit or symbol between letters may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
    "*": "aeiou",
}

# Costs of the channel, in natural logarithms.
SUBSTITUTE, DELETE, BREAK, COLLAPSE, SPACED_BREAK = 1.0, 1.0, 2.0, 1.5, 3.0
# A letter that stands twice is as likely doubled by the writer as by the word.
COLLAPSE_TWO = 0.25
# Look-alikes are meant to be read: dropping one costs this many times a separator.
READ_SYMBOL, READ_DIGIT = 8, 12

# Letters of the model: a-z and the Latin-1 letters; class 0 is any border.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if chr(c).isalpha())
CLASSES = len(LETTERS) + 1
_CLASS = {c: i + 1 for i, c in enumerate(LETTERS)}
_TABLE = np.zeros(257, np.int64)
for _c, _i in _CLASS.items():
    _TABLE[ord(_c)] = _i

_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}[.,;:!?]*(?!\S)")
_REPEATED = re.compile(r"(.)\1", re.S)
_RUN = re.compile(r"(.)\1+", re.S)
# Three or more equal symbols at an end are decoration.
_DECORATION = re.compile(r"^(?:([^\w\s])\1\1+)+|(?:([^\w\s])\2\2+)+$")
_PUNCTUATION = "!\"#%&'()*+,-./:;<=>?[\\]^_`{|}~«»“”„…"
_FRONT = _PUNCTUATION.replace("!", "").replace("|", "")
# Beginnings of words, in characters, that are weighed besides whole words.
BEGINNINGS = range(3, 9)
# Letters that tell quickly whether a token can be a feature: a beginning has as many.
HEAD = 3
# Odd factors that put hashes in different orders.
_ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
# Share of the telling words, and of the telling beginnings, that may be so by chance:
# beginnings stand in many more documents.
CHANCE, CHANCE_BEGINNING = 0.15, 0.001
# Share of toxic documents from which a beginning of telling words tells by itself.
PURE = 0.9


def trigram_codes(text: str) -> np.ndarray:
    """A number per character: its class and the two before it, borders not told apart."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = _TABLE[np.minimum(points, 256)]
    padded = np.concatenate([np.zeros(2, np.int64), classes, np.zeros(1, np.int64)])
    before, middle, last = padded[:-2], padded[1:-1], padded[2:]
    return np.where(middle == 0, 0, before) * CLASSES**2 + middle * CLASSES + last


def trigram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(code, n)`` over all documents: at most ``CLASSES`` cubed rows, 175,000."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    codes = trigram_codes(t)
                    if len(codes) > 50_000:
                        total += np.bincount(codes, minlength=CLASSES**3)
                    else:
                        values, counts = np.unique(codes, return_counts=True)
                        total[values] += counts
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["code", "n"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(scan, "code bigint, n bigint")
    return found.groupBy("code").agg(F.sum("n").alias("n"))


def language_model(counts: DataFrame) -> np.ndarray:
    """Log probability of a class after two others, shrunk towards the pair and the class."""
    rows = counts.toPandas()  # bounded by CLASSES cubed
    n = np.zeros(CLASSES**3)
    n[rows["code"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    three = n.reshape(CLASSES, CLASSES, CLASSES)
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    single = (one + 1) / (one.sum() + CLASSES)
    pair = (two + 5 * single) / (two.sum(axis=1, keepdims=True) + 5)
    triple = (three + 5 * pair[None]) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(triple)


def _runs(token: str) -> Iterator[tuple[str, int]]:
    at = 0
    while at < len(token):
        end = at + 1
        while end < len(token) and token[end] == token[at]:
            end += 1
        yield token[at], end - at
        at = end


def _options(char: str, run: int, spaced: bool) -> list[tuple[str, float]]:
    """What a run of one character may stand for, with costs; a space is a word border."""
    found: list[tuple[str, float]] = []
    if char in _CLASS:
        once = 0.0 if run != 2 else COLLAPSE_TWO
        found.append((char, once))
        if run > 1:
            found.append((char * 2, COLLAPSE if run > 2 else 0.0))
        if spaced:
            found += [(text + " ", cost + SPACED_BREAK) for text, cost in found]
        return found
    for letter in LOOK_ALIKES.get(char, ""):
        found.append((letter, SUBSTITUTE + (COLLAPSE if run > 1 else 0.0)))
        if run > 1:
            found.append((letter * 2, SUBSTITUTE * 2))
    weight = 1 if char not in LOOK_ALIKES else READ_DIGIT if char.isdigit() else READ_SYMBOL
    if run > 2 and not char.isdigit():  # a long run separates
        weight = 1
    found.append(("", DELETE * weight))
    found.append((" ", BREAK * max(1, weight // 2)))
    return found


def restore(token: str, model: list, spaced: bool = False) -> list[str]:
    """Words of the best path through the lattice of a lower-case token."""
    best = {(0, 0): (0.0, None, "")}
    for char, run in _runs(token):
        following: dict[tuple[int, int], tuple] = {}
        options = _options(char, run, spaced)
        for (a, b), entry in best.items():
            for text, cost in options:
                x, y, score = a, b, entry[0] - cost
                for c in text:
                    k = 0 if c == " " else _CLASS[c]
                    if k or y:  # a border after a border costs nothing
                        score += model[x][y][k]
                    x, y = (0, 0) if not k else (y, k)
                held = following.get((x, y))
                if held is None or score > held[0]:
                    following[(x, y)] = (score, entry, text)
        best = following
    ended = [(e[0] + (model[a][b][0] if b else 0.0), e) for (a, b), e in best.items()]
    entry = max(ended, key=lambda pair: pair[0])[1]
    parts = []
    while entry is not None:
        parts.append(entry[2])
        entry = entry[1]
    return "".join(reversed(parts)).split()


def words_of(token: str, model: list, spaced: bool = False) -> list[str]:
    """Restored words of a white-space token; none without any letter or look-alike symbol."""
    core = token
    while (bare := _DECORATION.sub("", core)) != core:
        core = bare
    core = core.rstrip(_PUNCTUATION).lstrip(_FRONT)
    if not spaced and core.isalpha() and not _REPEATED.search(core):
        return [core]
    if not any(c in _CLASS for c in core):
        if core.isalpha():  # other scripts stay as they are
            return [core]
        read = sum(c in LOOK_ALIKES for c in core)
        if spaced or read < 3 or core.isdigit() or not any(c in LOOK_ALIKES for c in core if not c.isdigit()):
            return []  # plain numbers; spaced look-alikes need a letter
    return restore(core, model, spaced)


def readings(token: str, model: list, spaced: bool = False) -> list[str]:
    """The restored words, and the token itself if it is a plain word."""
    restored = words_of(token, model, spaced)
    plain = token.strip(_PUNCTUATION)
    return [*restored, plain] if plain.isalpha() and plain not in restored and not spaced else restored


def spaced_runs(text: str) -> list[str]:
    """Three or more single characters with white space between them, put together."""
    return ["".join(run.split()) for run in _SPACED.findall(text)]


def features(word: str) -> list[str]:
    """A word, and its beginnings marked by a caret."""
    return [word, *["^" + word[:k] for k in BEGINNINGS if k <= len(word)]]


def document_words(text: str | None, model: list) -> set[str]:
    lowered = (text or "").lower()
    found = {w for token in set(lowered.split()) for w in readings(token, model)}
    for run in set(spaced_runs(lowered)):
        found.update(readings(run, model, True))
    return found


@dataclass
class Scorer:
    """Weights of restored words under a language model, remembered per token."""

    model: list
    weights: dict[str, float]
    base: float
    known: dict[str, float] = field(default_factory=dict)
    # First letters of the features, as they are and with repeated letters taken once.
    heads: set[str] = field(default_factory=set)
    bare_heads: set[str] = field(default_factory=set)

    def __post_init__(self) -> None:
        named = [f.removeprefix("^") for f in self.weights]
        self.heads = {f[:HEAD] for f in named}
        self.bare_heads = {_RUN.sub(r"\1", f)[:HEAD] for f in named}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "known": {}}

    def may_tell(self, token: str) -> bool:
        """False only for tokens of plain letters that no reading turns into a weighed feature.

        Decoding such a token changes no more than the lengths of its runs of letters.
        """
        core = token.rstrip(_PUNCTUATION).lstrip(_FRONT)
        if core.strip(LETTERS):
            return True
        if not _REPEATED.search(core):
            return core[:HEAD] in self.heads
        bare, known = _RUN.sub(r"\1", core), self.bare_heads
        return any(bare[:k] in known for k in range(1, HEAD + 1))

    def weight(self, token: str, spaced: bool = False) -> float:
        get = self.weights.get
        found = [get(f, 0.0) for w in readings(token, self.model, spaced) for f in features(w)]
        return max(found, default=0.0)

    def score(self, text: str | None) -> float:
        """The largest weight of any word, the base rate of plain documents if there is none."""
        lowered = (text or "").lower()
        known = self.known
        top = 0.0
        for token in set(lowered.split()):
            if not self.may_tell(token):
                continue
            value = known.get(token)
            if value is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                value = known[token] = self.weight(token)
            if value > top:
                top = value
        for run in set(spaced_runs(lowered)):
            top = max(top, self.weight(run, True))
        return max(top, self.base)


def _surprising(
    rows: pd.DataFrame, rate: float, tried: dict[int, int], chance: float
) -> pd.DataFrame:
    """Features more common in toxic documents than chance allows.

    ``tried`` has the number of such features per power of two of their documents. Of those
    of one size the best are taken, as many as keep the share that chance would give them
    under ``chance`` of what is taken, and under one feature.
    """
    k, n = rows["toxic"].to_numpy(float), rows["n"].to_numpy(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = k * np.log(k / (n * rate))
        rest = np.maximum(n - k, 0)
        ratio += np.where(rest > 1e-9, rest * np.log(rest / (n * (1 - rate))), 0)
    odds = np.where(k > n * rate, np.exp(-ratio), 1.0)
    sizes = np.array(_sizes(n), int)
    taken = np.zeros(len(rows), bool)
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        ranked = own[np.argsort(odds[own], kind="stable")]
        by_chance = odds[ranked] * tried.get(int(size), 1)
        fits = by_chance <= np.minimum(chance * np.arange(1, len(ranked) + 1), 1.0)
        if fits.any():
            taken[ranked[: np.flatnonzero(fits)[-1] + 1]] = True
    return rows[taken]


def _sizes(n: np.ndarray) -> list[int]:
    return np.floor(np.log2(np.maximum(n, 1e-9))).astype(int).tolist()


def signatures(text: str | None) -> list[int]:
    """Three numbers of which near copies share at least one, nearly always: for each of three
    orders of the hashes of word triples the smallest one."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    triples = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = np.array([xxhash.xxh64_intdigest(t) for t in triples], np.uint64)
    return [int((hashes * np.uint64(k)).min() >> np.uint64(1)) for k in _ORDERS]


def _weighed(chosen: DataFrame) -> DataFrame:
    """``text, toxic, weight``: copies under one label count together as one document.

    A row weighs one over the most rows of its label that share one of its signatures. Rows
    are the bounded sample.
    """

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signatures(t) for t in batch.column(0).to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(len(_ORDERS))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    marks = [f"s{i}" for i in range(len(_ORDERS))]
    names = ["text", "toxic", *marks]
    rows = chosen.select("text", F.col("toxic").cast("int")).mapInArrow(
        sign, "text string, toxic int, " + ", ".join(f"{m} bigint" for m in marks)
    )
    alike = [F.count("*").over(Window.partitionBy("toxic", mark)) for mark in marks]
    return rows.select("text", "toxic", (F.lit(1.0) / F.greatest(*alike)).alias("weight"))


def _counted(
    chosen: DataFrame, model, left_out: set[str]
) -> tuple[pd.DataFrame, dict[bool, dict[int, int]]]:
    """Weights of all and of toxic documents per feature; words in ``left_out`` are passed over.

    Only features of two toxic documents' weight or more come back, bounded by the sample,
    with the number of words and of beginnings per power of two of their weight. The empty
    feature stands for every document.
    """
    passed = chosen.sparkSession.sparkContext.broadcast(left_out)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: dict[str, float] = {}
        toxic: dict[str, float] = {}

        def told() -> pa.RecordBatch:
            keys = list(every)
            columns = [
                pa.array(keys, pa.string()),
                pa.array([toxic.get(k, 0.0) for k in keys], pa.float64()),
                pa.array([every[k] for k in keys], pa.float64()),
            ]
            every.clear()
            toxic.clear()
            return pa.RecordBatch.from_arrays(columns, ["feature", "toxic", "n"])

        for batch in batches:
            for text, label, weight in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = document_words(text, model.value) - passed.value
                seen = {f for w in found for f in features(w)}
                seen.add("")
                for f in seen:
                    every[f] = every.get(f, 0.0) + weight
                    if label:
                        toxic[f] = toxic.get(f, 0.0) + weight
                if len(every) >= REMEMBERED:
                    yield told()
        yield told()

    counts = written(
        chosen.mapInArrow(count, "feature string, toxic double, n double")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")),
        "counts",
    )
    size = F.floor(F.log2(F.greatest("n", F.lit(1e-9)))).cast("int")
    kinds = counts.groupBy(F.startswith("feature", F.lit("^")).alias("begins"), size.alias("size")).count()
    tried: dict[bool, dict[int, int]] = {False: {}, True: {}}
    for r in kinds.collect():  # a row per kind and power of two
        tried[r["begins"]][r["size"]] = r["count"]
    rows = counts.filter("feature = '' OR toxic >= 1.99").toPandas()
    passed.destroy()
    return rows, tried


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Scorer:
    """Counts the language model over ``docs`` and learns weights from ``labels``.

    ``labels`` has ``doc_id`` and ``toxic``; about ``sample`` ids drawn by hash are used, an id
    labelled twice counts as its larger label. Near copies of one label count together as one
    document, since a toxic text that is copied would make all its words telling. A weight is
    the share of toxic documents among those with the feature. Telling words are found first; a beginning is weighed by the
    other words that have it, and by telling words only if there are no others. Without
    labels of both kinds all scores are the base rate.
    """
    model = language_model(trigram_counts(docs)).tolist()
    known = written(
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic")),
        "labels",
    )
    drawn = hashed_sample(known, "doc_id", known.count(), sample)
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # ``sample`` rows
    chosen = written(_weighed(found), "sample")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    rows, tried = _counted(chosen, shared, set())
    whole = rows[rows["feature"] == ""]
    total, positive = float(whole["n"].sum()), float(whole["toxic"].sum())
    if not 0 < positive < total:
        shared.destroy()
        return Scorer(model, {}, positive / total if total else 0.0)
    rate = positive / total
    rows = rows[rows["feature"] != ""]
    beginnings = rows["feature"].str.startswith("^")
    words = _surprising(rows[~beginnings], rate, tried[False], CHANCE)
    rest, still_tried = _counted(chosen, shared, set(words["feature"]))
    shared.destroy()
    others = rest[rest["feature"].str.startswith("^")]
    pure = rows[beginnings & (rows["toxic"] >= PURE * rows["n"])]
    pure = pure[~pure["feature"].isin(set(others["feature"]))]
    begun = [
        _surprising(others, rate, still_tried[True], CHANCE_BEGINNING),
        _surprising(pure, rate, tried[True], CHANCE_BEGINNING),
    ]
    telling = pd.concat([words, *begun])
    shares = (telling["toxic"] + rate) / (telling["n"] + 1)
    return Scorer(model, dict(zip(telling["feature"], shares)), 0.1 * rate)


def score(docs: DataFrame, scorer: Scorer, name: str = "score") -> DataFrame:
    """All columns of the documents and their score, 0 to 1, from the whole text.

    NULL and empty texts have the base score. Rows stay as they are, repeats included.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(scorer)
    kept = [F.col(f"`{c}`") for c in docs.columns]
    text = spare_name(docs, "text_to_score")
    types = StructType([*docs.schema.fields, StructField(name, DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found, pa.float64())], types.names
            )

    return docs.select(F.col("text").alias(text), *kept).mapInArrow(run, types)


def training_fold(parts: int = 5, held_out: int = 0) -> Column:
    """Label rows the query may learn from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts != held_out


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The documents that score under ``limit``, with all their columns."""
    name = spare_name(docs, "toxicity")
    scorer = fit(docs, labels.filter(training_fold()))
    return score(docs, scorer, name).filter(F.col(name) < limit).drop(name)
