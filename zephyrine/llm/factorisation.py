"""Quality scores by a factorisation machine over hashed words and structure statistics.

Every input has a weight and a short vector; each pair of inputs interacts through the
product of their vectors. Summed over all pairs that is, per dimension, half of the squared
sum less the sum of squares, so a document is scored in time linear in its inputs. The
machine is fitted on a bounded sample of labelled documents; scoring covers every text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from zephyrine.llm.common import hashed_sample, small_batches, spare_name, written

# Labelled documents the machine is fitted on, about.
SAMPLE_ROWS = 6_000
BUCKETS = 2_048
RANK = 6
EPOCHS = 12
BATCH = 64
RATE = 0.02
DECAY = 1e-4
SEED = 20_240_101
REMEMBERED = 400_000

_SYMBOLS = re.compile(r"[#*$%&|<>!]")
_DIGITS = re.compile(r"[0-9]")
STATISTICS = (
    "length", "words", "word_length", "symbols", "upper_words", "distinct_words", "repeats_next",
    "distinct_lines", "digits", "letters", "line_length", "stops",
)


def statistics(text: str, words: list[str], distinct: int) -> list[float]:
    """Structure of a text: lengths as logs, other values as shares."""
    n, chars = max(len(words), 1), max(len(text), 1)
    lines = [line for line in text.split("\n") if line.strip()]
    joined = "".join(words)
    inked = max(len(joined), 1)
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        len(joined) / n,
        len(_SYMBOLS.findall(joined)) / inked,
        sum(map(str.isupper, words)) / n,
        distinct / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(set(lines)) / max(len(lines), 1),
        len(_DIGITS.findall(joined)) / inked,
        sum(map(str.isalpha, words)) / n,
        np.log1p(chars / max(len(lines), 1)),
        joined.count(".") / n,
    ]


@dataclass
class Inputs:
    """Turns texts into hashed word buckets and standardised statistics."""

    buckets: int = BUCKETS
    known: dict[str, int] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "known": {}}

    def of(self, text: str | None) -> tuple[np.ndarray, list[float]]:
        text = text or ""
        words = text.split()
        distinct = set(words)
        known = self.known
        found = set()
        for word in distinct:
            bucket = known.get(word)
            if bucket is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                bucket = zlib.crc32(word.encode("utf-8", "surrogatepass")) % self.buckets
                known[word] = bucket
            found.add(bucket)
        return np.fromiter(found, np.int64, len(found)), statistics(text, words, len(distinct))


@dataclass
class Machine:
    """Weights, vectors and the standardisation of the statistics."""

    inputs: Inputs
    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray

    def arrange(self, buckets: np.ndarray, values: list[float]) -> tuple[np.ndarray, np.ndarray]:
        """Positions and values of a document's inputs; word inputs have length one together."""
        scaled = np.clip((np.asarray(values) - self.centre) / self.spread, -4, 4)
        positions = np.concatenate([buckets, self.inputs.buckets + np.arange(len(scaled))])
        share = 1 / np.sqrt(max(len(buckets), 1))
        return positions, np.concatenate([np.full(len(buckets), share), scaled])

    def margin(self, positions: np.ndarray, values: np.ndarray) -> float:
        rows = self.vectors[positions] * values[:, None]
        sums = rows.sum(axis=0)
        pairs = 0.5 * float((sums * sums - (rows * rows).sum(axis=0)).sum())
        return self.bias + float(self.weights[positions] @ values) + pairs

    def score(self, text: str | None) -> float:
        margin = self.margin(*self.arrange(*self.inputs.of(text)))
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def train(samples: list[tuple[np.ndarray, list[float]]], labels: np.ndarray, inputs: Inputs) -> Machine:
    """Fits the machine by adaptive steps on the logistic loss; rarer labels do not weigh more."""
    width = inputs.buckets + len(STATISTICS)
    random = np.random.default_rng(SEED)
    table = np.array([s for _, s in samples]) if samples else np.zeros((1, len(STATISTICS)))
    centre, spread = table.mean(axis=0), np.maximum(table.std(axis=0), 1e-3)
    rate = (labels.sum() + 1) / (len(labels) + 2)
    machine = Machine(
        inputs, float(np.log(rate / (1 - rate))), np.zeros(width),
        random.normal(0, 0.05, (width, RANK)), centre, spread,
    )
    rows = [machine.arrange(*s) for s in samples]
    squared = [np.zeros(width), np.zeros((width, RANK)), 0.0]
    for _ in range(EPOCHS if len(np.unique(labels)) > 1 else 0):
        order = random.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            step_w = np.zeros(width)
            step_v = np.zeros((width, RANK))
            step_b = 0.0
            chosen = order[at : at + BATCH]
            for i in chosen:
                positions, values = rows[i]
                inner = machine.vectors[positions] * values[:, None]
                sums = inner.sum(axis=0)
                margin = machine.margin(positions, values)
                error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[i]
                step_w[positions] += error * values
                step_v[positions] += error * values[:, None] * (sums[None, :] - inner)
                step_b += error
            size = len(chosen)
            step_w = step_w / size + DECAY * machine.weights
            step_v = step_v / size + DECAY * machine.vectors
            step_b /= size
            squared = [
                0.99 * squared[0] + 0.01 * step_w**2,
                0.99 * squared[1] + 0.01 * step_v**2,
                0.99 * squared[2] + 0.01 * step_b**2,
            ]
            machine.weights -= RATE * step_w / (np.sqrt(squared[0]) + 1e-3)
            machine.vectors -= RATE * step_v / (np.sqrt(squared[1]) + 1e-3)
            machine.bias -= RATE * step_b / (np.sqrt(squared[2]) + 1e-3)
    return machine


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS, buckets: int = BUCKETS) -> Machine:
    """Fits on ``labels`` (``doc_id, quality``): about ``sample`` ids drawn by hash.

    An id labelled twice counts as its smaller label. Without labels of both kinds every
    text scores the share of good labels (a half without any).
    """
    small_batches(docs.sparkSession)
    inputs = Inputs(buckets)
    known = written(
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality")),
        "labels",
    )
    drawn = hashed_sample(known, "doc_id", known.count(), sample)
    chosen = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # ``sample`` rows

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [inputs.of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([b for b, _ in found], pa.list_(pa.int64())),
                    pa.array([s for _, s in found], pa.list_(pa.float64())),
                ],
                ["doc_id", "quality", "buckets", "statistics"],
            )

    rows = (
        chosen.select(F.col("doc_id").cast("bigint"), "text", F.col("quality").cast("int"))
        .mapInArrow(read, "doc_id bigint, quality int, buckets array<bigint>, statistics array<double>")
        .dropDuplicates(["doc_id"])
        .toPandas()
        .sort_values("doc_id")
    )
    samples = [
        (np.sort(np.asarray(b, np.int64)), list(s)) for b, s in zip(rows["buckets"], rows["statistics"])
    ]
    return train(samples, rows["quality"].to_numpy(float), inputs)


def score(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """All columns of the documents and the score of the whole text, 0 to 1.

    NULL and empty texts are scored on their statistics. Rows stay as they are.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(machine)
    kept = [F.col(f"`{c}`") for c in docs.columns]
    types = StructType([*docs.schema.fields, StructField(name, DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found, pa.float64())], types.names
            )

    text = spare_name(docs, "text_to_score")
    return docs.select(F.col("text").alias(text), *kept).mapInArrow(run, types)


def training_fold(parts: int = 4, held_out: int = 2) -> Column:
    """Label rows the query may learn from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts != held_out
