"""SimHash near-duplicates: fingerprints of word shingles, linked through a vantage-point tree.

Fingerprints are 64-bit. Each inner node of the tree has a vantage point and a radius;
fingerprints within the radius go inside, others outside. Two fingerprints at Hamming
distance ``r`` or less differ by ``r`` or less in their distance to the vantage point, so
those inside that are close to the border also go outside: of any linked pair, both ends
meet in some leaf, whichever way the borders fall. Leaves are shards, each compared exactly
by one task, which returns a spanning forest of its links instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.common import hashed_sample, small_batches, small_side, spare_name, written
from zephyrine.llm.components import connected_components

# Fingerprints the tree is fitted on, about; all are then indexed.
TREE_SAMPLE = 65_536
# Rows a leaf aims at, and the sample points it needs at least.
LEAF_ROWS = 2_000
LEAF_SAMPLE = 16

_SEED = 42
# Eight bytes per byte value: byte k holds bit k.
_SPREAD = (
    np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    .copy()
    .view(np.uint64)[:, 0]
)
_BLOCK = 255  # byte counters hold this many hashes


def fingerprint(text: str | None, words: int = 3) -> bytes:
    """Eight bytes, most significant first; zero for a text without words.

    Words are runs without ASCII white space, A-Z lower-cased. A bit is set if more than
    half the shingle hashes (XXH64, seed 42) have it.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return bytes(8)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    digest = xxhash.xxh64_digest
    if len(found) <= words:
        digits = digest(joined, _SEED)
    else:
        starts = [0, *(ends[: len(found) - words] + 1).tolist()]
        stops = ends[words - 1 :].tolist()
        digits = b"".join([digest(joined[i:j], _SEED) for i, j in zip(starts, stops)])
    rows = np.frombuffer(digits, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(rows), _BLOCK):
        packed = _SPREAD[rows[at : at + _BLOCK]].sum(axis=0, dtype=np.uint64)
        counts += packed.view(np.uint8)
    bits = (2 * counts > len(rows)).reshape(8, 8)
    return np.packbits(bits, axis=1, bitorder="little").tobytes()


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, text_hash`` and ``fp`` (the 64 bits as a signed number) of every document row.

    A NULL or blank text has fingerprint zero. Columns but ``doc_id, text`` are not read.
    """
    small_batches(docs.sparkSession)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = b"".join([fingerprint(t, words) for t in batch.column(2).to_pylist()])
            numbers = np.frombuffer(found, ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(numbers)], ["doc_id", "text_hash", "fp"]
            )

    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    return source.mapInArrow(scan, "doc_id bigint, text_hash bigint, fp bigint")


@dataclass
class _Node:
    vantage: int
    radius: int
    inside: "_Node | int"
    outside: "_Node | int"


class VantageTree:
    """Borders fitted on a bounded sample; ``place`` gives the leaves of any fingerprints."""

    def __init__(self, sample: np.ndarray, rows: int, reach: int, leaf_rows: int = LEAF_ROWS):
        self.reach = reach
        self.leaves = 0
        leaf = max(LEAF_SAMPLE, int(leaf_rows * len(sample) / max(rows, 1)))
        self.root = self._fit(np.sort(sample), leaf)

    def _fit(self, points: np.ndarray, leaf: int) -> _Node | int:
        if len(points) > leaf:
            vantage = points[len(points) // 2]
            far = np.bitwise_count(points ^ vantage)
            radius = int(np.median(far))
            inside, outside = far <= radius, far > radius - self.reach
            if inside.sum() < len(points) and outside.sum() < len(points):
                return _Node(
                    int(vantage),
                    radius,
                    self._fit(points[inside], leaf),
                    self._fit(points[outside], leaf),
                )
        self.leaves += 1
        return self.leaves - 1

    def place(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``points`` and their leaves; border points have several."""
        at, leaves = [], []
        work = [(self.root, np.arange(len(points)))]
        while work:
            node, rows = work.pop()
            if not len(rows):
                continue
            if isinstance(node, int):
                at.append(rows)
                leaves.append(np.full(len(rows), node, np.int64))
                continue
            far = np.bitwise_count(points[rows] ^ np.uint64(node.vantage))
            work.append((node.inside, rows[far <= node.radius]))
            # uint8 distances: compare without going below zero
            work.append((node.outside, rows[far + np.uint8(self.reach) > node.radius]))
        if not at:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(at), np.concatenate(leaves)


def _merge_close(points: np.ndarray, labels: np.ndarray, rows: np.ndarray, reach: int) -> None:
    """Joins the labels of all rows within reach of each other, comparing all of them."""
    own = points[rows]
    step = max(1, 2_000_000 // len(rows))
    for begin in range(0, len(rows), step):
        near = np.bitwise_count(own[begin : begin + step, None] ^ own[None, :]) <= reach
        for i in np.flatnonzero(near.sum(axis=1) > 1):
            met = np.unique(labels[rows[near[i]]])
            if len(met) > 1:
                labels[np.isin(labels, met[1:])] = met[0]


def linked(points: np.ndarray, reach: int, compare: int = 1024) -> np.ndarray:
    """For each of the distinct points the smallest position it is linked to."""
    labels = np.arange(len(points))
    work = [np.arange(len(points))]
    while work:
        rows = work.pop()
        if len(rows) > compare:
            far = np.bitwise_count(points[rows] ^ points[rows[len(rows) // 2]]).astype(np.int64)
            radius = int(np.median(far))
            inside, outside = far <= radius, far > radius - reach
            if inside.sum() < 0.9 * len(rows) and outside.sum() < 0.9 * len(rows):
                work += [rows[inside], rows[outside]]
                continue
        _merge_close(points, labels, rows, reach)
    return labels


def fingerprint_links(
    points: DataFrame, reach: int = 2, leaf_rows: int = LEAF_ROWS, sample: int = TREE_SAMPLE
) -> DataFrame:
    """``(a, b)`` spanning all links of the distinct ``fp`` values at ``reach`` bits or less.

    The tree is fitted on about ``sample`` values drawn by hash; every value is indexed and
    every link within reach is found, whatever the sample.
    """
    rows = points.count()
    drawn = hashed_sample(points.select("fp"), "fp", rows, sample).toPandas()["fp"]
    tree = VantageTree(drawn.to_numpy(np.int64).view(np.uint64), rows, reach, leaf_rows)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            at, leaves = tree.place(values.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(leaves), pa.array(values[at])], ["leaf", "fp"])

    def compare(table: pa.Table) -> pa.Table:
        values = np.unique(table.column("fp").to_numpy())
        labels = linked(values.view(np.uint64), reach)
        moved = np.flatnonzero(labels != np.arange(len(values)))
        return pa.table({"a": values[labels[moved]], "b": values[moved]})

    shards = points.select("fp").mapInArrow(place, "leaf bigint, fp bigint")
    return shards.groupBy("leaf").applyInArrow(compare, "a bigint, b bigint")


def _groups(docs: DataFrame, words: int, reach: int, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``doc_id, text_hash, fp, root``: the smallest fingerprint each document is linked to."""
    marked = written(fingerprints(docs, words), "fingerprints")
    points = written(marked.select("fp").distinct(), "points")
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    roots = connected_components(fingerprint_links(points, reach, leaf_rows))
    # Written, so that Spark can split the rows of a hot fingerprint over tasks in the join.
    rooted = written(
        points.join(roots, F.col("fp") == F.col("node"), "left").select(
            F.col("fp").alias("point"), F.coalesce("component", "fp").alias("root")
        ),
        "roots",
    )
    return marked.join(rooted, F.col("fp") == F.col("point")).drop("point")


def near_duplicates(
    docs: DataFrame, words: int = 3, reach: int = 2, leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """One row per document row: ``doc_id, text_hash, fp, component_id``.

    Documents are linked if their fingerprints differ in ``reach`` bits or less, so equal
    texts always are, blank texts among each other too; ``component_id`` is the smallest
    ``doc_id`` reachable over links, itself included. Rows with a NULL ``doc_id`` take part
    and get the smallest id they reach, or NULL if there is none. Repeated rows stay.
    """
    found = written(_groups(docs, words, reach, leaf_rows), "groups")
    least = written(found.groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return found.join(least, "root").select("doc_id", "text_hash", "fp", "component_id")


def first_of_each_group(docs: DataFrame, words: int = 3, reach: int = 2) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns.

    The one with the smallest ``doc_id`` stays (NULL last; of equal ids one by text; of equal
    rows any one). A document linked to no other is a group of its own.
    """
    found = written(_groups(docs, words, reach), "groups")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")
    firsts = found.groupBy("root").agg(F.min(place).alias("first"))
    keys = written(
        firsts.select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash")), "kept"
    )
    mark = spare_name(docs, "text_hash")
    keyed = docs.withColumn(mark, F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(keys["_id"]) & (keyed[mark] == keys["_hash"])
    kept = keyed.join(small_side(keys), same, "left_semi")
    repeats = found.groupBy("doc_id", "text_hash").count().filter("count > 1")
    if not repeats.isEmpty():
        kept = kept.dropDuplicates(["doc_id", mark])
    return kept.drop(mark)
