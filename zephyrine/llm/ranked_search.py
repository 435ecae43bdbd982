"""Ranked lexical search: the best documents of every item of a query set.

Documents are scanned once and reduced to their counts of the query set's terms. Each task
puts such vectors, terms ordered from frequent to rare, into trees whose paths share
prefixes; a node knows the largest count of every term and the smallest length norm below
it, which bound the score of all its documents. The items descend a tree together, depth
first, each leaving a subtree that cannot reach its own best documents so far.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zephyrine.llm.common import extended, small_batches, written

TOP = 10
# Different terms of the items that are searched together: about 16 MB of words and numbers.
BLOCK_TERMS = 200_000
# Documents of a tree, and of a bucket that is not divided any more.
TREE_ROWS, BUCKET_ROWS = 4_096, 16
# Numbers a tree's bounds may hold: 64 MB.
TREE_CELLS = 8_000_000

# Terms are runs of ASCII letters and digits and of everything beyond ASCII; A-Z lower-cased.
_SEPARATORS = bytes(b for b in range(0x80) if not chr(b).isalnum())
_AS_TERMS = bytes.maketrans(
    _SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B))
)


def terms(text: str | None) -> list[bytes]:
    """All terms of a text in order, as UTF-8; none for NULL."""
    return text.encode("utf-8", "surrogatepass").translate(_AS_TERMS).split() if text else []


def _item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term`` once each; rows with one id are one item."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(dict.fromkeys(terms(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["item_id", "found"]
            )

    types = extended(items.select("item_id"), "found array<binary>")
    rows = items.select("item_id", "text").mapInArrow(scan, types)
    return rows.select("item_id", F.explode("found").alias("term")).distinct()


def _reduced(docs: DataFrame, words: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, ids, tfs`` of every document with a term; ids in rising order."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(words)  # BLOCK_TERMS words at most

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            sizes, ids, tfs = [], [], []
            for text in batch.column(1).to_pylist():
                found = terms(text)
                counted = sorted((number[t], n) for t, n in Counter(found).items() if t in number)
                sizes.append(len(found))
                ids.append([i for i, _ in counted])
                tfs.append([n for _, n in counted])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array(tfs, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "ids", "tfs"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = rows.mapInArrow(scan, "doc_id bigint, n bigint, ids array<int>, tfs array<bigint>")
    out = written(found.filter("n > 0"), "reduced")
    shared.destroy()
    return out


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def gains(tfs: np.ndarray, norm: np.ndarray | int) -> np.ndarray:
    """What a count gives under a length norm: rises with the count, falls with the norm."""
    return (1_000_000_000 * tfs) // (1000 * tfs + 8 * norm)


class Tree:
    """Documents by their terms from frequent to rare, with bounds at every node.

    A node's documents share the terms of its path. Its children are the documents by their
    next term, those without one first; a node of few documents is a bucket.
    """

    def __init__(self, ids: list[np.ndarray], tfs: list[np.ndarray], norms: np.ndarray, bucket: int):
        self.ids, self.tfs, self.norms = ids, tfs, norms
        order = sorted(range(len(ids)), key=lambda k: ids[k].tolist())
        self.nodes: list[tuple[np.ndarray, np.ndarray, int, list[int], list[int]]] = []
        self.root = self._grow(order, 0, bucket) if order else -1

    def _grow(self, members: list[int], depth: int, bucket: int) -> int:
        """Members are sorted by terms, so those with one path stand together."""
        parts: list[list[int]] = []
        while len(members) > bucket:
            parts = []
            last = None
            for k in members:
                step = int(self.ids[k][depth]) if depth < len(self.ids[k]) else -1
                if step != last:
                    parts.append([])
                    last = step
                parts[-1].append(k)
            if len(parts) > 1 or last == -1:
                break
            depth += 1
        if len(members) <= bucket or len(parts) == 1:
            return self._bounded(members, [])
        # Parts of few documents stand in buckets together, as neighbours on one path.
        children, small = [], []
        for part in parts:
            if len(part) + len(small) <= bucket:
                small += part
                continue
            if small:
                children.append(self._bounded(small, []))
                small = []
            if len(part) <= bucket:
                small = list(part)
            else:
                children.append(self._grow(part, depth + 1, bucket))
        if small:
            children.append(self._bounded(small, []))
        return self._bounded([], children)

    def _bounded(self, members: list[int], children: list[int]) -> int:
        if children:
            ids = np.concatenate([self.nodes[c][0] for c in children])
            tfs = np.concatenate([self.nodes[c][1] for c in children])
            norm = min(self.nodes[c][2] for c in children)
        else:
            ids = np.concatenate([self.ids[k] for k in members])
            tfs = np.concatenate([self.tfs[k] for k in members])
            norm = int(self.norms[members].min())
        known, at = np.unique(ids, return_inverse=True)
        most = np.zeros(len(known), np.int64)
        np.maximum.at(most, at, tfs)
        self.nodes.append((known, most, norm, members, children))
        return len(self.nodes) - 1


class Searcher:
    """The items of a block: their terms end to end, and the best documents of each so far."""

    def __init__(self, item_terms: list[np.ndarray], weights: np.ndarray, top: int):
        self.places = np.concatenate(item_terms)
        self.starts = np.cumsum([0, *[len(t) for t in item_terms]])[:-1]
        self.weights, self.top = weights, top
        self.table = np.zeros(len(weights), np.int64)
        self.best: list[list[tuple[int, int]]] = [[] for _ in item_terms]
        # Score and negated id of the worst of a full list: others must come before it.
        self.least = np.zeros(len(item_terms), np.int64)
        self.visited = self.scored = 0

    def _scores(self, ids: np.ndarray, tfs: np.ndarray, norm: int) -> np.ndarray:
        self.table[ids] = self.weights[ids] * gains(tfs, norm)
        scores = np.add.reduceat(self.table[self.places], self.starts)
        self.table[ids] = 0
        return scores

    def search(self, tree: Tree, doc_ids: list[int]) -> None:
        if tree.root >= 0:
            self._descend(tree, tree.root, doc_ids)

    def _descend(self, tree: Tree, node: int, doc_ids: list[int]) -> None:
        ids, most, norm, members, children = tree.nodes[node]
        self.visited += 1
        bound = self._scores(ids, most, norm)
        if not ((bound >= self.least) & (bound > 0)).any():
            return
        for child in children:
            self._descend(tree, child, doc_ids)
        for k in members:
            self.scored += 1
            scores = self._scores(tree.ids[k], tree.tfs[k], int(tree.norms[k]))
            for item in np.flatnonzero((scores >= self.least) & (scores > 0)):
                self._offer(int(item), int(scores[item]), doc_ids[k])

    def _offer(self, item: int, score: int, doc_id: int) -> None:
        held = self.best[item]
        entry = (score, -doc_id)
        if len(held) < self.top:
            heapq.heappush(held, entry)
        elif entry > held[0]:
            heapq.heapreplace(held, entry)
        if len(held) == self.top:
            self.least[item] = held[0][0]


# Stands for a NULL id, after all others.
_LAST = 2**63 - 1


def _searched(
    reduced: DataFrame,
    place: np.ndarray,
    item_terms: list[np.ndarray],
    weights: np.ndarray,
    totals: tuple[int, int],
    top: int,
) -> DataFrame:
    """``number, doc_id, score``: the best documents of each item in each task's rows."""
    shared = reduced.sparkSession.sparkContext.broadcast((place, item_terms, weights))
    documents, length = totals

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, item_terms, weights = shared.value
        searcher = Searcher(item_terms, weights, top)
        doc_ids: list[int] = []
        ids: list[np.ndarray] = []
        tfs: list[np.ndarray] = []
        norms: list[int] = []
        cells = 0

        def searched() -> None:
            searcher.search(Tree(ids, tfs, np.array(norms, np.int64), BUCKET_ROWS), doc_ids)
            for held in (doc_ids, ids, tfs, norms):
                held.clear()

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for doc_id, n, found, counts in zip(*columns):
                if not found:
                    continue
                doc_ids.append(_LAST if doc_id is None else doc_id)
                norms.append(10 + (90 * n * documents) // length)
                moved = place[found]
                order = moved.argsort()
                ids.append(moved[order])
                tfs.append(np.array(counts, np.int64)[order])
                cells += len(found)
                if len(ids) >= TREE_ROWS or cells >= TREE_CELLS:
                    searched()
                    cells = 0
        searched()
        rows = [(i, -d, s) for i, held in enumerate(searcher.best) for s, d in held]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([None if r[1] == _LAST else r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.int64()),
            ],
            ["number", "doc_id", "score"],
        )

    return reduced.select("doc_id", "n", "ids", "tfs").mapInArrow(run, "number int, doc_id bigint, score bigint")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The best rows of each number; every task brings ``top`` of a number at most."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy("number").orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= top)


def _block(docs: DataFrame, pairs: DataFrame, top: int) -> DataFrame | None:
    """The ranking for one block of items, given as ``item_id, term`` pairs."""
    rows = sorted(((r["item_id"], bytes(r["term"])) for r in pairs.collect()), key=repr)  # BLOCK_TERMS pairs
    if not rows:
        return None
    spark = docs.sparkSession
    words = {t: i for i, t in enumerate(sorted({t for _, t in rows}))}
    reduced = _reduced(docs, words)
    totals = reduced.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
    counted = reduced.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("df")).collect()
    df = np.zeros(len(words), np.int64)
    for r in counted:  # one row per term of the items
        df[r["id"]] = r["df"]
    if not totals["documents"]:
        return None
    # Frequent terms come first on the paths, so that they share most.
    order = np.argsort(-df, kind="stable")
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    weights = np.array([weight(totals["documents"], int(df[i])) for i in order], np.int64)
    by_item: dict[object, list[int]] = {}
    for item, term in rows:
        by_item.setdefault(item, []).append(int(place[words[term]]))
    names = list(by_item)
    item_terms = [np.array(sorted(by_item[i]), np.int64) for i in names]
    found = _searched(reduced, place, item_terms, weights, (totals["documents"], totals["length"]), top)
    best = written(_ranked(found, top), "ranked")
    named = spark.createDataFrame(list(enumerate(names)), pairs.select(F.lit(0).alias("of"), "item_id").schema)
    return best.join(F.broadcast(named), F.col("number") == F.col("of")).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item, best first.

    Equal scores stand by rising ``doc_id``, NULL last; only scores above 0 rank. A NULL or
    empty text, or one without a term, is no document and no item; items with one id are one.
    Repeated documents rank as often as they occur. Columns other than ``doc_id, text`` and
    ``item_id, text`` are not read. Items are searched in blocks of about ``block_terms``
    terms, every block against all documents.
    """
    pairs = written(_item_terms(items), "item-terms")
    blocks = max(1, math.ceil(pairs.count() / block_terms))
    part = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    out = None
    for k in range(blocks):
        found = _block(docs, pairs.filter(part == k), top)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        empty = items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"))
        return empty.withColumn("score", F.lit(0).cast("bigint")).limit(0)
    return out
