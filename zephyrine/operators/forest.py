"""Forest of regression trees over binned columns, some of them grown in step.

Rows lie in the blocks of ``boosting.py``. A level of some trees is one aggregate: a task adds up
its blocks per tree, node, column and bin, of two sibling nodes for the smaller only; the
executors add up the tasks' sums, keep them to tell the siblings of the next level, and pick the
splits. The driver sees splits only. Each tree counts every row as often as a Poisson draw says,
which is repeated from the block's salt and the tree's number, so no draw is stored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame

from zephyrine.operators.boosting import (
    KEPT,
    Block,
    BoostedTrees,
    Cells,
    Ends,
    Node,
    Paths,
    _bin_type,
    best_splits,
    binned,
    put_splits,
    smaller_siblings,
    with_siblings,
)

# Cells of histograms, two doubles each, that a task holds at once; trees grow together that fit.
HELD = 4 << 20


def poisson(rng: np.random.Generator, n: int, mean: float) -> np.ndarray:
    """Poisson draws by comparing 32 bits with the distribution, far faster than one by one."""
    bits = rng.integers(0, 1 << 32, n, dtype=np.uint32)
    drawn, term, below = np.zeros(n, np.uint8), math.exp(-mean), 0.0
    for k in range(1, 256):
        below += term
        if (limit := round(below * (1 << 32))) >= 1 << 32:
            break
        drawn += bits >= np.uint32(limit)
        term *= mean / k
    return drawn


def _counted(
    trees: Sequence[dict[int, Node]],
    numbers: Sequence[int],
    nodes: Sequence[Sequence[int]],
    columns: Sequence[int],
    sizes: Sequence[int],
    kind: type,
    seed: int,
    mean: float,
) -> Callable[[Iterable[Block]], Iterator[tuple[int, np.ndarray]]]:
    """Blocks to one task's sums of gradients and weights of the nodes of each tree, by its place."""
    paths = [Paths.of(tree, "bin") for tree in trees]

    def run(blocks: Iterable[Block]) -> Iterator[tuple[int, np.ndarray]]:
        cells = {i: Cells(columns, sizes, len(own)) for i, own in enumerate(nodes) if own}
        places = {}
        for i in cells:
            places[i] = np.full(len(paths[i].value), -1, np.int32)
            places[i][nodes[i]] = range(len(nodes[i]))
        for n, salt, packed, _, stored in blocks:
            bins, gradient = np.frombuffer(packed, kind).reshape(-1, n), np.frombuffer(stored)
            for i, own in cells.items():
                rng = np.random.Generator(np.random.SFC64([seed, salt % (1 << 63), numbers[i]]))
                weight = poisson(rng, n, mean)
                at = np.flatnonzero(weight)
                drawn = bins.take(at, 1)
                node = places[i].take(paths[i].nodes(drawn))
                if (node < 0).any():
                    open_ = np.flatnonzero(node >= 0)
                    at, node, drawn = at.take(open_), node.take(open_), drawn.take(open_, 1)
                weight = weight.take(at).astype(np.float64)
                own.add(drawn, node, gradient.take(at) * weight, weight)
        for i, own in cells.items():
            yield i, own.apart()

    return run


def _grown_together(
    blocks: RDD, numbers: Sequence[int], columns: Sequence[int], edges: list[list[float]], seed: int, share: float,
    depth: int, least: int, rate: float,
) -> list[dict[int, Node]]:
    """Some trees, level by level; the executors keep the sums of a level for the next one."""
    kind, sizes, tasks = _bin_type(edges), [len(own) + 1 for own in edges], blocks.getNumPartitions()
    trees: list[dict[int, Node]] = [{1: Node(0.0)} for _ in numbers]
    open_, parents, before = [[1] for _ in trees], [[] for _ in trees], None
    for _ in range(depth):
        nodes = [smaller_siblings(tree, own) for tree, own in zip(trees, open_)]
        counted = blocks.mapPartitions(_counted(trees, numbers, nodes, columns, sizes, kind, seed, share))
        summed = counted.reduceByKey(np.add, min(tasks, len(trees)))
        told = list(zip(nodes, open_, parents))

        def whole(part: tuple[int, tuple[np.ndarray, np.ndarray | None]], told: list = told) -> tuple[int, np.ndarray]:
            i, (own, above) = part
            return i, with_siblings(own, told[i][0], told[i][1], above, told[i][2])

        if before is None:
            paired = summed.mapValues(lambda own: (own, None))
        else:
            paired = summed.join(before, summed.getNumPartitions())
        sums = paired.map(whole, preservesPartitioning=True).persist(KEPT)
        parents, open_ = open_, [[] for _ in trees]
        for i, found in sums.mapValues(lambda own: best_splits(own, 0.0, least)).collect():
            open_[i] = put_splits(trees[i], parents[i], found, columns, edges, 0.0, rate)
        if before is not None:
            before.unpersist()
        before = sums
        if not any(open_):
            break
    before.unpersist()
    return trees


def grow_forest(
    rows: DataFrame,
    vector: str,
    label: str,
    trees: int,
    depth: int,
    least: int,
    bins: int,
    seed: int,
    share: float = 1.0,
    ends: Ends | None = None,
) -> BoostedTrees:
    """Trees on bootstrap samples, split where the squared error falls most; their mean predicts.

    ``vector`` holds the inputs without missing values; rows without a label are left out. A leaf
    has ``least`` rows of its sample or more. ``share`` is the size of a sample to that of all rows;
    ``ends`` are the ``column_ends`` of the rows, if they are known.
    """
    told = binned(rows, vector, label, bins, seed, trees, 1.0, ends)
    model, edges, columns, blocks = BoostedTrees(told.width, told.mean), told.edges, told.usable, told.blocks
    if blocks is None:
        return model
    most = 2 ** max(depth - 2, 0) * sum(len(edges[c]) + 1 for c in columns)
    together = max(1, HELD // most)
    for start in range(0, trees, together):
        numbers = range(start, min(start + together, trees))
        model.trees += _grown_together(blocks, numbers, columns, edges, seed, share, depth, least, 1 / trees)
    blocks.unpersist()
    told.done(rows.sparkSession)
    return model
