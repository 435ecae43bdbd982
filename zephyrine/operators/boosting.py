"""Regularised boosting of regression trees over binned columns.

Columns are cut into bins once, at quantiles, and written as blocks of some thousand rows, which
are dealt evenly to the tasks. A
level of a tree costs one aggregate: each task adds the gradients and Hessians of its blocks
per node, column and bin, and these histograms are added up, on the executors if there are many.
Of two sibling nodes only the smaller is counted, the other is what is left of their parent.
Only their sum reaches the driver, which picks for each node the split with the largest
regularised gain. Trees reach the tasks as data, not as expressions: no level has a plan of its
own to compile. Rows are drawn
per tree by a stored hash, columns per tree by a seed, so a fit repeats.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.session import scratch_path
from zephyrine.sources.store import remove

# Settings of the compared model.
ROUNDS, DEPTH, RATE, ROW_SHARE, COLUMN_SHARE = 200, 4, 0.05, 0.8, 0.8
L2, LEAST_HESSIAN, SEED = 1.0, 1.0, 42
# Bins per column; trees after which the margins are stored, so that few are applied per level.
BINS, STORED_EVERY = 64, 5
KEPT = StorageLevel.MEMORY_AND_DISK
# Histograms of tasks the driver adds up itself.
FEW_TASKS = 64
_STEPS = 1 << 20
# Rows of a block and cells of a histogram of several columns, small enough for a core's cache.
BLOCK_ROWS, CELLS = 32_768, 16_384
# Many rows at once: ``bins`` column by column, ``drawn`` tree by tree with a bit per row; ``salt``
# is that of the first row.
_BLOCK = "n int, salt long, bins binary, drawn binary, gradient binary"

Batches = Iterable[pa.RecordBatch]
Block = tuple[int, int, bytes, bytes, bytes]


@dataclass
class Node:
    """A node of a tree: its Hessian sum, and a split (values up to ``threshold`` go left) or a value."""

    cover: float
    value: float = 0.0
    feature: int = -1
    threshold: float = 0.0
    bin: int = -1
    gain: float = 0.0


@dataclass
class BoostedTrees:
    """Trees by node number, the root 1 and the children of ``k`` 2k and 2k + 1."""

    numFeatures: int
    base: float
    trees: list[dict[int, Node]] = field(default_factory=list)

    def margin(self, values: Sequence[Column]) -> Column:
        """The prediction, batch by batch: hundreds of trees are too long for one expression."""
        trees, base = [Paths.of(tree) for tree in self.trees], self.base
        if not trees:
            return F.lit(base)

        @F.pandas_udf("double")
        def told(*columns: pd.Series) -> pd.Series:
            rows = np.stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
            total = np.full(rows.shape[1], base)
            for tree in trees:
                total = total + tree.value[tree.nodes(rows)]
            return pd.Series(total)

        return told(*[value.cast("double") for value in values])

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node; the base value as tree -1."""
        rows = [(-1, 0, -1, 0.0, self.base, float(self.numFeatures))]
        for t, tree in enumerate(self.trees):
            rows += [(t, k, n.feature, n.threshold, n.value, n.cover) for k, n in tree.items()]
        return spark.createDataFrame(
            rows, "tree INT, node INT, feature INT, threshold DOUBLE, value DOUBLE, cover DOUBLE"
        )

    @classmethod
    def from_table(cls, table: DataFrame) -> BoostedTrees:
        rows = table.orderBy("tree", "node").collect()  # the model itself
        model = cls(int(rows[0]["cover"]), rows[0]["value"])
        for r in rows[1:]:
            while len(model.trees) <= r["tree"]:
                model.trees.append({})
            model.trees[r["tree"]][r["node"]] = Node(r["cover"], r["value"], r["feature"], r["threshold"])
        return model


@dataclass
class Paths:
    """A tree as arrays by node number; a leaf leads to itself."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    following: np.ndarray
    depth: int

    @classmethod
    def of(cls, tree: dict[int, Node], cut: str = "threshold") -> Paths:
        """``cut`` names what splits: values up to a threshold or up to a bin go left."""
        size = max(tree) + 1
        paths = cls(
            np.zeros(size, np.int64),
            np.zeros(size, np.float64 if cut == "threshold" else np.int32),
            np.zeros(size),
            np.repeat(np.arange(size), 2),
            max(tree).bit_length() - 1,
        )
        for k, node in tree.items():
            paths.value[k] = node.value
            if node.feature >= 0:
                paths.feature[k], paths.cut[k] = node.feature, getattr(node, cut)
                paths.following[2 * k : 2 * k + 2] = 2 * k, 2 * k + 1
        return paths

    def nodes(self, rows: np.ndarray) -> np.ndarray:
        """The number of the unsplit node each row is in; a missing value goes right."""
        n = rows.shape[1]
        flat, each, start, at = rows.ravel(), np.arange(n), self.feature * n, np.ones(n, np.int64)
        for _ in range(self.depth):
            left = flat.take(start.take(at) + each) <= self.cut.take(at)
            at = self.following.take(2 * at + ~left)
        return at


def _nodes_of(tree: dict[int, Node], bins: np.ndarray) -> np.ndarray:
    """The number of the unsplit node each row is in, for trees of few nodes."""
    kind = np.uint8 if max(tree) < 256 else np.int32
    at = np.ones(bins.shape[1], kind)
    for k in sorted(tree):
        node = tree[k]
        if node.feature >= 0:
            here = at == k
            at += here * kind(k)
            at += here & (bins[node.feature] > node.bin)
    return at


def _with_trees(margin: np.ndarray, trees: Sequence[dict[int, Node]], bins: np.ndarray) -> np.ndarray:
    for tree in trees:
        values = np.zeros(max(tree) + 1)
        values[list(tree)] = [node.value for node in tree.values()]
        margin = margin + values[_nodes_of(tree, bins)]
    return margin


def _binned(edges: list[list[float]], base: float) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """``x, y, drawn, salt`` rows to blocks: a value's bin is the number of edges below it."""
    kind = _bin_type(edges)

    def block(rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        bins, drawn, y, salt = (np.concatenate(part, axis=-1) for part in zip(*rows))
        n = len(y)
        parts = [bins, np.packbits(drawn, axis=1), base - y]
        told = [pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for p in parts]
        return pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int32()), pa.array([salt[0]], pa.int64()), *told],
            ["n", "salt", "bins", "drawn", "gradient"],
        )

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            bins = np.stack([np.searchsorted(own, x[:, i], "left").astype(kind) for i, own in enumerate(edges)])
            drawn = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(bool)
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            if held and sum(len(rows[2]) for rows in held) + n > BLOCK_ROWS:
                yield block(held)
                held = []
            held.append((bins, drawn.T, y, batch.column(3).to_numpy(zero_copy_only=False)))
        if held:
            yield block(held)

    return run


def _bin_type(edges: list[list[float]]) -> type:
    return np.uint8 if max(map(len, edges)) < 256 else np.int32


def _with_margins(trees: Sequence[dict[int, Node]], kind: type) -> Callable[[Block], Block]:
    """Blocks with the trees' values added to the margins, that is to the gradients; the trees'
    samples are left off."""

    def run(block: Block) -> Block:
        n, salt, bins, drawn, gradient = block
        told = _with_trees(np.frombuffer(gradient), trees, np.frombuffer(bins, kind).reshape(-1, n))
        return n, salt, bins, drawn[len(trees) * ((n + 7) // 8) :], told.tobytes()

    return run


def _together(columns: Sequence[int], sizes: Sequence[int], nodes: int) -> list[list[int]]:
    """Places of columns that are counted as one: their bins' products and the nodes fit ``CELLS``."""
    groups: list[list[int]] = []
    room = 0
    for j in sorted(range(len(columns)), key=lambda j: (sizes[columns[j]], j)):
        own = sizes[columns[j]]
        if not groups or own > room:
            groups.append([])
            room = max(own, CELLS // nodes)
        groups[-1].append(j)
        room //= own
    return groups


class Cells:
    """Gradient and Hessian sums per column, node and bin.

    Columns of few bins are counted together, a cell per combination of bins, and told apart
    at the end: a row costs one addition for several columns.
    """

    def __init__(self, columns: Sequence[int], sizes: Sequence[int], nodes: int) -> None:
        self.columns, self.sizes, self.nodes = columns, sizes, nodes
        self.groups = _together(columns, sizes, nodes)
        self.shapes = [(nodes, *[sizes[columns[j]] for j in group]) for group in self.groups]
        self.sums = [np.zeros((2, int(np.prod(shape)))) for shape in self.shapes]

    def add(self, bins: np.ndarray, node: np.ndarray, gradient: np.ndarray, weight: np.ndarray | None) -> None:
        """Rows by column, each in a node; a row without weight counts once."""
        node, starts = node.astype(np.int64), {}
        for group, (_, *shape), sums in zip(self.groups, self.shapes, self.sums):
            code = bins[self.columns[group[0]]]
            if len(group) > 1:
                code = code.astype(np.int32)
                for j, size in zip(group[1:], shape[1:]):
                    code = code * np.int32(size) + bins[self.columns[j]]
            width = sums.shape[1] // self.nodes
            if width not in starts:
                starts[width] = node * width
            cell = starts[width] + code
            sums[0] += np.bincount(cell, gradient, sums.shape[1])
            sums[1] += np.bincount(cell, weight, sums.shape[1])

    def apart(self) -> np.ndarray:
        """The sums by column, node and bin."""
        told = np.zeros((2, len(self.columns), self.nodes, max(self.sizes)))
        for group, shape, sums in zip(self.groups, self.shapes, self.sums):
            whole = sums.reshape(2, *shape)
            for i, j in enumerate(group):
                others = tuple(k + 2 for k in range(len(group)) if k != i)
                told[:, j, :, : shape[i + 1]] = whole.sum(others)
        return told


def with_siblings(
    counted: np.ndarray, nodes: Sequence[int], open_: Sequence[int], before: np.ndarray | None, parents: Sequence[int]
) -> np.ndarray:
    """Sums of all open nodes: a node that was not counted has what its sibling leaves of the parent."""
    place, above = {k: i for i, k in enumerate(nodes)}, {k: i for i, k in enumerate(parents)}
    own = [
        counted[:, :, place[k]] if k in place else before[:, :, above[k // 2]] - counted[:, :, place[k ^ 1]]
        for k in open_
    ]
    return np.stack(own, axis=2)


def smaller_siblings(tree: dict[int, Node], open_: Sequence[int]) -> list[int]:
    """The root, and of each pair of siblings the one of fewer rows."""
    return [k for k in open_ if k == 1 or (tree[k].cover, k) < (tree[k ^ 1].cover, k ^ 1)]


def _histograms(
    recent: Sequence[dict[int, Node]],
    tree: dict[int, Node],
    counted: Sequence[int],
    columns: Sequence[int],
    sizes: Sequence[int],
    kind: type,
    turn: int | None,
) -> Callable[[Iterable[Block]], Iterator[np.ndarray]]:
    """Blocks to one task's sums of gradients and Hessians, the latter the rows of the squared error.

    Sums by column, then node and bin. ``turn`` tells which of the drawn samples left counts;
    None takes every row.
    """
    place = np.full(2 * max(tree) + 2, -1, np.int16 if len(counted) < 1 << 15 else np.int32)
    place[list(counted)] = range(len(counted))

    def run(blocks: Iterable[Block]) -> Iterator[np.ndarray]:
        cells = Cells(columns, sizes, len(counted))
        for n, _, packed, drawn, before in blocks:
            bins = np.frombuffer(packed, kind).reshape(-1, n)
            gradient = _with_trees(np.frombuffer(before), recent, bins)
            node = place[_nodes_of(tree, bins)]
            if turn is not None:
                bits = np.frombuffer(drawn, np.uint8).reshape(-1, (n + 7) // 8)[turn]
                node = np.where(np.unpackbits(bits, count=n).view(bool), node, place.dtype.type(-1))
            at = np.flatnonzero(node >= 0)
            if len(at) < n:
                bins, node, gradient = bins.take(at, 1), node.take(at), gradient.take(at)
            cells.add(bins, node, gradient, None)
        yield cells.apart()

    return run


@dataclass
class Ends:
    """Of labelled rows the width, the mean label, and per column quantiles and the largest value."""

    width: int
    mean: float
    quantiles: list[list[float]]
    largest: list[float | None]

    def edges(self, bins: int) -> list[list[float]]:
        """Upper ends of all bins but the last, per column."""
        step = (len(self.quantiles[0]) + 1) // bins
        return [
            sorted(v for v in set(own[step - 1 :: step]) if v < most)
            for own, most in zip(self.quantiles, self.largest)
        ]


def column_ends(rows: DataFrame, vector: str, label: str, bins: int = BINS) -> Ends:
    """From quantiles of all labelled rows; they serve every number of bins that divides ``bins``."""
    known = _known(rows, vector, label)
    first = known.agg(F.avg("y").alias("mean"), F.max(F.size("x")).alias("width")).first()
    if first["width"] is None:
        raise ValueError("no labelled rows to fit")
    width = first["width"]
    shares = [k / bins for k in range(1, bins)]
    found = known.agg(
        *[F.percentile_approx(F.get("x", F.lit(i)), shares, 10_000).alias(f"e{i}") for i in range(width)],
        *[F.max(F.get("x", F.lit(i))).alias(f"m{i}") for i in range(width)],
    ).first()
    quantiles = [list(found[f"e{i}"] or []) for i in range(width)]
    return Ends(width, first["mean"], quantiles, [found[f"m{i}"] for i in range(width)])


def _known(rows: DataFrame, vector: str, label: str) -> DataFrame:
    return rows.filter(F.col(label).isNotNull()).select(
        vector_to_array(vector).alias("x"), F.col(label).cast("double").alias("y")
    )


@dataclass
class Splits:
    """The best split of each of some nodes; a gain of 0 says there is none."""

    gain: np.ndarray
    column: np.ndarray  # its place among the counted columns
    bin: np.ndarray
    left: np.ndarray  # gradient and Hessian sums per node
    whole: np.ndarray


def best_splits(sums: np.ndarray, l2: float, least: float) -> Splits:
    """Of sums per column, node and bin; equal gains go to the first column and bin."""
    below = sums.cumsum(-1)
    whole = below[..., -1:]
    (left_g, left_h), (total_g, total_h) = below, whole
    right_g, right_h = total_g - left_g, total_h - left_h
    allowed = (sums[1] > 0) & (left_h >= least) & (right_h >= least) & (right_h > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2)
        gain = np.where(allowed, (parts - total_g**2 / (total_h + l2)) / 2, 0.0)
    columns, nodes, size = gain.shape
    gain = gain.transpose(1, 0, 2).reshape(nodes, -1)
    most = gain.max(1)
    place = (gain >= most[:, None] * (1 - 1e-12)).argmax(1)
    column, cut, each = place // size, place % size, np.arange(nodes)
    found = np.where(most > 1e-12, gain[each, place], 0.0)
    return Splits(found, column, cut, below[:, column, each, cut], whole[:, 0, :, 0])


def best_split(
    cells: Sequence[tuple[int, int, float, float]], l2: float, least: float
) -> tuple[float, int, int, float, float] | None:
    """``gain, column, bin, left gradient, left Hessian`` of the best split, None without one.

    ``cells`` has ``(column, bin, gradient, Hessian)`` sums of one node. Equal gains go to the
    first column and bin.
    """
    if not cells:
        return None
    columns = sorted({c for c, _, _, _ in cells})
    sums = np.zeros((2, len(columns), 1, max(b for _, b, _, _ in cells) + 1))
    for column, place, g, h in cells:
        sums[:, columns.index(column), 0, place] = g, h
    found = best_splits(sums, l2, least)
    if not found.gain[0]:
        return None
    left_g, left_h = found.left[:, 0].tolist()
    return float(found.gain[0]), columns[found.column[0]], int(found.bin[0]), left_g, left_h


def put_splits(
    tree: dict[int, Node],
    nodes: Sequence[int],
    found: Splits,
    columns: Sequence[int],
    edges: list[list[float]],
    l2: float,
    rate: float,
) -> list[int]:
    """Splits the nodes of a tree; tells the new ones."""

    def value(g: float, h: float) -> float:
        return -rate * g / (h + l2) if h + l2 > 0 else 0.0

    following = []
    for i, at in enumerate(nodes):
        node, (g, h) = tree[at], found.whole[:, i].tolist()
        node.cover, node.value = h, value(g, h)
        if not found.gain[i]:
            continue
        column, (left_g, left_h) = columns[found.column[i]], found.left[:, i].tolist()
        node.feature, node.bin, node.gain = column, int(found.bin[i]), float(found.gain[i])
        node.threshold = edges[column][node.bin]
        for side, (sg, sh) in enumerate(((left_g, left_h), (g - left_g, h - left_h))):
            tree[2 * at + side] = Node(sh, value(sg, sh))
            following.append(2 * at + side)
    return following


def _grown(
    blocks: RDD,
    recent: Sequence[dict[int, Node]],
    columns: Sequence[int],
    edges: list[list[float]],
    turn: int | None,
    depth: int,
    l2: float,
    least: float,
    rate: float,
) -> dict[int, Node]:
    """One tree over blocks whose margins lack the recent trees."""
    kind, sizes = _bin_type(edges), [len(own) + 1 for own in edges]
    few = blocks.getNumPartitions() <= FEW_TASKS
    tree = {1: Node(0.0)}
    open_, sums, parents = [1], None, []
    for _ in range(depth):
        counted = smaller_siblings(tree, open_)
        told = blocks.mapPartitions(_histograms(recent, tree, counted, columns, sizes, kind, turn))
        added = sum(told.collect()) if few else told.treeReduce(np.add)
        sums, parents = with_siblings(added, counted, open_, sums, parents), open_
        open_ = put_splits(tree, open_, best_splits(sums, l2, least), columns, edges, l2, rate)
        if not open_:
            break
    return tree


@dataclass
class Binned:
    """Labelled rows in blocks; ``blocks`` is None if no column has two values."""

    width: int
    mean: float
    edges: list[list[float]]
    usable: list[int]
    blocks: RDD | None
    path: str

    def done(self, spark: SparkSession) -> None:
        remove(spark, self.path)


def binned(
    rows: DataFrame, vector: str, label: str, bins: int, seed: int, rounds: int, row_share: float, ends: Ends | None
) -> Binned:
    """The labelled rows in stored blocks, dealt evenly, and for ``rounds`` trees a share of them drawn."""
    spark, known = rows.sparkSession, _known(rows, vector, label)
    if ends is None or (len(ends.quantiles[0]) + 1) % bins:
        ends = column_ends(rows, vector, label, bins)
    width, mean, edges = ends.width, ends.mean, ends.edges(bins)
    usable = [i for i, own in enumerate(edges) if own]
    path = scratch_path(spark, "binned")
    if not usable or not rounds:
        return Binned(width, mean, edges, usable, None, path)
    salt = F.xxhash64(F.monotonically_increasing_id(), F.lit(seed))

    def wins(turn: Column) -> Column:
        return F.pmod(F.xxhash64("salt", turn), F.lit(_STEPS)) < int(row_share * _STEPS)

    turns = F.sequence(F.lit(0), F.lit(rounds - 1)) if row_share < 1 else F.array().cast("array<int>")
    drawn = F.transform(turns, wins).alias("drawn")
    salted = known.withColumn("salt", salt).select("x", "y", drawn, "salt")
    salted.mapInArrow(_binned(edges, mean), _BLOCK).write.parquet(path)
    stored = spark.read.schema(_BLOCK).parquet(path).rdd.map(tuple)
    tasks = spark.sparkContext.defaultParallelism
    numbered = stored.zipWithIndex().map(lambda told: (told[1], told[0]))
    blocks = numbered.partitionBy(tasks, int).values().persist(KEPT)
    return Binned(width, mean, edges, usable, blocks, path)


def boost(
    rows: DataFrame,
    vector: str,
    label: str,
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    rate: float = RATE,
    row_share: float = ROW_SHARE,
    column_share: float = COLUMN_SHARE,
    l2: float = L2,
    least: float = LEAST_HESSIAN,
    bins: int = BINS,
    seed: int = SEED,
    first_rate: float | None = None,
    ends: Ends | None = None,
) -> BoostedTrees:
    """Trees that lower the squared error, leaves shrunk by ``l2``.

    ``vector`` holds the inputs without missing values; rows without a label are left out. The
    first prediction is the mean label. The first tree may have a rate of its own. ``ends`` are
    the ``column_ends`` of these rows, if they are known.
    """
    told = binned(rows, vector, label, bins, seed, rounds, row_share, ends)
    model, edges, usable, blocks = BoostedTrees(told.width, told.mean), told.edges, told.usable, told.blocks
    if blocks is None:
        return model
    rng, recent, older = random.Random(seed), [], None
    for t in range(rounds):
        if len(recent) == STORED_EVERY:
            older, blocks = blocks, blocks.map(_with_margins(recent, _bin_type(edges))).persist(KEPT)
            recent = []
        columns = sorted(rng.sample(usable, max(1, round(column_share * len(usable)))))
        turn = len(recent) if row_share < 1 else None
        own_rate = rate if t or first_rate is None else first_rate
        tree = _grown(blocks, recent, columns, edges, turn, depth, l2, least, own_rate)
        if older is not None:  # the tree's first level has stored the blocks after it
            older.unpersist()
            older = None
        model.trees.append(tree)
        recent.append(tree)
    blocks.unpersist()
    told.done(rows.sparkSession)
    return model
