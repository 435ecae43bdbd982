"""Near copies among embeddings: cells of spherical k-means, blocked cosines within a cell.

A vector's home is the cell of its nearest centre, among the cells of its label. Where two
linked vectors have different homes, the plane half-way between the two centres separates
them, so one of them lies within half the longest linked chord of that plane. Every vector is
therefore also a guest in each cell whose plane is that near, and all links are found by
comparing the members of a cell among each other and with its guests, whatever the data.

Two vectors within half the linking angle of the same centre are linked for certain: such
core members are counted, never compared, so a dense group of near copies costs no pairs.
Equal vectors are one node with a weight. Large cells are cut into blocks, and a task
compares one block with another.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.common import extended, small_side, written
from zephyrine.llm.components import connected_components

SIMILARITY = 0.93
# Nodes a cell is planned for, and most cells of a label; beyond, cells grow and are cut into blocks.
CELL_ROWS, MOST_CELLS = 512, 1_024
# Nodes per cell the centres are fitted on: 32,768 of a label at most.
SAMPLE_PER_CELL, STEPS = 32, 12
# Nodes that one task gives their cells, and rows of a block.
PART_ROWS, BLOCK_ROWS = 16_384, 2_048
# Rounding of a product of unit vectors, many times over.
_SLACK = 1e-9


def _usable() -> Column:
    """Vectors that can have a cosine: whole, finite and not zero."""
    value = F.col("embedding")
    finite = F.forall(value, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    some = F.exists(value, lambda c: c != 0)
    return F.coalesce(F.col("label").isNotNull() & finite & some, F.lit(False))


def _keyed(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` and two hashes that stand for label and vector."""
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        "label",
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return rows.withColumns(
        {
            "key_a": F.when(_usable(), F.xxhash64("label", "embedding")),
            "key_b": F.when(_usable(), F.xxhash64(F.lit("b"), "embedding", "label")),
        }
    )


def _unit(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    """Unit vectors of a list column; the largest entry is taken out first, against overflow."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = lists.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt(np.einsum("ij,ij->i", values, values))[:, None]


def centres_of(units: np.ndarray, cells: int, steps: int = STEPS) -> np.ndarray:
    """Spherical k-means from the vectors that lie furthest from those chosen before."""
    rng = np.random.default_rng(42)
    chosen = [int(rng.integers(len(units)))]
    nearest = units @ units[chosen[0]]
    for _ in range(1, min(cells, len(units))):
        odds = np.maximum(1 - nearest, 0)
        if odds.sum() <= _SLACK:
            break
        chosen.append(int(rng.choice(len(units), p=odds / odds.sum())))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    centres = units[chosen].copy()
    for _ in range(steps):
        home = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, units)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        moved = np.where(lengths > _SLACK, sums / np.maximum(lengths, _SLACK), centres)
        if np.allclose(moved, centres, atol=1e-6):
            break
        centres = moved
    return centres


def placed(units: np.ndarray, centres: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home, guest mask over all cells, and whether a vector is a core member of its home."""
    reach = math.sin(math.acos(similarity) / 2) + _SLACK
    core = math.cos(math.acos(similarity) / 2) + _SLACK
    dots = units @ centres.T
    home = dots.argmax(axis=1)
    own = dots[np.arange(len(units)), home]
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))[home]
    guest = own[:, None] - dots <= reach * apart + _SLACK
    guest[np.arange(len(units)), home] = False
    return home, guest, own >= core


def _centres(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """``label, centres``: fitted per label on a bounded sample chosen by hash."""
    drawn = nodes.join(small_side(sizes.withColumnRenamed("label", "_label")), F.col("label") == F.col("_label"))
    steps = 1 << 40
    place = F.pmod(F.xxhash64("key_a", F.lit("sample")), F.lit(steps)) / F.lit(float(steps))
    drawn = drawn.filter(place * F.col("n") < F.col("cells") * SAMPLE_PER_CELL)
    types = extended(drawn.select("label"), "centres array<array<double>>")

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("key_a", "ascending"), ("key_b", "ascending")])
        units = _unit(table.column("embedding"), table.num_rows)
        found = centres_of(units, table.column("cells")[0].as_py())
        return pa.table({"label": table.column("label").slice(0, 1), "centres": pa.array([found.tolist()])})

    return drawn.select("label", "embedding", "key_a", "key_b", "cells").groupBy("label").applyInArrow(fit, types)


def _members(nodes: DataFrame, sizes: DataFrame, centres: DataFrame, similarity: float) -> DataFrame:
    """Per node its unit vector, home, the cells it is a guest in, and whether it is core."""
    named = sizes.select(F.col("label").alias("_label"), "parts")
    rows = nodes.join(small_side(named), F.col("label") == F.col("_label"), "left").drop("_label")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    spread = centres.join(small_side(named), F.col("label") == F.col("_label")).select(
        "label", "centres", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    types = extended(
        nodes.select("label", "node", "weight"), "unit array<double>, home int, also array<int>, core boolean"
    )

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema(
            [
                *[left.schema.field(n) for n in ("label", "node", "weight")],
                pa.field("unit", pa.list_(pa.float64())),
                pa.field("home", pa.int32()),
                pa.field("also", pa.list_(pa.int32())),
                pa.field("core", pa.bool_()),
            ]
        )
        if not left.num_rows:
            return schema.empty_table()
        units = _unit(left.column("embedding"), left.num_rows)
        middle = [c for found in right.column("centres").to_pylist() for c in found]
        # A label without a sample has one cell around an axis: any centre serves.
        home, guest, core = placed(units, np.array(middle or np.eye(1, units.shape[1])), similarity)
        found = [
            pa.array(list(units), pa.list_(pa.float64())),
            pa.array(home, pa.int32()),
            pa.array([np.flatnonzero(row).tolist() for row in guest], pa.list_(pa.int32())),
            pa.array(core),
        ]
        own = [left.column(n).combine_chunks() for n in ("label", "node", "weight")]
        return pa.Table.from_arrays([*own, *found], schema=schema)

    left = rows.select("label", "part", "node", "weight", "embedding").groupBy("label", "part")
    return left.cogroup(spread.groupBy("label", "part")).applyInArrow(place, types)


def _roots(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers of the rows and columns of a table of links; -1 without a link."""
    left, right = np.full(hits.shape[0], -1), np.full(hits.shape[1], -1)
    for number in range(hits.shape[0]):
        if left[number] >= 0 or not hits[number].any():
            continue
        ahead = np.array([number])
        left[number] = number
        while len(ahead):
            met = np.flatnonzero(hits[ahead].any(axis=0) & (right < 0))
            right[met] = number
            ahead = np.flatnonzero(hits[:, met].any(axis=1) & (left < 0)) if len(met) else met
            left[ahead] = number
    return left, right


def _compare(similarity: float) -> Callable[[tuple, pa.Table], pa.Table]:
    """Links between the two sides of a block: per node their weight, and a common root."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        cell = key[1].as_py()
        asking = np.array(table.column("asks").to_pylist(), bool)
        flat = table.column("unit").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        units = flat.reshape(table.num_rows, -1)
        node = np.array(table.column("node").to_pylist(), np.int64)
        weight = np.array(table.column("weight").to_pylist(), np.int64)
        home = np.array(table.column("home").to_pylist(), np.int64)
        core = np.array(table.column("core").to_pylist(), bool)
        also = table.column("also").to_pylist()
        one, two = np.flatnonzero(asking), np.flatnonzero(~asking)
        if not len(one) or not len(two):
            return pa.table({name: pa.array([], pa.int64()) for name in ("node", "links", "root")})
        hits = units[one] @ units[two].T >= similarity
        # Members that both ask meet twice; the smaller node's question counts.
        own = home[one] == cell
        both_ask = own[:, None] & ~core[two][None, :]
        hits &= ~both_ask | (node[one][:, None] < node[two][None, :])
        # Guests of each other's homes meet in both; the smaller cell counts.
        for other in np.unique(home[one][~own]):
            if other < cell:
                returned = np.array([other in also[i] for i in two])
                hits[np.ix_(home[one] == other, returned)] = False
        left, right = _roots(hits)
        links = np.concatenate([hits @ weight[two], weight[one] @ hits])
        roots = np.concatenate([left, right])
        nodes = np.concatenate([node[one], node[two]])
        told = roots >= 0
        return pa.table(
            {
                "node": pa.array(nodes[told]),
                "links": pa.array(links[told].astype(np.int64)),
                "root": pa.array(node[one][roots[told]]),
            }
        )

    return run


def _found(members: DataFrame, similarity: float, block_rows: int) -> DataFrame:
    """``node, links, root`` rows of all blocks and of the core members."""
    guests = members.select(
        "label", F.explode("also").alias("cell"), "node", "weight", "unit", "home", "also", "core"
    )
    homes = members.select(
        "label", F.col("home").alias("cell"), "node", "weight", "unit", "home", "also", "core"
    )
    asks = homes.filter("NOT core").unionByName(guests)
    counts = (
        homes.groupBy("label", "cell").agg(F.count("*").alias("n"), F.lit(0).cast("bigint").alias("a"))
        .unionByName(asks.groupBy("label", "cell").agg(F.lit(0).cast("bigint").alias("n"), F.count("*").alias("a")))
        .groupBy("label", "cell").agg(F.sum("n").alias("n"), F.sum("a").alias("a"))
    )
    blocks = written(
        counts.filter("n > 0 AND a > 0").select(
            F.col("label").alias("_label"),
            F.col("cell").alias("_cell"),
            F.ceil(F.col("n") / block_rows).cast("int").alias("homes"),
            F.ceil(F.col("a") / block_rows).cast("int").alias("asks_"),
        ),
        "blocks",
    )
    side = small_side(blocks)
    same = (F.col("label") == F.col("_label")) & (F.col("cell") == F.col("_cell"))

    def spread(rows: DataFrame, asking: bool) -> DataFrame:
        joined = rows.join(side, same)
        mine, others = ("asks_", "homes") if asking else ("homes", "asks_")
        block = F.pmod(F.xxhash64("node", F.lit("block")), F.col(mine)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias("other")
        out = joined.select(
            "label", "cell", block.alias("own"), every, "node", "weight", "unit", "home", "also", "core"
        )
        a, b = ("own", "other") if asking else ("other", "own")
        return out.select(
            "label", "cell", F.col(a).alias("i"), F.col(b).alias("j"), F.lit(asking).alias("asks"),
            "node", "weight", "unit", "home", "also", "core",
        )

    pairs = spread(asks, True).unionByName(spread(homes, False))
    compared = pairs.groupBy("label", "cell", "i", "j").applyInArrow(
        _compare(similarity), "node bigint, links bigint, root bigint"
    )
    core = members.filter("core")
    cores = written(
        core.groupBy("label", "home").agg(
            F.sum("weight").alias("total"), F.min("node").alias("root"), F.count("*").alias("n")
        )
        .filter("n > 1")
        .select(F.col("label").alias("_label"), F.col("home").alias("_home"), "total", "root"),
        "cores",
    )
    sure = core.join(
        small_side(cores), (F.col("label") == F.col("_label")) & (F.col("home") == F.col("_home"))
    ).select("node", (F.col("total") - F.col("weight")).alias("links"), "root")
    return compared.unionByName(sure)


def near_duplicates(
    vectors: DataFrame,
    similarity: float = SIMILARITY,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Two rows are linked if their labels are equal and their vectors' cosine, in double
    precision, is ``similarity`` (above 0) or more. ``n_links`` counts the other rows a row is linked
    with, ``component_id`` is the smallest id reachable by links, and one row per group, that
    with this id, is kept. NULL labels, and vectors that are NULL, empty, zero or hold a NULL
    or non-finite entry, have no links. A row with a NULL id counts, and names a group only
    where no other has an id. Repeated rows stay, each linked with the others. Vectors of one
    label must have one length. Columns other than ``vec_id, label, embedding`` are not read.
    """
    if not 0 < similarity < 1:
        raise ValueError("the similarity must lie between 0 and 1")
    rows = _keyed(vectors)
    nodes = written(
        rows.filter("key_a IS NOT NULL")
        .groupBy("key_a", "key_b")
        .agg(
            F.min("vec_id").alias("low"),
            F.count("*").alias("weight"),
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    sizes = written(
        nodes.groupBy("label")
        .agg(F.count("*").alias("n"))
        .select(
            "label",
            "n",
            F.least(F.ceil(F.col("n") / cell_rows), F.lit(MOST_CELLS)).cast("int").alias("cells"),
            F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts"),
        ),
        "sizes",
    )
    centres = written(_centres(nodes, sizes), "centres")
    members = written(_members(nodes, sizes, centres, similarity), "members")
    found = written(_found(members, similarity, block_rows), "found")
    links = found.groupBy(F.col("node").alias("_node")).agg(F.sum("links").alias("links"))
    groups = connected_components(found.select("node", "root"), "node", "root")
    told = nodes.select("key_a", "key_b", "low", "weight", "node").join(
        small_side(written(links, "links")), F.col("node") == F.col("_node"), "left"
    ).drop("_node")
    told = told.join(
        small_side(groups.select(F.col("node").alias("_node"), "component")), F.col("node") == F.col("_node"), "left"
    ).drop("_node")
    told = told.filter("weight > 1 OR links > 0").withColumn("component", F.coalesce("component", "node"))
    told = written(told, "told")
    least = written(
        told.groupBy(F.col("component").alias("_component")).agg(F.min("low").alias("least")), "least"
    )
    side = told.join(small_side(least), F.col("component") == F.col("_component")).select(
        F.col("key_a").alias("_a"),
        F.col("key_b").alias("_b"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
        "least",
    )
    side = written(side, "linked")
    same = (F.col("key_a") == F.col("_a")) & (F.col("key_b") == F.col("_b"))
    joined = rows.select("vec_id", "key_a", "key_b").join(small_side(side), same, "left")
    linked = F.col("links").isNotNull()
    component = F.when(linked, F.col("least")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
