"""Shards of near-equal bytes by a k-d tree over document metadata.

A node holds a share of the wanted leaves and is split at the weighted quantile of its widest
dimension that gives each side its share of the bytes. Quantiles come from histograms that
Spark counts for all nodes of a level at once: over coordinates first, then, inside the bin
that holds the quantile, over text hashes, then over document hashes, then over a number
each written row has, so many equal coordinates, copies or equal rows never unbalance a split. Copies of a text have the coordinates of its
first document and stay together unless a cut has to go through them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zephyrine.llm.common import discard, written

# Bins of a coordinate, and of the tie-breaking hashes.
BINS = 1_024
# Rows numbered together; a shard is numbered in as many blocks as it needs.
BLOCK_ROWS = 100_000
# Leaves whose cuts (about 40 bytes each) are broadcast.
MOST_LEAVES = 100_000

_TIES = ("text_bin", "row_bin", "salt_bin")


@dataclass
class _Node:
    """A node: its number, first leaf, leaves, and once split the cut (dimension, then ties)."""

    number: int
    first: int
    leaves: int
    dimension: int = -1
    cut: tuple[int, ...] = ()


def _unit(value: Column) -> Column:
    """A hash as a coordinate from 0 to 1; NULL is a value like any other."""
    hashed = F.shiftrightunsigned(F.xxhash64(F.coalesce(value.cast("string"), F.lit("\x00"))), 11)
    return hashed.cast("double") / F.lit(float(2**53))


def _log_bytes(size: Column) -> Column:
    return F.log2(size.cast("double"))


def document_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, text_hash, salt`` and coordinates ``x0..``: bytes, language, source.

    ``size`` is the UTF-8 length plus 8, a NULL text having none and the checksum of nothing.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        _unit(F.col("lang")).alias("lang"),
        _unit(F.col("source")).alias("source"),
    )
    # The number of a written row tells rows apart that are equal in all columns.
    rows = written(rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "rows")
    texts = rows.groupBy("text_hash", "size").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "lang", "source")).alias("first")
    )
    # Written, so that Spark can split the rows of a hot text over tasks in the join.
    texts = written(
        texts.select(
            F.col("text_hash").alias("_hash"), F.col("size").alias("_size"), "first.lang", "first.source"
        ),
        "texts",
    )
    same = (F.col("text_hash") == F.col("_hash")) & (F.col("size") == F.col("_size"))
    return rows.drop("lang", "source").join(texts, same).select(
        "doc_id", "size", "text_crc32", "text_hash", "salt",
        _log_bytes(F.col("size")).alias("x0"), F.col("lang").alias("x1"), F.col("source").alias("x2"),
    )


def _binned(rows: DataFrame, dimensions: int) -> DataFrame:
    """Coordinates as integer bins of the range each covers, and the tie-breaking hash bins."""
    names = [f"x{d}" for d in range(dimensions)]
    ends = rows.agg(*[F.min(x).alias(f"{x}_low") for x in names], *[F.max(x).alias(f"{x}_high") for x in names]).first()

    def bin_of(x: str) -> Column:
        low, high = ends[f"{x}_low"], ends[f"{x}_high"]
        if low is None or high is None or high <= low:
            return F.lit(0)
        share = (F.col(x) - low) / (high - low)
        return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")

    own = F.xxhash64("doc_id", "text_hash", F.lit("row"))
    return rows.select(
        *[c for c in rows.columns if c not in names],
        *[bin_of(x).alias(f"b{d}") for d, x in enumerate(names)],
        F.pmod(F.xxhash64("text_hash", F.lit("text")), F.lit(BINS)).cast("int").alias("text_bin"),
        F.pmod(own, F.lit(BINS)).cast("int").alias("row_bin"),
        F.pmod("salt", F.lit(BINS)).cast("int").alias("salt_bin"),
    )


def _with_cuts(rows: DataFrame, nodes: list[_Node], dimensions: int) -> DataFrame:
    """Adds the node's cuts ``c0..`` and, as ``place``, the coordinate it is cut along.

    Rows of nodes without a cut have NULL there. There are fewer nodes than leaves.
    """
    depth = len(nodes[0].cut)
    columns = {"cut_node": [n.number for n in nodes], "d": [n.dimension for n in nodes]}
    columns |= {f"c{i}": [n.cut[i] for n in nodes] for i in range(depth)}
    cuts = _small_table(rows, **columns)
    every = F.array(*[F.col(f"b{d}") for d in range(dimensions)])
    joined = rows.join(cuts, F.col("node") == F.col("cut_node"), "left")
    return joined.withColumn("place", F.get(every, F.col("d"))).drop("cut_node", "d")


def _step(rows: DataFrame, nodes: list[_Node], dimensions: int) -> DataFrame:
    """Moves each row to the child on its side of the cut, by coordinate and then the hashes."""
    levels = ["place", *_TIES]
    left = F.lit(False)
    for i, name in reversed(list(enumerate(levels))):
        left = (F.col(name) < F.col(f"c{i}")) | ((F.col(name) == F.col(f"c{i}")) & left)
    child = F.when(F.col("c0").isNull(), F.col("node")).otherwise(
        2 * F.col("node") + F.when(left, 0).otherwise(1)
    )
    return _with_cuts(rows, nodes, dimensions).withColumn("node", child).select(*rows.columns)


def _running(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per bin ``at`` its weight, the weight before it and that of all bins of the group."""
    counted = rows.groupBy(*by, "at").agg(F.sum("size").alias("weight"))
    whole = Window.partitionBy(*by)
    before = F.sum("weight").over(whole.orderBy("at")) - F.col("weight")
    return counted.select(
        *by, "at", "weight", before.alias("before"), F.sum("weight").over(whole).alias("total")
    )


def _passed(goal: Column, *more: str) -> Column:
    """Aggregate: the first bin in which the running weight passes the goal."""
    passed = F.col("before") + F.col("weight") > goal
    return F.min(F.when(passed, F.struct("at", *more)))


def _small_table(rows: DataFrame, **columns: list) -> DataFrame:
    """A broadcast of one row per node; there are fewer nodes than leaves."""
    return F.broadcast(rows.sparkSession.createDataFrame(pa.table(columns)))


def _level(rows: DataFrame, nodes: list[_Node], dimensions: int) -> list[_Node]:
    """Finds the cuts of all nodes of a level; nodes without rows are cut anywhere.

    Histograms stay in Spark, one row per node comes back.
    """
    by_number = {n.number: n for n in nodes}
    left = {n.number: 0.0 for n in nodes}
    for node in nodes:
        node.dimension, node.cut = 0, (0,)
    every = F.array(*[F.struct(F.lit(d).alias("d"), F.col(f"b{d}").alias("at")) for d in range(dimensions)])
    spread = rows.select("node", "size", F.inline(every))
    shares = _small_table(
        rows, node=[n.number for n in nodes], share=[(n.leaves // 2) / n.leaves for n in nodes]
    )
    total = F.col("total")
    each = _running(spread, ["node", "d"]).join(shares, "node").groupBy("node", "d").agg(
        _passed(0.05 * total).alias("low"),
        _passed(0.95 * total).alias("high"),
        _passed(total * F.col("share"), "before").alias("cut"),
        F.first(total * F.col("share")).alias("goal"),
    )
    # The widest dimension between its 5 % and 95 % points, the first of equal ones.
    width = (F.col("high.at") - F.col("low.at")).alias("width")
    widest = each.groupBy("node").agg(
        F.max(F.struct(width, (-F.col("d")).alias("d"), "cut", "goal")).alias("best")
    )
    for row in widest.select("node", "best.*").collect():
        node = by_number[row["node"]]
        node.dimension, node.cut = -row["d"], (row["cut"]["at"],)
        left[node.number] = row["goal"] - row["cut"]["before"]
    for depth, tie in enumerate(_TIES):
        on_cut = F.col("place") == F.col("c0")
        for i in range(depth):
            on_cut = on_cut & (F.col(_TIES[i]) == F.col(f"c{i + 1}"))
        here = _with_cuts(rows, nodes, dimensions).filter(on_cut).select("node", "size", F.col(tie).alias("at"))
        goals = _small_table(rows, node=list(left), goal=list(left.values()))
        told = _running(here, ["node"]).join(goals, "node").groupBy("node").agg(
            _passed(F.col("goal"), "before", "weight").alias("cut"),
            F.max("at").alias("last"),
            F.first("total").alias("total"),
        )
        found = {row["node"]: row for row in told.collect()}
        for node in nodes:
            at, before, weight = 0, 0, 0
            if row := found.get(node.number):
                at, before, weight = row["cut"] or (row["last"] + 1, row["total"], 0)
            left[node.number] -= before
            # The last cut falls between bins: take the nearer side.
            if depth == len(_TIES) - 1 and left[node.number] > weight / 2:
                at += 1
            node.cut += (at,)
    return nodes


def shard(rows: DataFrame, leaves: int, dimensions: int) -> DataFrame:
    """Adds ``shard``, 0 to ``leaves - 1``, of near-equal total ``size``.

    ``rows`` has ``doc_id, size, text_hash, salt`` and coordinates ``x0..``. Levels of the tree are
    as many as the logarithm of the leaves; each costs three narrow aggregates.
    """
    if not 1 <= leaves <= MOST_LEAVES:
        raise ValueError(f"between 1 and {MOST_LEAVES} shards")
    binned = written(
        _binned(rows, dimensions).withColumn("node", F.lit(1).cast("long")), "nodes"
    )
    done: list[_Node] = []
    current = [_Node(1, 0, leaves)]
    while current:
        wanted = [n for n in current if n.leaves > 1]
        done += [n for n in current if n.leaves == 1]
        if not wanted:
            break
        splits = _level(binned, wanted, dimensions)
        above, binned = binned, written(_step(binned, splits, dimensions), "nodes")
        discard(above)
        current = []
        for n in splits:
            half = n.leaves // 2
            current.append(_Node(2 * n.number, n.first, half))
            current.append(_Node(2 * n.number + 1, n.first + half, n.leaves - half))
    leaf = {"leaf_node": [n.number for n in done], "shard": pa.array([n.first for n in done], pa.int32())}
    numbers = rows.sparkSession.createDataFrame(pa.table(leaf))
    placed = binned.join(F.broadcast(numbers), F.col("node") == F.col("leaf_node"))
    return placed.drop("leaf_node")


def numbered(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard.

    Rows are numbered in hash blocks of about ``block_rows``; the blocks before one add up to
    its first number, so no shard is ever in one task. A block that equal rows fill beyond
    that is divided by the numbers of its rows.
    """
    most = rows.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, math.ceil(most / block_rows))
    block = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit("block")), F.lit(blocks)).cast("int")
    fullest = rows.groupBy("shard", block.alias("block")).count().agg(F.max("count")).first()[0] or 0
    parts = max(1, math.ceil(fullest / (4 * block_rows)))
    part = F.pmod(F.xxhash64("salt"), F.lit(parts)).cast("int")
    blocked = rows.withColumns({"block": block, "part": part})
    sizes = blocked.groupBy("shard", "block", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("shard").alias("_shard"),
        F.col("block").alias("_block"),
        F.col("part").alias("_part"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
    )
    own = Window.partitionBy("shard", "block", "part").orderBy("doc_id", "text_hash", "salt")
    placed = blocked.withColumn("place", F.row_number().over(own) - 1)
    same = (
        (F.col("shard") == F.col("_shard"))
        & (F.col("block") == F.col("_block"))
        & (F.col("part") == F.col("_part"))
    )
    return placed.join(starts, same).withColumn("slot", (F.col("start") + F.col("place")).cast("long"))


def shards(docs: DataFrame, leaves: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """One row per document row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Give the number of shards, or the bytes each should reach. The law is ``bytes``: sizes
    are as equal as single documents allow; ``grown_shard`` is NULL, since one more shard
    moves rows between all. NULL metadata is a value of its own, empty tables give no rows,
    repeated rows are placed one by one. Columns other than ``doc_id, text, lang, source``
    are not read.
    """
    rows = written(document_rows(docs.select("doc_id", "text", "lang", "source")), "placed")
    if leaves is None:
        if not target_bytes:
            raise ValueError("name a number of shards or their target bytes")
        total = rows.agg(F.sum("size")).first()[0] or 0
        leaves = max(1, math.ceil(total / target_bytes))
    placed = written(shard(rows, leaves, 3), "sharded")
    return numbered(placed).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
