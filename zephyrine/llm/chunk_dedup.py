"""Repeated substrings by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where the hash of the last sixteen
bytes falls under a bar. Ends depend on nearby bytes only, so text put in before a passage
moves its chunks but does not change them, and a passage that occurs twice is mostly cut
alike both times. Chunks with equal digests are copies; runs of copied chunks are spans,
where each two neighbours stood side by side before: chunks that each occur somewhere else
by chance make no run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zephyrine.llm.common import small_batches, small_side, spare_name, written

# Mean distance of natural ends, and the shortest and longest chunk, in bytes.
MEAN, LEAST, MOST = 24, 8, 64
# A span of copied chunks counts from this many bytes.
SPAN_BYTES = 100

# Odd factors that mix two digests into one number.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_GEAR = np.random.default_rng(42).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of the gear values of the last 16 bytes, each shifted by its age."""
    hashes = _GEAR[data]
    for step in (1, 2, 4, 8):
        older = hashes[:-step] << np.uint32(step)
        hashes = hashes.copy()
        hashes[step:] += older
    return hashes


def chunk_ends(data: bytes, mean: int = MEAN, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of UTF-8 text, the last one its length; characters stay whole."""
    size = len(data)
    if not size:
        return []
    array = np.frombuffer(data, np.uint8)
    natural = np.flatnonzero((gear_hashes(array) >> np.uint32(16)) < 65_536 // mean) + 1
    inside = np.append((array & 0xC0) == 0x80, False)
    for _ in range(3):
        natural = natural + inside[np.minimum(natural, size)]
    ends: list[int] = []
    last = 0

    def fill(to: int) -> None:
        nonlocal last
        while to - last > most:
            last += most
            while inside[last]:
                last += 1
            ends.append(last)

    for end in natural.tolist():
        if end - last >= least and end < size:
            fill(end)
            if end - last >= least:
                ends.append(end)
                last = end
    fill(size)
    if last < size:
        ends.append(size)
    return ends


def _pairs(halves: np.ndarray) -> np.ndarray:
    """A number for each chunk's digest after the one before it; the first has no meaning."""
    digests = halves.view(np.uint64)
    before = np.roll(digests, 1, axis=0)
    mixed = before[:, 0] * _MIX[0] + before[:, 1] * _MIX[1]
    return ((mixed ^ digests[:, 0]) * _MIX[2] + digests[:, 1]).view(np.int64)


def _chunks(docs: DataFrame, digests_only: bool) -> DataFrame:
    """Chunk rows ``doc_id, text_hash, start, size, d1, d2, pair``, or their first digest half only.

    ``pair`` stands for a chunk and the one before it, NULL for the first of a text.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            found, counts, starts, sizes = [], [], [], []
            for text in batch.column(2).to_pylist():
                data = text.encode("utf-8", "surrogatepass") if text else b""
                ends = chunk_ends(data)
                begins = [0, *ends[:-1]] if ends else []
                found += [digest(data[i:j]) for i, j in zip(begins, ends)]
                counts.append(len(ends))
                starts += begins
                sizes += [j - i for i, j in zip(begins, ends)]
            halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            first = pa.array(np.ascontiguousarray(halves[:, 0]))
            if digests_only:
                yield pa.RecordBatch.from_arrays([first], ["d1"])
                continue
            rows = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(starts, pa.int32()),
                    pa.array(sizes, pa.int32()),
                    first,
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                    pa.array(_pairs(halves), mask=np.array(starts) == 0 if starts else None),
                ],
                ["doc_id", "text_hash", "start", "size", "d1", "d2", "pair"],
            )

    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    if digests_only:
        return source.mapInArrow(scan, "d1 bigint")
    types = "doc_id bigint, text_hash bigint, start int, size int, d1 bigint, d2 bigint, pair bigint"
    return source.mapInArrow(scan, types)


def _place() -> Column:
    """Order of chunks: by ``doc_id`` (NULL last), equal ids by text, then position."""
    return F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash", "start")


def _repeated(docs: DataFrame) -> DataFrame:
    """The chunks that may have a copy, written: a first pass counts half digests, so only they
    are shuffled whole."""
    small_batches(docs.sparkSession)
    halves = _chunks(docs, True).groupBy("d1").agg(F.count("*").alias("n"))
    twice = written(halves.filter("n > 1").select("d1"), "digests")
    # Both sides are shuffled at any size: the digests seen twice grow with the input.
    return written(_chunks(docs, False).join(twice.hint("merge"), "d1", "left_semi"), "chunks")


def _copied(repeated: DataFrame) -> DataFrame:
    """Those that an earlier chunk equals, with ``pair`` and the place of the earliest."""
    first = repeated.groupBy("d1", "d2").agg(F.min(_place()).alias("first"))
    # Written, so that Spark can split the rows of a hot digest over tasks in the join.
    first = written(first.select(F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), "first"), "firsts")
    return (
        repeated.withColumn("place", _place())
        .join(first, (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")))
        .filter(F.col("first") < F.col("place"))
        .select(
            "doc_id",
            "text_hash",
            "start",
            "size",
            "pair",
            F.col("first.doc_id").alias("first_doc_id"),
            F.col("first.text_hash").alias("first_hash"),
            F.col("first.start").alias("first_start"),
        )
        .distinct()
    )


def copied_chunks(docs: DataFrame) -> DataFrame:
    """Every chunk that an earlier chunk equals, with the earliest: ``first_doc_id, first_start``."""
    return _copied(_repeated(docs)).drop("pair", "first_hash")


def _with_begins(chunks: DataFrame, repeated: DataFrame) -> DataFrame:
    """Adds ``begins``: whether no run goes on from the copied chunk before into this one.

    It does if both were copied from neighbours, or if their pair stood somewhere earlier,
    which is looked up only for borders that the first does not tell.
    """
    ordered = Window.partitionBy("doc_id", "text_hash").orderBy("start")
    before = F.lag(F.struct("start", "size", "first_doc_id", "first_hash", "first_start")).over(ordered)
    near = F.coalesce(F.col("b.start") + F.col("b.size") == F.col("start"), F.lit(False))
    source = (
        F.col("b.first_doc_id").eqNullSafe(F.col("first_doc_id"))
        & (F.col("b.first_hash") == F.col("first_hash"))
        & (F.col("b.first_start") + F.col("b.size") == F.col("first_start"))
    )
    marked = chunks.withColumn("b", before).select(
        *chunks.columns, near.alias("near"), F.coalesce(near & source, F.lit(False)).alias("sure")
    )
    marked = written(marked, "borders")
    asked = written(
        marked.filter("near AND NOT sure").select(F.col("pair").alias("_pair")).distinct(), "pairs"
    )
    stood = repeated.join(small_side(asked), F.col("pair") == F.col("_pair"), "left_semi")
    earliest = stood.groupBy("pair").agg(F.min(_place()).alias("earliest"))
    earliest = written(earliest.withColumnRenamed("pair", "_pair"), "earliest")
    asking = F.when(F.col("near") & ~F.col("sure"), F.col("pair"))
    told = marked.join(small_side(earliest), asking == F.col("_pair"), "left")
    goes_on = F.col("sure") | F.coalesce(F.col("earliest") < _place(), F.lit(False))
    return told.select(*chunks.columns, (~goes_on).alias("begins"))


def copied_spans(docs: DataFrame, span_bytes: int = SPAN_BYTES) -> DataFrame:
    """Runs of copied chunks of ``span_bytes`` or more, one row each.

    ``doc_id, text_hash, start, size`` (bytes), ``n_chunks``, and where the first chunk of the
    span stands first: ``first_doc_id, first_start``. Each two neighbouring chunks of a run
    stood side by side before. The first occurrence of a passage is no copy. NULL and empty
    texts have no chunks; rows equal in id and text are one document, so have each span once.
    Columns other than ``doc_id, text`` are not read.
    """
    repeated = _repeated(docs.select("doc_id", "text"))
    chunks = _with_begins(_copied(repeated), repeated)
    key = ["doc_id", "text_hash"]
    ordered = Window.partitionBy(*key).orderBy("start")
    runs = chunks.withColumn(
        "run",
        F.sum(F.col("begins").cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
    )
    spans = runs.groupBy(*key, "run").agg(
        F.min(F.struct("start", "first_doc_id", "first_start")).alias("at"),
        F.sum("size").alias("size"),
        F.count("*").alias("n_chunks"),
    )
    return spans.filter(F.col("size") >= span_bytes).select(
        *key,
        F.col("at.start").cast("long").alias("start"),
        "size",
        "n_chunks",
        F.col("at.first_doc_id").alias("first_doc_id"),
        F.col("at.first_start").cast("long").alias("first_start"),
    )


def without_copied_spans(docs: DataFrame, span_bytes: int = SPAN_BYTES) -> DataFrame:
    """The documents with copied spans cut out of their texts, other columns as they are."""
    spans = written(copied_spans(docs, span_bytes), "spans").groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", "size"))).alias("spans")
    )
    mark, cuts = spare_name(docs, "text_hash"), spare_name(docs, "spans")
    side = spans.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("spans").alias(cuts)
    )
    keyed = docs.withColumn(mark, F.xxhash64("text"))
    joined = keyed.join(side, keyed["doc_id"].eqNullSafe(F.col("_id")) & (keyed[mark] == F.col("_hash")), "left")
    joined = joined.drop("_id", "_hash", mark)
    position = joined.columns.index("text")
    place = joined.columns.index(cuts)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column(position).to_pylist(), batch.column(place).to_pylist()):
                if gone:
                    data, kept, last = text.encode("utf-8", "surrogatepass"), [], 0
                    for span in gone:
                        kept.append(data[last : span["start"]])
                        last = span["start"] + span["size"]
                    text = b"".join([*kept, data[last:]]).decode("utf-8", "surrogatepass")
                texts.append(text)
            columns = list(batch.columns)
            columns[position] = pa.array(texts, pa.string())
            del columns[place]
            yield pa.RecordBatch.from_arrays(columns, docs_columns)

    docs_columns = list(docs.columns)
    return joined.mapInArrow(cut, docs.schema)
