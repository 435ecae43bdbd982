"""Near copies: documents that share most of their word shingles with an earlier one.

Min-hash bands name the candidates: two documents agree in a band of five minima with the
fifth power of their similarity, so of pairs at 0.8 fewer than one in ten thousand agree in
none of 24 bands. Every candidate pair is then told by its exact shingle sets. The documents
of a band are compared with its first one, and those found similar leave.

Pages of one template agree in bands without being near copies, so a large band that is left
is divided by rare shingles: two sets that share 0.8 of their union share one of their first
few shingles in any fixed order, a ninth of a set if the two are equally long. In an order
from rare to frequent, pages of a template differ in those, and none of them are compared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.common import extended, small_batches, small_side, spare_name, written

WORDS = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 24, 5
# Documents that all others of a group are compared with: one in the first round, then each
# time so many times more, so that what is left of a group takes few rounds.
MORE_LEADERS = 8
# Documents of a band from which it is divided by rare shingles.
LARGE_BAND = 64
# Counters of shingles that tell rare from frequent ones, and steps of set sizes.
COUNTERS, SIZE_STEP = 1 << 18, 1.05
# Bytes of shingle sets that may be broadcast.
BROADCAST_BYTES = 32 << 20

_SEED = 42
_FACTORS = np.random.default_rng(_SEED).integers(0, 2**63, BANDS * BAND_ROWS, dtype=np.uint64) * 2 + 1
_SLICE = 4_096  # shingles times factors held at once


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; a shorter text is one run.

    Words are runs without ASCII white space, A-Z lower-cased; a text without any has none.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    last = max(len(found) - words, 0)
    starts = [0, *(ends[:last] + 1).tolist()]
    stops = ends[len(found) - 1 - last :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[i:j], _SEED) for i, j in zip(starts, stops)]
    return np.unique(np.array(hashes, np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One signed number per band; none for an empty set."""
    if not len(hashes):
        return []
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _SLICE):
        np.minimum(least, (hashes[at : at + _SLICE, None] * _FACTORS).min(axis=0), out=least)
    rows = least.reshape(BANDS, BAND_ROWS)
    found = [xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)]
    return np.array(found, np.uint64).view(np.int64).tolist()


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sets of distinct values share ``least`` of their union."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= least * (len(a) + len(b) - common)


def _marked(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, text_hash, copy, keys`` of every document row; ``copy`` names its shingle set."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch.column(2).to_pylist()]
            copies = np.array([xxhash.xxh64_intdigest(s.tobytes(), _SEED) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(copies.view(np.int64)),
                    pa.array([band_keys(s) for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_hash", "copy", "keys"],
            )

    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    return source.mapInArrow(scan, "doc_id bigint, text_hash bigint, copy bigint, keys array<bigint>")


_SIZES = np.unique(np.ceil(SIZE_STEP ** np.arange(0, 600)).astype(np.float64))


def prefix_keys(
    hashes: np.ndarray, counts: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of which two sets of that similarity share at least one, and their sides.

    Of two sets with n and m values, similar ones share ``need`` values, so each holds one of
    the shared ones among its first n + 1 - need. Sizes are told in steps: a key names a
    shingle and the steps of both sizes, its side whether the set is the smaller (-1) or the
    larger one (1) or both are of one step (0). Sets of one side need not meet there.
    """
    n = len(hashes)
    order = np.lexsort((hashes, counts[hashes % np.uint64(len(counts))]))
    ranked = hashes[order]
    own = int(np.searchsorted(_SIZES, n, "right"))
    least = max(1, int(np.ceil(similarity * n - 1e-9)))
    low, high = (int(np.searchsorted(_SIZES, m, "right")) for m in (least, int(n / similarity + 1e-9)))
    found, sides = [], []
    for step in range(low, high + 1):
        smallest = max(least, int(_SIZES[step - 1]))
        need = int(np.ceil(similarity / (1 + similarity) * (n + smallest) - 1e-9))
        pair = np.array([min(own, step), max(own, step)], np.uint64).tobytes()
        mark = np.uint64(xxhash.xxh64_intdigest(pair, _SEED) | 1)
        found.append(ranked[: max(n + 1 - need, 0)] * mark)
        sides.append(np.full(len(found[-1]), np.sign(own - step), np.int8))
    return np.concatenate(found).view(np.int64), np.concatenate(sides)


def _counters(sets: DataFrame) -> np.ndarray:
    """How often shingles occur, by their remainder: a fixed number of counters."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                np.add.at(total, np.frombuffer(packed, np.uint64) % np.uint64(COUNTERS), 1)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["at", "n"])

    rows = sets.select("hashes").mapInArrow(scan, "at bigint, n bigint")
    found = rows.groupBy("at").agg(F.sum("n").alias("n")).toPandas()  # COUNTERS rows at most
    counts = np.zeros(COUNTERS, np.int64)
    counts[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def _divided(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Members of small bands as they are; those of large bands under their rare shingles."""
    sizes = members.groupBy("key").agg(F.count("*").alias("n"))
    large = written(sizes.filter(F.col("n") > LARGE_BAND).select(F.col("key").alias("_key")), "large")
    if large.isEmpty():
        return members
    within = small_side(large)
    small = members.join(within, F.col("key") == F.col("_key"), "left_anti")
    crowded = members.join(within, F.col("key") == F.col("_key"), "left_semi")
    named = written(crowded.select(F.col("copy").alias("_copy")).distinct(), "crowded")
    own = sets.join(small_side(named), F.col("copy") == F.col("_copy"), "left_semi")
    counts = members.sparkSession.sparkContext.broadcast(_counters(own))  # COUNTERS numbers
    types = extended(own.select("copy", "place"), "keys array<bigint>, sides array<tinyint>")

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [
                prefix_keys(np.frombuffer(packed, np.uint64), counts.value, similarity)
                for packed in batch.column(2).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([k for k, _ in keys], pa.list_(pa.int64())),
                    pa.array([s for _, s in keys], pa.list_(pa.int8())),
                ],
                types.names,
            )

    rare = own.select("copy", "place", "hashes").mapInArrow(scan, types)
    rare = rare.select("copy", F.explode(F.arrays_zip("keys", "sides")).alias("of"), "place")
    rare = rare.select("copy", F.col("of.keys").alias("key"), F.col("of.sides").alias("side"), "place")
    out = written(_shared(written(rare, "rare")).unionByName(small), "divided")
    counts.destroy()
    return out


def _shared(members: DataFrame) -> DataFrame:
    """The rows of the keys that two or more copies have, on both sides if it has sides."""
    keys = members.groupBy("key").agg(
        F.min("copy").alias("low"),
        F.max("copy").alias("high"),
        (F.min("side") * F.max("side")).alias("sides"),
    )
    met = keys.filter("low <> high AND sides <= 0")
    several = written(met.select(F.col("key").alias("_key")), "shared")
    return members.join(small_side(several), F.col("key") == F.col("_key"), "left_semi")


def _sets(docs: DataFrame, firsts: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """``copy, place, hashes`` of the copies among ``members``, from their first document."""
    wanted = members.select(F.col("copy").alias("_copy")).distinct()
    chosen = written(
        firsts.join(wanted, F.col("copy") == F.col("_copy"), "left_semi").select(
            "copy", "place", F.col("place.doc_id").alias("_id"), F.col("place.text_hash").alias("_hash")
        ),
        "chosen",
    )
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    same = source["doc_id"].eqNullSafe(chosen["_id"]) & (source["h"] == chosen["_hash"])
    texts = source.join(small_side(chosen, bound=250_000), same).select("copy", "place", "text")
    types = texts.drop("text").schema.add("hashes", "binary")

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, words).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.binary())], types.names
            )

    return texts.mapInArrow(scan, types).dropDuplicates(["copy"])


def _told(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The later copy of every similar one of the ``(leader, copy)`` pairs."""
    leaders = pairs.select("leader").distinct()
    led = written(
        sets.join(leaders, F.col("copy") == F.col("leader"), "left_semi").select(
            F.col("copy").alias("_leader"),
            F.col("place").alias("leader_place"),
            F.col("hashes").alias("leader_hashes"),
        ),
        "leaders",
    )
    own = pairs.join(sets.withColumnRenamed("copy", "_copy"), F.col("copy") == F.col("_copy"))
    held = led.agg(F.sum(F.length("leader_hashes") + 64)).first()[0] or 0
    side = F.broadcast(led) if held <= BROADCAST_BYTES else led
    both = own.join(side, F.col("leader") == F.col("_leader"))
    later = F.when(F.col("place") > F.col("leader_place"), F.col("copy")).otherwise(F.col("leader"))

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ways = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            near = [similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), similarity) for a, b in ways]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(near, pa.bool_()))], ["gone"])

    rows = both.select(later.alias("late"), "hashes", "leader_hashes")
    return rows.mapInArrow(check, "gone bigint").distinct()


def _gone(docs: DataFrame, firsts: DataFrame, words: int, similarity: float) -> DataFrame | None:
    """``gone``: copies similar to an earlier one, by rounds over what is not yet compared."""
    spark = docs.sparkSession
    members = written(
        _shared(
            written(
                firsts.select("copy", F.explode("keys").alias("key"), F.lit(0).cast("tinyint").alias("side")),
                "bands",
            )
        ),
        "members",
    )
    if members.isEmpty():
        return None
    sets = written(_sets(docs, firsts, members, words), "sets")
    members = written(
        members.join(
            sets.select(F.col("copy").alias("_copy"), "place"), F.col("copy") == F.col("_copy")
        ).drop("_copy"),
        "members",
    )
    every = None
    salts = 1
    while not members.isEmpty():
        part = F.pmod(F.xxhash64("copy"), F.lit(salts))
        chosen = members.groupBy("key", part.alias("part")).agg(F.min(F.struct("place", "copy")).alias("first"))
        chosen = written(
            chosen.select(F.col("key").alias("_key"), F.col("first.copy").alias("leader")), "chosen"
        )
        met = members.join(small_side(chosen), F.col("key") == F.col("_key")).filter("copy <> leader")
        pairs = written(met.select("leader", "copy").distinct(), "pairs")
        found = written(_told(pairs, sets, similarity), "gone")
        every = found if every is None else every.unionByName(found)
        led = (F.col("key") == F.col("_key")) & (F.col("copy") == F.col("leader"))
        left = members.join(small_side(found), F.col("copy") == F.col("gone"), "left_anti")
        left = written(left.join(small_side(chosen), led, "left_anti"), "left")
        members = written(_shared(left), "members")
        if salts == 1:
            members = _divided(members, sets, similarity)
        salts *= MORE_LEADERS
    return written(every.distinct(), "all-gone")


def first_of_near_copies(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """The documents without near copies of earlier ones, all columns as they are.

    Two documents are near copies if they share ``similarity`` or more of the union of their
    shingles of ``words`` words. Of two near copies the later goes, or both if a third one
    before them is a near copy of the earlier; a document that goes has an earlier near copy.
    Documents are in order of ``doc_id`` (NULL last), equal ids by text; texts with equal
    shingles are copies, blank ones among each other too.
    """
    marked = written(_marked(docs, words), "marked")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash")
    firsts = written(
        marked.groupBy("copy")
        .agg(F.min(F.struct(place.alias("place"), "keys")).alias("first"))
        .select("copy", "first.place", "first.keys"),
        "firsts",
    )
    gone = _gone(docs, firsts, words, similarity)
    stay = firsts
    if gone is not None:
        stay = firsts.join(small_side(gone), F.col("copy") == F.col("gone"), "left_anti")
    keys = written(
        stay.select(F.col("place.doc_id").alias("_id"), F.col("place.text_hash").alias("_hash")), "kept"
    )
    mark = spare_name(docs, "text_hash")
    keyed = docs.withColumn(mark, F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(keys["_id"]) & (keyed[mark] == keys["_hash"])
    kept = keyed.join(small_side(keys), same, "left_semi")
    repeats = marked.groupBy("doc_id", "text_hash").count().filter("count > 1")
    if not repeats.isEmpty():
        kept = kept.dropDuplicates(["doc_id", mark])
    return kept.drop(mark)
