"""SentencePiece encoding and decoding, giant documents by a max-plus parallel scan.

Byte-pair encoding has a local form: a sequence of pieces is the encoding of its text if and
only if merging the text of each two neighbours gives back these two. So the encoding is the
one path of weight 0 through the lattice of pieces whose steps weigh 0 if the neighbours
stand side by side that way, and minus infinity if not.

A giant document is cut into chunks. At a chunk border the state is the piece that covers
the character before it. Each chunk yields its transfer matrix from the states at its left
border to those at its right one; matrices are combined by max-plus products in a tree;
going down the tree fixes the state at every border, and each chunk is then traced back by
itself. Pieces never run from another character into a space mark, so paths meet where a
word begins: short documents and the inside of chunks are encoded word by word.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.llm.common import small_batches, written

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"

# Characters of a chunk, and matrices multiplied by one task.
CHUNK = 16_384
FAN = 64
# Words a worker remembers before it lets go of those not met since the last time (about
# 200 bytes each), and the longest word worth remembering.
REMEMBERED = 64_000
SHORT = 64

_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN_UNITS = f"{MARK}*[^{MARK}]+|{MARK}+"
_UNITS = f"{MARK}*[{_LETTERS}]+|{MARK}*[^{MARK}{_LETTERS}]+|{MARK}+"
# A piece in which letters meet other characters than marks in front of them.
_MIXED = re.compile(f"[{_LETTERS}][^{_LETTERS}]|[^{MARK}{_LETTERS}][{_LETTERS}]")
_CUT = re.compile(f"(?<=[^{MARK}]){MARK}")
_UNREACHED = object()


class _Words(dict):
    """Packed ids of short words, filled on demand. When it holds many, it begins anew and takes
    from the older ones what is met again, so frequent words stay."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        pieces = self.pieces
        if len(word) > SHORT:
            return pieces.packed(pieces.trace(word, 0, len(word), None))
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        found = self.older.get(word)
        if found is None:
            found = pieces.packed(pieces.merge(word))
        self[word] = found
        return found


@dataclass
class Pieces:
    """The vocabulary of a byte-pair model and the two ways to encode with it.

    ``ranks`` orders pieces by score, the best first; equal scores share a rank.
    """

    ids: dict[str, int]
    ranks: dict[str, int]
    bytes_from: int
    texts: list[bytes]
    longest: int = 0
    units: str = _PLAIN_UNITS
    words: _Words | None = None
    neighbours: dict[tuple[str, str], bool] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.ids), default=1)
        if not any(map(_MIXED.search, self.ids)):  # then paths also meet where a word ends
            self.units = _UNITS

    def __getstate__(self) -> dict:
        return {**self.__dict__, "words": None, "neighbours": {}}

    def merge(self, text: str) -> list[str]:
        """Merges the best neighbours, the leftmost of equal ones, until none is a piece."""
        parts = list(text)
        rank, none = self.ranks.get, len(self.ranks)
        ranks = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            parts[at] += parts.pop(at + 1)
            ranks.pop(at)
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], none)
        return parts

    def stand(self, left: str | None, right: str) -> bool:
        """Whether the two are neighbours in the encoding of their text."""
        if left is None or left not in self.ids or right not in self.ids:
            return True
        key = (left, right)
        known = self.neighbours.get(key)
        if known is None:
            if len(self.neighbours) >= REMEMBERED:
                self.neighbours.clear()
            known = self.neighbours[key] = self.merge(left + right) == [left, right]
        return known

    def reach(self, text: str, begin: int, stop: int, before: str | None) -> dict[int, str | None]:
        """The last piece of the path from ``begin`` to each position it reaches up to ``stop``."""
        last: dict[int, str | None] = {begin: before}
        for end in range(begin + 1, stop + 1):
            for size in range(min(self.longest, end - begin), 0, -1):
                previous = last.get(end - size, _UNREACHED)
                if previous is _UNREACHED:
                    continue
                piece = text[end - size : end]
                if (size == 1 or piece in self.ids) and self.stand(previous, piece):
                    last[end] = piece
                    break
        return last

    def trace(self, text: str, begin: int, stop: int, before: str | None) -> list[str]:
        last = self.reach(text, begin, stop, before)
        found: list[str] = []
        while stop > begin:
            piece = last[stop]
            found.append(piece)
            stop -= len(piece)
        return found[::-1]

    def packed(self, pieces: Iterable[str]) -> bytes:
        """The ids as 32-bit numbers; characters without a piece become their bytes."""
        numbers: list[int] = []
        for piece in pieces:
            known = self.ids.get(piece)
            if known is None:
                numbers += [self.bytes_from + b for b in piece.encode("utf-8", "surrogatepass")]
            else:
                numbers.append(known)
        return array("i", numbers).tobytes()

    def encode_words(self, text: str) -> bytes:
        """Ids of marked text that begins and ends where paths meet."""
        if self.words is None:
            self.words = _Words(self)
        return b"".join(map(self.words.__getitem__, re.findall(self.units, text)))

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_words(marked(text)), np.int32)

    def decode(self, ids: Iterable[int] | None) -> str | None:
        """The text of ids; byte pieces that are no UTF-8 become replacement characters."""
        if ids is None:
            return None
        joined = b"".join(map(self.texts.__getitem__, ids))
        return joined.removeprefix(b" ").decode("utf-8", "replace")


def marked(text: str | None) -> str:
    """Spaces as marks, and a mark in front; nothing for an empty or NULL text."""
    return MARK + text.replace(" ", MARK) if text else ""


def load_pieces(path: str = MODEL) -> Pieces:
    """Reads a byte-pair model with byte fallback on the driver; tasks get its pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, texts = {}, []
    scores: dict[str, float] = {}
    bytes_from = -1
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            bytes_from = i if value == 0 else bytes_from
            texts.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            texts.append(b"")
        else:
            ids[piece], scores[piece] = i, model.get_score(i)
            texts.append(piece.replace(MARK, " ").encode())
    if bytes_from < 0:
        raise ValueError(f"{path} has no byte pieces")
    places = {score: k for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
    return Pieces(ids, {p: places[score] for p, score in scores.items()}, bytes_from, texts)


@dataclass(frozen=True)
class Chunk:
    """A stretch ``begin`` to ``stop`` of a document, with the text some way around it."""

    text: str
    begin: int
    stop: int
    first: bool
    last: bool


def cut(text: str, size: int, around: int) -> Iterator[Chunk]:
    """Chunks of ``size`` characters, the last one up to twice that."""
    count = max(1, len(text) // size)
    for k in range(count):
        begin, stop = k * size, len(text) if k == count - 1 else (k + 1) * size
        low = max(0, begin - around)
        near = text[low : stop + around]
        yield Chunk(near, begin - low, stop - low, k == 0, k == count - 1)


def states(pieces: Pieces, chunk: Chunk, right: bool) -> list[tuple[int, int]]:
    """Pieces covering the character before a border, or the border itself where paths meet."""
    at, text = (chunk.stop, chunk.text) if right else (chunk.begin, chunk.text)
    ends = chunk.last if right else chunk.first
    if ends or (text[at] == MARK and text[at - 1] != MARK):
        return [(at, at)]
    return [
        (i, j)
        for i in range(max(0, at - pieces.longest), at)
        for j in range(at, min(i + pieces.longest, len(text)) + 1)
        if j - i == 1 or text[i:j] in pieces.ids
    ]


def _leave(
    pieces: Pieces, chunk: Chunk, begin: int, before: str | None, leaving: list[tuple[int, int]]
) -> list[float]:
    """Weight of the path from ``begin`` to each leaving state."""
    last = pieces.reach(chunk.text, begin, chunk.stop, before)

    def weight(i: int, j: int) -> float:
        if i not in last:
            return -np.inf
        return 0.0 if i == j or pieces.stand(last[i], chunk.text[i:j]) else -np.inf

    return [weight(i, j) for i, j in leaving]


def _meetings(chunk: Chunk, after: int) -> tuple[int, int] | None:
    """First and last place, from ``after`` to the right border, where all paths meet."""
    found = [m.start() for m in _CUT.finditer(chunk.text, max(after, 1), chunk.stop + 1)]
    found = [p for p in found if p <= chunk.stop]
    return (found[0], found[-1]) if found else None


def transfer(pieces: Pieces, chunk: Chunk) -> np.ndarray:
    """Max-plus matrix from the states at the left border to those at the right one."""
    entering, leaving = states(pieces, chunk, False), states(pieces, chunk, True)
    meet = _meetings(chunk, max(j for _, j in entering))
    tail = _leave(pieces, chunk, meet[1], None, leaving) if meet else None
    rows = []
    for i, j in entering:
        before = chunk.text[i:j] or None
        if meet:
            reached = meet[0] in pieces.reach(chunk.text, j, meet[0], before)
            rows.append(tail if reached else [-np.inf] * len(leaving))
        else:
            rows.append(_leave(pieces, chunk, j, before, leaving))
    return np.array(rows)


def traced(pieces: Pieces, chunk: Chunk, enter: int, leave: int) -> bytes:
    """Ids of the pieces that begin in the chunk, given the states at its borders."""
    i, j = states(pieces, chunk, False)[enter]
    x, y = states(pieces, chunk, True)[leave]
    before, text = chunk.text[i:j] or None, chunk.text
    meet = _meetings(Chunk(text, chunk.begin, x, False, False), j)
    if meet:
        ids = pieces.packed(pieces.trace(text, j, meet[0], before))
        ids += pieces.encode_words(text[meet[0] : meet[1]])
        ids += pieces.packed(pieces.trace(text, meet[1], x, None))
    else:
        ids = pieces.packed(pieces.trace(text, j, x, before))
    return ids + (pieces.packed([text[x:y]]) if y > x else b"")


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left[:, :, None] + right[None, :, :]).max(axis=1)


def inner_states(matrices: list[np.ndarray], enter: int, leave: int) -> list[tuple[int, int]]:
    """States at the borders of each matrix on the best path from ``enter`` to ``leave``."""
    ahead = [np.full(matrices[-1].shape[1], -np.inf)]
    ahead[0][leave] = 0.0
    for matrix in reversed(matrices):
        ahead.append((matrix + ahead[-1][None, :]).max(axis=1))
    ahead.reverse()
    found = []
    for k, matrix in enumerate(matrices):
        following = int(np.argmax(matrix[enter] + ahead[k + 1]))
        found.append((enter, following))
        enter = following
    return found


def _pack(matrix: np.ndarray) -> tuple[int, bytes]:
    return matrix.shape[0], np.ascontiguousarray(matrix, np.float64).tobytes()


def _unpack(rows: int, packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.float64).reshape(rows, -1)


_KEY = ["doc_id", "text_hash"]
_KEY_TYPES = "doc_id bigint, text_hash bigint"
_CHUNK_TYPES = (
    f"{_KEY_TYPES}, chunk int, text string, start int, stop int, is_first boolean, is_last boolean"
)


def _chunk(row: dict) -> Chunk:
    return Chunk(row["text"], row["start"], row["stop"], row["is_first"], row["is_last"])


def _encode_giants(giants: DataFrame, shared, size: int) -> DataFrame:
    """``doc_id, text_hash, ids`` of documents of two chunks or more."""

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = shared.value.longest
        for batch in batches:
            for row in batch.to_pylist():
                found = [
                    {
                        "doc_id": row["doc_id"],
                        "text_hash": row["text_hash"],
                        "chunk": k,
                        "text": c.text,
                        "start": c.begin,
                        "stop": c.stop,
                        "is_first": c.first,
                        "is_last": c.last,
                    }
                    for k, c in enumerate(cut(marked(row["text"]), size, around))
                ]
                for at in range(0, len(found), 64):
                    yield pa.RecordBatch.from_pylist(found[at : at + 64], schema=_arrow(_CHUNK_TYPES))

    def transfers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                rows, packed = _pack(transfer(shared.value, _chunk(row)))
                found.append({**{k: row[k] for k in (*_KEY, "chunk")}, "n": rows, "m": packed})
            yield pa.RecordBatch.from_pylist(found, schema=_arrow(_LEVEL_TYPES))

    def trace_back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                packed = traced(shared.value, _chunk(row), row["enter"], row["leave"])
                found.append(
                    {**{k: row[k] for k in (*_KEY, "chunk")}, "ids": np.frombuffer(packed, np.int32)}
                )
            yield pa.RecordBatch.from_pylist(found, schema=_arrow(_IDS_TYPES))

    cut_up = giants.mapInArrow(chunks, _CHUNK_TYPES).dropDuplicates([*_KEY, "chunk"])
    level = written(cut_up.mapInArrow(transfers, _LEVEL_TYPES), "transfers")
    borders = _borders(level)
    placed = cut_up.join(borders, _same_chunk(cut_up, borders)).select(
        *[cut_up[c] for c in cut_up.columns], "enter", "leave"
    )
    traced_back = placed.mapInArrow(trace_back, _IDS_TYPES)
    return traced_back.groupBy(*_KEY).agg(
        F.flatten(F.sort_array(F.collect_list(F.struct("chunk", "ids")))["ids"]).alias("ids")
    )


_LEVEL_TYPES = f"{_KEY_TYPES}, chunk int, n int, m binary"
_STATE_TYPES = f"{_KEY_TYPES}, chunk int, enter int, leave int"
_IDS_TYPES = f"{_KEY_TYPES}, chunk int, ids array<int>"


def _arrow(types: str) -> pa.Schema:
    kinds = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
        "array<int>": pa.list_(pa.int32()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (t.split() for t in types.split(", "))])


def _same_chunk(left: DataFrame, right: DataFrame):
    return (
        left["doc_id"].eqNullSafe(right["doc_id"])
        & (left["text_hash"] == right["text_hash"])
        & (left["chunk"] == right["chunk"])
    )


def _borders(level: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, chunk, enter, leave)``: products up a tree, then states down it."""

    def multiply(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        total = None
        for n, m in zip(rows["n"], rows["m"]):
            matrix = _unpack(n, m)
            total = matrix if total is None else product(total, matrix)
        n, packed = _pack(total)
        first = rows.iloc[0]
        return pd.DataFrame(
            {
                "doc_id": [first["doc_id"]],
                "text_hash": [first["text_hash"]],
                "chunk": [first["chunk"] // FAN],
                "n": [n],
                "m": [packed],
            }
        )

    def descend(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        matrices = [_unpack(n, m) for n, m in zip(rows["n"], rows["m"])]
        found = inner_states(matrices, int(rows["enter"].iloc[0]), int(rows["leave"].iloc[0]))
        return rows[[*_KEY, "chunk"]].assign(
            enter=[a for a, _ in found], leave=[b for _, b in found]
        )

    parent = (F.floor(F.col("chunk") / FAN)).cast("int")
    levels = [level]
    most = level.agg(F.max("chunk")).first()[0] or 0
    while most > 0:
        grouped = levels[-1].groupBy(*_KEY, parent.alias("parent"))
        levels.append(written(grouped.applyInPandas(multiply, _LEVEL_TYPES), "products"))
        most //= FAN
    states_of = levels[-1].select(*_KEY, "chunk", F.lit(0).alias("enter"), F.lit(0).alias("leave"))
    for below in reversed(levels[:-1]):
        up = states_of.select(
            F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
            F.col("chunk").alias("_chunk"), "enter", "leave",
        )
        same = below["doc_id"].eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        joined = below.withColumn("parent", parent).join(up, same & (F.col("parent") == F.col("_chunk")))
        grouped = joined.groupBy(*_KEY, "parent")
        states_of = written(grouped.applyInPandas(descend, _STATE_TYPES), "borders")
    return states_of


def encode(docs: DataFrame, pieces: Pieces, chunk: int = CHUNK) -> DataFrame:
    """One row per document row: ``doc_id, text_hash, n_tokens, ids``.

    The ids are those of the model's own library. ``text_hash`` is the xxhash64 of the text.
    NULL and empty texts have no ids. A literal U+2581 counts as a space, as in the model.
    Documents of two chunks or more are spread over tasks by chunk; rows equal in id and text
    are encoded once and each returned. Columns other than ``doc_id, text`` are not read.
    """
    if chunk < 2 * pieces.longest:
        raise ValueError("a chunk must hold two pieces of any length")
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(pieces)
    text = F.coalesce("text", F.lit(""))
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "text"
    )
    giant = F.length("text") + 1 >= 2 * chunk

    def encode_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [shared.value.encode(t) for t in batch.column(2).to_pylist()]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            values = np.concatenate([*ids, np.zeros(0, np.int32)])
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists], ["doc_id", "text_hash", "ids"]
            )

    short = source.filter(~giant).mapInArrow(encode_rows, f"{_KEY_TYPES}, ids array<int>")
    giants = source.filter(giant)
    keys = giants.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    found = _encode_giants(giants, shared, chunk)
    same = found["doc_id"].eqNullSafe(keys["_id"]) & (found["text_hash"] == keys["_hash"])
    long = keys.join(found, same).select(*_KEY, "ids")
    both = short.unionByName(long)
    return both.select(*_KEY, F.size("ids").cast("long").alias("n_tokens"), "ids")


def decode(tokens: DataFrame, pieces: Pieces, keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``text``: the text of ``ids``, NULL for NULL."""
    keep = list(keep)
    spark: SparkSession = tokens.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(pieces)
    schema = tokens.select(*keep).schema

    def decode_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            numbers, ends = lists.flatten().to_numpy(), lists.value_lengths().fill_null(0).to_numpy().cumsum()
            texts = [
                shared.value.decode(numbers[begin:end].tolist() if known else None)
                for begin, end, known in zip([0, *ends[:-1]], ends, lists.is_valid().to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), *batch.columns[1:]], ["text", *keep]
            )

    types = ", ".join(["text string", *[f"`{f.name}` {f.dataType.simpleString()}" for f in schema]])
    return tokens.select("ids", *keep).mapInArrow(decode_rows, types).select(*keep, "text")


def encode_and_check(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """``encode`` with ``round_trip``: whether decoding gives the text, space marks as spaces."""
    plain = docs.select("doc_id", F.replace("text", F.lit(MARK), F.lit(" ")).alias("text"))
    tokens = encode(plain, pieces)
    told = decode(tokens, pieces, ("doc_id", "text_hash", "n_tokens", "ids"))
    return told.select(
        "doc_id", "n_tokens", "ids", (F.xxhash64("text") == F.col("text_hash")).alias("round_trip")
    )
