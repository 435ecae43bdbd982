"""Line deduplication: exact copies, and lines within one edit of an earlier line.

The deletion neighbourhood of a line is all strings left when one character is taken away.
Lines within one edit share such a variant at the same place: a substitution leaves equal
strings, an insertion leaves the shorter line. All lines that share a variant at one place
are within one edit of each other, so the earliest of them is a witness for the rest and no
pairs are listed.

Emitting a variant per character of every line would multiply the input. Variants are
emitted only where a partner can be: one edit leaves half of a line unchanged, so lines
that share no half with another line drop out, then lines that share nothing outside some
short segment; the variants of the rest are taken within that segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.common import small_side, spare_name, written

# Shorter lines are not held against lines one edit away: many words are that close.
MIN_CHARS = 20
# A line with a word.
WORD = r"[^\x20\x09-\x0D]"
# Shortest segment whose variants are listed; longer lines use the root of their length.
SEGMENT = 16


def _place() -> Column:
    """Order of lines: by document id (NULL last), equal ids by text, then by line."""
    return F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_hash", "line_no")


def _lines(docs: DataFrame, min_chars: int = 0) -> DataFrame:
    """``place, line, line_id`` of every line with a word and enough characters."""
    exploded = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "line"),
    )
    return exploded.filter((F.length("line") >= min_chars) & F.col("line").rlike(WORD)).select(
        _place().alias("place"), "line", F.unhex(F.md5("line")).alias("line_id")
    )


def _shared(keys: DataFrame) -> DataFrame:
    """The keys that two or more different lines have; a partial aggregate, written."""
    groups = keys.groupBy("key").agg(F.min("h").alias("low"), F.max("h").alias("high"))
    return written(groups.filter("low <> high").select("key"), "shared")


def _half_keys(lines: DataFrame, *keep: str) -> DataFrame:
    """Hashes of both halves; ``m`` is the length of the shorter line of a possible pair."""
    n = F.length("line")

    def key(m: Column, side: str) -> Column:
        half = F.floor(m / 2).cast("int")
        piece = F.left("line", half) if side == "left" else F.right("line", half)
        return F.xxhash64(F.lit(side), m, piece)

    keys = [key(m, side) for m in (n - 1, n) for side in ("left", "right")]
    return lines.select(*keep, F.xxhash64("line").alias("h"), F.explode(F.array(*keys)).alias("key"))


def _segments(lines: DataFrame) -> DataFrame:
    """Per line, shorter length ``m`` and segment: a hash of all but the segment, and the segment."""
    n = F.length("line")
    sized = lines.select("*", F.explode(F.array(n - 1, n)).alias("m"))
    width = F.greatest(F.ceil(F.sqrt("m")).cast("int"), F.lit(SEGMENT))
    last = F.greatest(F.ceil(F.col("m") / width).cast("int") - 1, F.lit(0))
    placed = sized.select("*", width.alias("width"), F.explode(F.sequence(F.lit(0), last)).alias("j"))
    left = F.col("j") * F.col("width")
    right = F.greatest(F.col("m") - left - F.col("width"), F.lit(0))
    return placed.select(
        "place",
        "line_id",
        F.xxhash64("line").alias("h"),
        (n == F.col("m")).alias("short"),
        F.xxhash64(
            "m", "j", F.left("line", left), F.lit("|"), F.right("line", right)
        ).alias("key"),
        F.substring("line", left + 1, n - left - right).alias("middle"),
    )


def _variants(segments: DataFrame) -> DataFrame:
    """``place, line_id, variant``: hashed deletions at each place of the segment.

    A longer line of a pair deletes at a place what a shorter one lacks there; two lines of
    equal length both delete.
    """
    size = F.length("middle")
    at = F.col("at")
    rest = F.concat(F.left("middle", at), F.substring("middle", at + 2, size))
    ways = segments.select("*", F.explode(F.sequence(F.lit(0), size)).alias("at"))
    deleted = F.when(at < size, F.xxhash64("key", F.lit("equal"), "at", rest))
    inserted = F.when(
        F.col("short"), F.xxhash64("key", F.lit("longer"), "at", "middle")
    ).when(at < size, F.xxhash64("key", F.lit("longer"), "at", rest))
    both = F.array(F.when(F.col("short"), deleted), inserted)
    return ways.select("place", "line_id", F.explode(F.array_compact(both)).alias("variant"))


def _near(docs: DataFrame, min_chars: int) -> DataFrame:
    """``line_id, near``: lines with the place of the earliest line within one edit before them."""
    lines = _lines(docs, min_chars)
    halves = _shared(_half_keys(lines))
    partnered = _half_keys(lines, "line_id", "place").join(small_side(halves), "key", "left_semi")
    chosen = written(
        partnered.groupBy("line_id").agg(F.min("place").alias("first_place")), "candidates"
    ).withColumnRenamed("line_id", "chosen_id")
    here = (F.col("line_id") == F.col("chosen_id")) & (F.col("place") == F.col("first_place"))
    texts = written(
        lines.join(small_side(chosen, bound=250_000), here)
        .select("place", "line_id", "line")
        .dropDuplicates(["line_id"]),
        "texts",
    )
    segments = _segments(texts)
    close = _shared(segments.select("key", "h"))
    variants = written(
        _variants(segments.join(small_side(close), "key", "left_semi")), "variants"
    )
    groups = variants.groupBy("variant").agg(
        F.min(F.struct("place", "line_id")).alias("first"), F.max("line_id").alias("high"),
        F.min("line_id").alias("low"),
    )
    witnesses = written(groups.filter("low <> high").select("variant", "first"), "witnesses")
    pairs = (
        variants.join(small_side(witnesses, bound=250_000), "variant")
        .filter(F.col("first.place") < F.col("place"))
        .select("line_id", F.col("first.line_id").alias("witness_id"), F.col("first.place").alias("near"))
        .distinct()
    )
    own = texts.select("line_id", "line")
    other = texts.select(F.col("line_id").alias("witness_id"), F.col("line").alias("witness"))
    return (
        pairs.join(own, "line_id")
        .join(other, "witness_id")
        .filter(F.levenshtein("line", "witness", 1).between(0, 1))
        .groupBy("line_id")
        .agg(F.min("near").alias("near"))
    )


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per dropped line: ``doc_id, text_hash, line_no, kind, kept_doc_id, kept_line_no``.

    Lines end at line feeds and are numbered from 0. A line is dropped as ``exact`` if an
    earlier line equals it, else as ``near`` if an earlier line is within one edit (one
    character put in, taken away or replaced). The kept line named is the earliest equal
    one, or the earliest within one edit. Lines are in order of ``doc_id``, NULL last, equal
    ids by text. Lines of any length are dropped as ``exact``; as ``near`` only those of
    ``min_chars`` characters or more, against such. Lines without a word stay, and NULL and
    empty texts drop nothing. Rows equal in id and text are one document. Columns other than
    ``doc_id`` and ``text`` are not read.
    """
    docs = docs.select("doc_id", "text")
    near = written(_near(docs, min_chars), "near")
    lines = _lines(docs).select("line_id", "place")
    counted = lines.groupBy("line_id").agg(
        F.min("place").alias("first"), F.max("place").alias("last")
    )
    repeats = written(counted.filter("first <> last").select("line_id", "first"), "repeats")
    affected = written(
        repeats.join(near, "line_id", "full").withColumnRenamed("line_id", "affected_id"), "affected"
    )
    exact = F.coalesce(F.col("first") < F.col("place"), F.lit(False))
    kept = F.when(exact, F.col("first")).otherwise(F.col("near"))
    return (
        lines.join(small_side(affected), F.col("line_id") == F.col("affected_id"))
        .filter(exact | F.col("near").isNotNull())
        .select(
            "place.doc_id",
            "place.text_hash",
            "place.line_no",
            F.when(exact, "exact").otherwise("near").alias("kind"),
            kept["doc_id"].alias("kept_doc_id"),
            kept["line_no"].alias("kept_line_no"),
        )
        .distinct()
    )


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without their repeated lines, other columns as they are.

    A document that had words and has none left goes; untouched documents stay as they are.
    """
    dropped = written(repeated_lines(docs, min_chars), "dropped")
    per_document = written(
        dropped.groupBy("doc_id", "text_hash").agg(F.collect_list("line_no").alias("gone")), "per_document"
    )
    side = per_document.select(
        F.col("doc_id").alias("_dropped_id"), F.col("text_hash").alias("_dropped_hash"), "gone"
    )
    mark, gone, rest = (spare_name(docs, name) for name in ("text_hash", "gone", "rest"))
    keyed = docs.withColumn(mark, F.xxhash64("text"))
    side = side.withColumnRenamed("gone", gone)
    same = keyed["doc_id"].eqNullSafe(side["_dropped_id"]) & (keyed[mark] == side["_dropped_hash"])
    joined = keyed.join(small_side(side, bound=100_000), same, "left").drop("_dropped_id", "_dropped_hash")
    split = joined.withColumn(rest, F.when(F.col(gone).isNotNull(), F.split("text", "\n")))
    stay = F.array_except(F.sequence(F.lit(0), F.size(rest) - 1), gone)
    text = F.array_join(F.transform(stay, lambda i: F.get(rest, i)), "\n")
    cut = split.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(text))
    return cut.filter(F.col(gone).isNull() | F.col("text").rlike(WORD)).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
