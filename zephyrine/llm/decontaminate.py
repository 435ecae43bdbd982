"""Benchmark decontamination through a positional index of the training documents.

Items are cut into windows of consecutive words. The index keeps postings, with the words
around them, of the rarest term of each window only; a posting is stored if the second
rarest term stands where, or near where, some window wants it. Windows then meet the
postings of their rarest term and compare the remaining terms at their offsets.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zephyrine.llm.common import BROADCAST_ROWS, small_side, spare_name, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Windows (about 200 bytes each) that may be broadcast.
BROADCAST_WINDOWS = 100_000

# The term that stands for "this document exists"; no word is empty.
_DOCUMENT = ""
_KEY = ("doc_id", "text_hash")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    other = text.rlike(r"[^\x00-\x7F]")
    return F.when(other, F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def words(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased; NULL has none."""
    lowered = ascii_lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, WORD_BREAKS), "")


def item_windows(items: DataFrame, length: int = 10) -> DataFrame:
    """``(item_id, window)`` of every run of ``length`` words; shorter items are one window."""
    split = items.select("item_id", words(F.col("text")).alias("terms")).filter(F.size("terms") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("terms") - length + 1, F.lit(1)))
    return (
        split.withColumn("at", F.explode(starts))
        .select("item_id", F.slice("terms", F.col("at"), F.lit(length)).alias("window"))
        .distinct()
    )


def _anchored(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows with the offsets of their two rarest terms over all documents.

    A window with a term that no document has is left out: it occurs nowhere.
    """
    places = windows.select("window_id", "window", F.posexplode("window").alias("offset", "term"))
    vocabulary = written(places.select("term").distinct(), "vocabulary")
    counts = (
        docs.select(F.explode(words(F.col("text"))).alias("term"))
        .join(small_side(vocabulary), "term")
        .groupBy("term")
        .agg(F.count("*").alias("postings"))
    )
    ranked = places.join(written(counts, "counts"), "term").groupBy("window_id").agg(
        F.first("window").alias("window"),
        F.sort_array(F.collect_list(F.struct("postings", "offset", "term"))).alias("rare"),
    )
    rare = F.col("rare")
    second = F.get(rare, F.least(F.size(rare) - 1, F.lit(1)))
    return ranked.filter(F.size(rare) == F.size("window")).select(
        "window_id",
        "window",
        rare[0]["term"].alias("term"),
        rare[0]["offset"].alias("offset"),
        second["term"].alias("second"),
        (second["offset"] - rare[0]["offset"]).alias("delta"),
    )


def _index(docs: DataFrame, anchors: DataFrame, reach: int, slop: int) -> DataFrame:
    """Postings ``(doc_id, text_hash, n_words, term, pos, first, around)`` of the rarest terms.

    ``around`` holds the words from position ``first``, up to ``reach`` on either side.
    Every document also has a posting of the empty term.
    """
    pairs = written(
        anchors.groupBy("term").agg(F.collect_set(F.struct("second", "delta")).alias("pairs")), "anchors"
    )
    count = pairs.count()
    terms = F.col("terms")
    at = F.col("pos") - 1
    first = F.greatest(at - reach, F.lit(0))
    marked = docs.select(
        F.col("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        words(F.col("text")).alias("terms"),
    )
    tokens = marked.select(
        *_KEY, "terms", F.posexplode(F.concat(F.array(F.lit(_DOCUMENT)), terms)).alias("pos", "term")
    )
    parts = max(1, math.ceil(count / BROADCAST_ROWS))
    marker = pairs.sparkSession.range(1).select(F.lit(_DOCUMENT).alias("term"))
    found = []
    for part in range(parts):  # one pass over the documents per broadcast's worth of terms
        sought = pairs.select("term").filter(F.pmod(F.xxhash64("term"), F.lit(parts)) == part)
        if not part:
            sought = sought.unionByName(marker)
        # This join stays free of lambdas: then the word list is not copied for every word.
        found.append(tokens.join(F.broadcast(sought), "term", "left_semi"))
    listed = reduce(DataFrame.unionByName, found).select(
        *_KEY,
        F.when(F.col("pos") == 0, F.size(terms)).cast("long").alias("n_words"),
        "term",
        at.alias("pos"),
        first.alias("first"),
        F.when(F.col("pos") > 0, F.slice(terms, first + 1, at - first + reach + 1)).alias("around"),
    )

    def beside(pair: Column) -> Column:
        place = F.col("pos") + pair["delta"] - F.col("first")
        if not slop:
            return F.get("around", place) == pair["second"]
        low = F.greatest(place - slop, F.lit(0))
        stop = F.greatest(place + slop + 1, low)
        return F.array_contains(F.slice("around", low + 1, stop - low), pair["second"])

    wanted = small_side(pairs.withColumnRenamed("term", "anchor"), count)
    met = listed.join(wanted, F.col("term") == F.col("anchor"), "left")
    together = F.coalesce(F.exists("pairs", beside), F.col("term") == _DOCUMENT)
    return met.filter(together).select(*listed.columns)


def positional_matches(
    docs: DataFrame, windows: DataFrame, length: int = 10, slop: int = 0
) -> tuple[DataFrame, DataFrame]:
    """``(documents, matches)``: one row per document row, and where windows occur in them.

    ``windows`` has ``window_id`` and ``window`` (distinct word lists of up to ``length``).
    ``documents`` has ``doc_id, text_hash, n_words``. ``matches`` has ``doc_id, text_hash,
    window_id, start, length, exact``: the words from ``start`` are the window (exact), or,
    with a ``slop``, all its words stand in any order between ``slop`` words before that
    place and ``slop`` words after it. Rows equal in ``doc_id`` and text share matches.
    """
    anchors = written(_anchored(docs, windows), "windows")
    reach = length - 1 + slop
    index = written(_index(docs, anchors, reach, slop), "postings")
    documents = index.filter(F.col("term") == _DOCUMENT).select(*_KEY, "n_words")
    sought = small_side(
        anchors.select("window_id", "window", "term", "offset"), bound=BROADCAST_WINDOWS
    )
    start = F.col("pos") - F.col("offset")
    size = F.size("window")
    here = F.slice("around", start - F.col("first") + 1, size)
    exact = (start >= F.col("first")) & F.coalesce(
        F.when(start >= F.col("first"), here == F.col("window")), F.lit(False)
    )
    found = exact
    if slop:
        low = F.greatest(start - slop, F.col("first"))
        near = F.slice("around", low - F.col("first") + 1, start + size + slop - low)
        found = exact | (F.size(F.array_except("window", near)) == 0)
    matches = (
        index.filter(F.col("term") != _DOCUMENT)
        .join(sought, "term")
        .filter(found)
        .select(
            *_KEY,
            "window_id",
            start.cast("long").alias("start"),
            size.cast("long").alias("length"),
            exact.alias("exact"),
        )
        .distinct()
    )
    return documents, matches


def _same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])


def contamination(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """Per document row: ``doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated``.

    A word is hit if it lies in any exact occurrence of a window; ``n_items`` counts the ids
    of items with occurring windows and ``items_sha256`` digests them (sorted as text,
    comma-joined; of the empty text if there are none). Items with a NULL id hit words but
    are not counted. Repeated documents each get the full result, repeated items count once,
    empty tables give no rows or no hits. Columns other than ids and texts are not read.
    """
    docs = docs.select("doc_id", "text")
    listed = written(item_windows(items.select("item_id", "text"), length), "items")
    windows = written(
        listed.select("window").distinct().withColumn("window_id", F.monotonically_increasing_id()),
        "windows",
    )
    documents, matches = positional_matches(docs, windows, length)
    matches = written(matches.filter("exact"), "matches")

    ordered = Window.partitionBy(*_KEY).orderBy("start")
    reached = F.max(F.col("start") + F.col("length")).over(
        ordered.rowsBetween(Window.unboundedPreceding, -1)
    )
    spans = matches.groupBy(*_KEY, "start").agg(F.max("length").alias("length"))
    end = F.col("start") + F.col("length")
    fresh = spans.select(
        *_KEY,
        F.greatest(end - F.greatest("start", F.coalesce(reached, F.lit(0))), F.lit(0)).alias("fresh"),
    )
    hits = fresh.groupBy(*_KEY).agg(F.sum("fresh").alias("n_hit"))

    ids = listed.join(windows, "window").select("window_id", F.col("item_id").cast("string").alias("item"))
    found = matches.select(*_KEY, "window_id").distinct().join(ids, "window_id")
    named = found.groupBy(*_KEY).agg(F.sort_array(F.collect_set("item")).alias("items"))

    sums = hits.join(named, _same_document(hits, named), "left").select(
        hits["doc_id"], hits["text_hash"], "n_hit", "items"
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return documents.join(sums, _same_document(documents, sums), "left").select(
        documents["doc_id"],
        documents["text_hash"],
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items_found).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """The documents no window occurs in, with all their columns."""
    judged = contamination(docs, items, length).filter("contaminated").select(*_KEY).distinct()
    flagged = written(judged, "contaminated")
    mark = spare_name(docs, "text_hash")
    keyed = docs.withColumn(mark, F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(flagged["doc_id"]) & (keyed[mark] == flagged["text_hash"])
    return keyed.join(small_side(flagged), same, "left_anti").drop(mark)
