"""Quality rules: hard limits on text statistics, then robust multivariate outliers.

Statistics of a text become a short vector of logarithms. Per language and source, a
minimum-covariance-determinant estimate finds the centre and spread of the bulk: from a
start by medians and median deviations, concentration steps keep the rows nearest to the
current estimate and estimate anew from those. Rows at a large Mahalanobis distance are
rejected. Estimates are aggregates per group; factors and distances are column arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.llm.common import small_side, written

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

# Groups with fewer rows are pooled by language; those of small languages are held against all rows.
POOL_ROWS = 500
# Share of the rows that the estimates rest on.
BULK = 0.75
STEPS = 4
# Spread, in logarithms, below which differences of a statistic mean nothing.
FLOORS = {"word_length": 0.1, "symbols": 0.5, "repeats": 0.75, "dup_lines": 0.5}
# The half-way point of a squared distance in four dimensions, and the limit (1 in 20 million).
MEDIAN_DISTANCE = 3.357
LIMIT = 40.0
# Estimates (about 200 bytes a group) that may be broadcast; larger sets are joined salted.
BROADCAST_GROUPS = 50_000
SALTS = 32

_VECTOR = tuple(FLOORS)
# The pool of all rows that pass the hard limits.
EVERY = "all"


def _neighbours(values: Column) -> Column:
    """Pairs of consecutive elements; NULL for NULL, empty for fewer than two."""
    size = F.greatest(F.size(values) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(values, F.lit(1), size).alias("a"), F.slice(values, F.lit(2), size).alias("b")
    )


def text_statistics(docs: DataFrame, keep: Sequence[str] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` and ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``.

    Words are runs without ASCII white space; a NULL text has none. A word repeats if a
    three-word window over it occurs twice or more in the text.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select(
        *keep,
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    windows = F.greatest(F.size("words") - 2, F.lit(0))
    triples = F.arrays_zip(
        *[F.slice("words", F.lit(k), windows).alias(name) for k, name in ((1, "a"), (2, "b"), (3, "c"))]
    )
    hashed = split.select(
        *keep,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"])).alias("hashes"),
    )
    fixed = [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    places = F.sequence(F.lit(0), F.size("hashes") - 1)
    ordered = hashed.select(
        *fixed,
        F.when(
            repeated, F.sort_array(F.arrays_zip(F.col("hashes").alias("h"), places.alias("at")))
        ).alias("ordered"),
    )
    equal = ordered.select(
        *fixed,
        F.filter(_neighbours(F.col("ordered")), lambda p: p["a"]["h"] == p["b"]["h"]).alias("equal"),
    )
    at = equal.select(
        *fixed,
        F.sort_array(
            F.array_distinct(
                F.concat(
                    F.transform("equal", lambda p: p["a"]["at"]),
                    F.transform("equal", lambda p: p["b"]["at"]),
                )
            )
        ).alias("starts"),
    )
    covered = F.aggregate(
        _neighbours(F.col("starts")),
        F.lit(3),
        lambda total, p: total + F.least(p["b"] - p["a"], F.lit(3)),
    )
    return at.select(*fixed, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def statistic_vector() -> list[Column]:
    """Mean word length, and symbols, repeated words and lines relative to the length, as logs."""
    words = F.col("n_words") + 1
    return [
        F.log((F.col("word_chars") + 1) / words).alias("word_length"),
        F.log1p(1000 * F.col("n_symbols") / (F.col("word_chars") + 1)).alias("symbols"),
        F.log1p(100 * F.col("n_repeat_words") / words).alias("repeats"),
        F.log1p(100 * F.col("n_dup_lines") / words).alias("dup_lines"),
    ]


def _pools(rows: DataFrame, least: int) -> DataFrame:
    """``(lang, source, pool)``: each pair's own pool, or a shared one if it has few rows.

    Pairs under ``least`` rows share a pool per language; where that is under it too, the pool
    is ``all``, which every row is counted in. NULL is a value of its own.
    """
    pairs = written(rows.groupBy("lang", "source").agg(F.count("*").alias("n")), "pairs")
    few = pairs.filter(F.col("n") < least).groupBy("lang").agg(F.sum("n").alias("n_lang"))
    few = few.withColumnRenamed("lang", "_lang")
    named = pairs.join(few, pairs["lang"].eqNullSafe(few["_lang"]), "left")
    pool = (
        F.when(F.col("n") >= least, F.to_json(F.struct("lang", "source", F.lit(2).alias("by"))))
        .when(F.col("n_lang") >= least, F.to_json(F.struct("lang", F.lit(1).alias("by"))))
        .otherwise(F.lit(EVERY))
    )
    return written(
        named.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), pool.alias("pool")),
        "pools",
    )


def _with_groups(rows: DataFrame, groups: DataFrame, salt: Column) -> DataFrame:
    """Left join of written per-pool values; a hot pool spreads over ``SALTS`` tasks."""
    named = groups.withColumnRenamed("pool", "_pool")
    count = groups.count()
    if count <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(named), F.col("pool") == F.col("_pool"), "left").drop("_pool")
    spread = named.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("_row_salt", F.pmod(salt, F.lit(SALTS)))
    same = (F.col("pool") == F.col("_pool")) & (F.col("_row_salt") == F.col("_salt"))
    return salted.join(spread, same, "left").drop("_pool", "_salt", "_row_salt")


def _lower(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i + 1)]


def _estimates(bulk: DataFrame, names: Sequence[str], floors: Sequence[float]) -> DataFrame:
    """Per pool the mean and the Cholesky factor of the covariance, spreads floored."""
    p = len(names)
    moments = bulk.groupBy("pool").agg(
        *[F.avg(v).alias(f"m{i}") for i, v in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"c{i}{j}") for i, j in _lower(p)],
    )
    for i, j in _lower(p):
        done = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        if i == j:
            floored = F.col(f"c{i}{i}") + floors[i] ** 2
            value = F.sqrt(F.greatest(floored - done, F.lit(floors[i] ** 2 / 100)))
        else:
            value = (F.col(f"c{i}{j}") - done) / F.col(f"l{j}{j}")
        moments = moments.withColumn(f"l{i}{j}", value)
    return moments.select(
        "pool", *[f"m{i}" for i in range(p)], *[f"l{i}{j}" for i, j in _lower(p)]
    )


def _distance(rows: DataFrame, estimates: DataFrame, names: Sequence[str], salt: Column) -> DataFrame:
    """Adds the squared Mahalanobis distance ``d2``: NULL without an estimate."""
    p = len(names)
    joined = _with_groups(rows, estimates, salt)
    for i in range(p):
        done = sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        joined = joined.withColumn(f"z{i}", (F.col(names[i]) - F.col(f"m{i}") - done) / F.col(f"l{i}{i}"))
    total = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(p)), F.lit(0.0))
    return joined.select(*rows.columns, total.alias("d2"))


def _quantile(rows: DataFrame, share: float) -> DataFrame:
    return rows.groupBy("pool").agg(F.percentile_approx("d2", share, 10_000).alias("cut"))


def robust_distances(
    rows: DataFrame,
    names: Sequence[str],
    floors: Sequence[float],
    salt: Column,
    fitted: DataFrame,
    median: float = MEDIAN_DISTANCE,
    bulk: float = BULK,
    steps: int = STEPS,
) -> DataFrame:
    """Adds ``d2``, scaled so that its median over the fitted rows of a pool is ``median``.

    ``rows`` is a written table with a ``pool``; the rows of ``fitted``, which has the same
    columns, determine the estimates. A pool without such rows has no distances.
    """
    fitted = fitted.select("pool", *names, salt.alias("_spread"))
    spread = F.col("_spread")
    middles = written(
        fitted.groupBy("pool").agg(
            *[F.percentile_approx(v, 0.5, 10_000).alias(f"mid{i}") for i, v in enumerate(names)]
        ),
        "middles",
    )
    centred = _with_groups(fitted, middles, spread)
    deviations = written(
        centred.groupBy("pool").agg(
            *[F.first(f"mid{i}").alias(f"mid{i}") for i in range(len(names))],
            *[
                F.percentile_approx(F.abs(F.col(v) - F.col(f"mid{i}")), 0.5, 10_000).alias(f"mad{i}")
                for i, v in enumerate(names)
            ],
        ),
        "deviations",
    )
    scaled = [
        F.pow((F.col(v) - F.col(f"mid{i}")) / F.greatest(1.4826 * F.col(f"mad{i}"), F.lit(floors[i])), 2)
        for i, v in enumerate(names)
    ]
    near = _with_groups(fitted, deviations, spread).select(
        *fitted.columns, sum(scaled, F.lit(0.0)).alias("d2")
    )
    share = 0.5
    estimates = None
    for _ in range(steps + 1):
        cuts = written(_quantile(near, share), "cuts")
        kept = _with_groups(near, cuts, spread).filter("d2 <= cut")
        estimates = written(_estimates(kept, names, floors), "estimates")
        near = _distance(fitted, estimates, names, spread)
        share = bulk
    middle = written(_quantile(near, 0.5).withColumnRenamed("cut", "middle"), "middle")
    told = _with_groups(_distance(rows, estimates, names, salt), middle, salt)
    # A bulk tighter than the floors has a small median: its scale stays as it is.
    scale = F.when(F.col("middle") > median, F.lit(median) / F.col("middle"))
    return told.withColumn("d2", F.col("d2") * F.coalesce(scale, F.lit(1.0))).drop("middle")


def judge(docs: DataFrame, pool_rows: int = POOL_ROWS, limit: float = LIMIT) -> DataFrame:
    """One row per document row: ids, statistics, ``base_failed``, ``kept`` and ``distance``.

    A document is rejected if it fails the hard limits (under 50 words, or over half of them
    repeated) or if its squared distance exceeds ``limit``. Rows that fail do not enter the
    estimates. Groups are language and source, NULL being a value; a small group is held
    against its language, or, where that has few rows, against all rows, so every row past
    the hard limits is judged at any size. Estimates of few rows lean on the floors. Empty
    tables give no rows; ties and repeated rows count as often as they occur; columns other
    than ``doc_id, text, lang, source`` are not read.
    """
    narrow = docs.select("doc_id", "text", "lang", "source")
    stats = text_statistics(narrow).withColumn("base_failed", base_failed())
    vectors = written(stats.select("*", *statistic_vector()), "statistics")
    pools = _pools(vectors.filter("NOT base_failed"), pool_rows)
    pairs = vectors["lang"].eqNullSafe(pools["_lang"]) & vectors["source"].eqNullSafe(pools["_source"])
    sized = pools.count()
    side = small_side(pools, sized, BROADCAST_GROUPS)
    pooled = vectors.join(side, pairs, "left").drop("_lang", "_source")
    pooled = written(pooled, "pooled")
    salt = F.xxhash64("doc_id", "n_words", "word_chars")
    passed = pooled.filter("NOT base_failed")
    fitted = passed
    if not passed.filter(F.col("pool") == EVERY).isEmpty():
        others = passed.filter(F.col("pool") != EVERY).withColumn("pool", F.lit(EVERY))
        fitted = passed.unionByName(others)
    told = robust_distances(pooled, _VECTOR, [FLOORS[v] for v in _VECTOR], salt, fitted)
    outlying = F.coalesce(F.col("d2") > limit, F.lit(False))
    return told.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~outlying).alias("kept"),
        F.col("d2").alias("distance"),
    )
