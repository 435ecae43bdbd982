"""Exact quantiles with linear interpolation."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Equal parts a range of values is counted in per round.
PARTS = 1024
# Size of the sketch that brackets a rank, and the share of ranks to either side: many times
# its error, and a rank outside its bracket is only searched longer.
SKETCH, AROUND = 1024, 0.01


@dataclass
class _Search:
    """The value of one rank of one column, known to lie in a closed range."""

    column: str
    rank: int  # among the values of the range; of the column while it is only a bracket
    low: float
    high: float
    whole: tuple[float, float] = (0.0, 0.0)
    bracketed: bool = False


def _part(value: Column, low: float, high: float) -> Column:
    """Which of the parts of the range a value lies in; never falls while values rise.

    Halves keep the difference of very large values finite.
    """
    share = (value / 2 - low / 2) / (high / 2 - low / 2)
    return F.least(F.floor(share * PARTS), F.lit(PARTS - 1)).cast("int")


def _narrowed(rows: DataFrame, ranges: list[tuple[str, float, float]]) -> dict[int, list[tuple]]:
    """Per range its filled parts in order: ``(count, smallest, largest)``, those below it first.

    Rows become one narrow cell per range they lie in or below; a partial aggregate leaves
    ranges x parts at most, whatever the number of rows.
    """

    def cell(i: int, c: str, low: float, high: float) -> Column:
        value = F.col(c)
        part = F.lit(0) if low == high else _part(value, low, high)
        place = F.when(value < low, F.lit(-1)).otherwise(part)
        return F.when(value <= high, F.struct(F.lit(i).alias("i"), place.alias("part"), value.alias("v")))

    cells = [cell(i, c, low, high) for i, (c, low, high) in enumerate(ranges)]
    long = rows.select(F.explode(F.array_compact(F.array(*cells))).alias("cell")).select("cell.*")
    counted = long.groupBy("i", "part").agg(
        F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    found: dict[int, list[tuple]] = {i: [] for i in range(len(ranges))}
    for row in sorted(counted.collect(), key=lambda r: (r["i"], r["part"])):
        if not found[row["i"]]:
            found[row["i"]].append((0, None, None))
        if row["part"] < 0:
            found[row["i"]][0] = (row["n"], row["low"], row["high"])
        else:
            found[row["i"]].append((row["n"], row["low"], row["high"]))
    return found


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Quantiles per column, missing values ignored; None for a column without values.

    A first pass makes a mergeable sketch per column, which brackets each rank between two
    values. Then all ranks are searched at once: each round counts the values below and in
    equal parts of the range that holds a rank and goes on with the part the rank is in, until
    that part is a single value. No value is shuffled or gathered; one round or two are enough
    unless very many values lie in a bracket.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    names = {c: f"c{i}" for i, c in enumerate(columns)}
    shares = sorted({min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-AROUND, AROUND)})
    points = F.array(*[F.lit(share) for share in shares])
    ends = rows.agg(
        *[f(n).alias(f"{n}_{f.__name__}") for n in names.values() for f in (F.count, F.min, F.max)],
        *[
            F.when(
                F.count(n) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(n, SKETCH), points)
            ).alias(f"{n}_near")
            for n in names.values()
        ],
    ).first()
    searches: dict[tuple[str, int], _Search] = {}
    for c, n in names.items():
        size = ends[f"{n}_count"]
        whole = ends[f"{n}_min"], ends[f"{n}_max"]
        for p in probabilities if size else ():
            low, high = (
                ends[f"{n}_near"][shares.index(min(max(p + side, 0.0), 1.0))] for side in (-AROUND, AROUND)
            )
            for rank in (math.floor(p * (size - 1)), math.ceil(p * (size - 1))):
                searches[c, rank] = _Search(n, rank, low, high, whole, True)
    while open_ones := [s for s in searches.values() if s.bracketed or s.low < s.high]:
        ranges = list(dict.fromkeys((s.column, s.low, s.high) for s in open_ones))
        parts = _narrowed(rows, ranges)
        for s in open_ones:
            (below, _, _), *inside = parts[ranges.index((s.column, s.low, s.high))] or [(0, None, None)]
            if s.bracketed:
                s.bracketed = False
                if not below <= s.rank < below + sum(n for n, _, _ in inside):
                    s.low, s.high = s.whole
                    continue
                s.rank -= below
            for n, low, high in inside:
                if s.rank < n:
                    s.low, s.high = low, high
                    break
                s.rank -= n
    out: dict[str, list[float | None]] = {}
    for c, n in names.items():
        size = ends[f"{n}_count"]
        out[c] = []
        for p in probabilities:
            if not size:
                out[c].append(None)
                continue
            place = p * (size - 1)
            low, high = (searches[c, rank].low for rank in (math.floor(place), math.ceil(place)))
            out[c].append(low + (high - low) * (place % 1.0))
    return out
