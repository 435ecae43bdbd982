"""Whitening of embeddings, the leading components found by contour integration.

Vectors become fixed-point numbers, so their covariance is a sum of whole numbers that does
not depend on the order of the rows. Counts of eigenvalues beyond a shift (the signs of the
pivots of the shifted matrix, its inertia) place intervals around the wanted part of the
spectrum. Per interval, solves of the complex shifted covariance at the nodes of a contour
add up to a filter that keeps the interval's directions; a Rayleigh-Ritz step extracts them,
and its number of pairs must equal the interval's count, so none is missed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.llm.common import extended, spare_name

# Fixed point: steps per unit, and what is added to keep numbers positive.
SCALE, OFFSET = 1024, 100_000
# Nodes on the upper half of a contour, and rounds of filter and Rayleigh-Ritz steps.
NODES, ROUNDS = 12, 12
# Largest residual of a pair, relative to the largest eigenvalue.
RESIDUAL = 2e-14
# An interval ends where neighbours are apart by this share of the largest eigenvalue.
GAP, INTERVAL = 0.01, 4
# Whole numbers up to here are exact as doubles.
_EXACT = 2**53


def fixed_point(
    df: DataFrame, vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET, name: str = "x"
) -> DataFrame:
    """The rows whose vector is whole and finite, with ``floor(scale * c) + offset`` as ``name``.

    Rows with a NULL vector, or a NULL, NaN or infinite entry, go; a column that has the new
    name already is replaced. Numbers beyond a long raise.
    """
    value = F.col(f"`{vector}`")
    finite = F.forall(value, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    whole = F.transform(value, lambda c: F.floor(c.cast("double") * scale).cast("bigint") + offset)
    return df.filter(value.isNotNull() & finite).withColumn(name, whole)


def _matrix(column: pa.Array) -> np.ndarray:
    """The lists of a column as rows; all must have one length."""
    lengths = set(pc.list_value_length(column).to_pylist())
    if len(lengths) > 1:
        raise ValueError(f"vectors of several lengths: {sorted(lengths)[:5]}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(vectors: DataFrame, name: str) -> tuple[int, list[int]]:
    """The number of vectors and their sum, exact."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch.column(0)).sum(axis=0)
                n, total = n + batch.num_rows, own if total is None else total + own
        if total is not None:
            places = pa.array(range(len(total)), pa.int32())
            counts = pa.array([n] * len(total), pa.int64())
            yield pa.RecordBatch.from_arrays([places, counts, pa.array(total)], ["i", "n", "total"])

    found = vectors.select(name).mapInArrow(scan, "i int, n bigint, total bigint")
    rows = found.groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    by_place = {r["i"]: (r["n"], int(r["total"])) for r in rows.collect()}  # one row per dimension
    if not by_place:
        return 0, []
    if len({n for n, _ in by_place.values()}) > 1:
        raise ValueError("vectors of several lengths")
    return by_place[0][0], [by_place[i][1] for i in range(len(by_place))]


def _products(y: np.ndarray) -> np.ndarray:
    """Sums of products of all pairs of columns, as Python's whole numbers."""
    top = int(np.abs(y).max(initial=0))
    if top * top >= _EXACT:
        exact = y.astype(object)
        return exact.T @ exact
    step = max(1, _EXACT // max(1, top * top) - 1)
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), step):
        part = y[at : at + step].astype(float)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def covariance(vectors: DataFrame, n: int, sums: Sequence[int], name: str = "x") -> np.ndarray:
    """Covariance with divisor ``n``: every entry the double nearest to the exact value.

    Vectors are centred on the whole part of their mean before they are multiplied; what
    the mean has beyond it is taken off the exact sums.
    """
    d = len(sums)
    centre = np.array([s // n for s in sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre)]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in batches:
            if batch.num_rows:
                total += _products(_matrix(batch.column(0)) - centre)
        i, j = np.tril_indices(d)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(i, pa.int32()),
                pa.array(j, pa.int32()),
                pa.array([str(v) for v in total[i, j]], pa.string()),
            ],
            ["i", "j", "total"],
        )

    found = vectors.select(name).mapInArrow(scan, "i int, j int, total string")
    rows = found.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = np.zeros((d, d))
    for r in rows.collect():  # one row per pair of dimensions
        i, j = r["i"], r["j"]
        out[i, j] = out[j, i] = (n * int(r["total"]) - rest[i] * rest[j]) / (n * n)
    return out


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix, by reflections."""
    a = matrix.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        if not length:
            continue
        x[0] += length if x[0] >= 0 else -length
        x /= np.linalg.norm(x)
        a[k + 1 :, :] -= 2 * np.outer(x, x @ a[k + 1 :, :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(bands: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """Eigenvalues above each shift: the positive pivots of the shifted matrix."""
    diagonal, off = bands
    tiny = np.finfo(float).tiny * 1e16
    pivot = diagonal[0] - shifts
    count = (pivot > 0).astype(int)
    for i in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = diagonal[i] - shifts - off[i - 1] ** 2 / pivot
        count += pivot > 0
    return count


def located(bands: tuple[np.ndarray, np.ndarray], wanted: int) -> np.ndarray:
    """The ``wanted`` largest eigenvalues to about eight digits, halving by inertia counts."""
    diagonal, off = bands
    reach = np.abs(np.concatenate([off, [0.0]])) + np.abs(np.concatenate([[0.0], off]))
    low = np.full(wanted, (diagonal - reach).min() - 1e-12)
    high = np.full(wanted, (diagonal + reach).max() * (1 + 1e-12) + 1e-300)
    order = np.arange(wanted)
    for _ in range(60):
        middle = (low + high) / 2
        over = above(bands, middle) > order
        low, high = np.where(over, middle, low), np.where(over, high, middle)
    return (low + high) / 2


def intervals(bands: tuple[np.ndarray, np.ndarray], wanted: int) -> list[tuple[float, float, int]]:
    """``low, high, eigenvalues inside`` of intervals over at least the ``wanted`` largest ones.

    Edges lie in the middle of gaps, so that no cluster is cut where that can be helped.
    """
    d = len(bands[0])
    values = located(bands, min(d, 2 * wanted + INTERVAL))
    top = values[0]
    gaps = -np.diff(values)
    wide = [j + 1 for j in range(len(gaps)) if gaps[j] >= GAP * top]
    last = next((j for j in wide if j >= wanted), None)
    if last is None:
        later = range(wanted - 1, len(gaps))
        last = max(later, key=lambda j: gaps[j]) + 1 if len(values) < d and len(later) else len(values)
    cuts, since = [], 0
    for j in wide:
        if j < last and j - since >= INTERVAL:
            cuts.append(j)
            since = j
    edges = [top + max(0.05 * top, 1e-300)]
    for j in [*cuts, last]:
        edges.append((values[j - 1] + values[j]) / 2 if j < len(values) else values[j - 1] - 0.05 * top)
    counts = above(bands, np.array(edges))
    return [(edges[i + 1], edges[i], int(counts[i + 1] - counts[i])) for i in range(len(edges) - 1)]


def _filtered(
    spark: SparkSession, matrix: np.ndarray, spans: list[tuple[float, float, int]], bases: list[np.ndarray]
) -> list[np.ndarray]:
    """Each basis under the contour filter of its interval: one task per node of a contour."""
    places, weights = np.polynomial.legendre.leggauss(NODES)
    shared = spark.sparkContext.broadcast((matrix, spans, bases))

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        covered, intervals_, starts = shared.value
        for batch in batches:
            for k in batch.column(0).to_pylist():
                span, node = divmod(k, NODES)
                low, high, _ = intervals_[span]
                turn = np.exp(0.5j * np.pi * (places[node] + 1))
                radius = (high - low) / 2
                shift = (low + high) / 2 + radius * turn
                shifted = shift * np.eye(len(covered)) - covered
                part = 0.5 * weights[node] * (radius * turn * np.linalg.solve(shifted, starts[span])).real
                yield pa.RecordBatch.from_arrays(
                    [pa.array([span], pa.int32()), pa.array([node], pa.int32()), pa.array([part.tobytes()])],
                    ["span", "node", "part"],
                )

    tasks = len(spans) * NODES
    try:
        rows = spark.range(0, tasks, 1, tasks).mapInArrow(solve, "span int, node int, part binary")
        found = {(r["span"], r["node"]): r["part"] for r in rows.collect()}  # a thin matrix per node
    finally:
        shared.destroy()
    out = []
    for k, basis in enumerate(bases):
        parts = [np.frombuffer(found[k, node]).reshape(basis.shape) for node in range(NODES)]
        out.append(np.sum(parts, axis=0))
    return out


def _ritz(matrix: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values, rising, and vectors of the matrix within the span of a basis."""
    left, sizes, _ = np.linalg.svd(basis, full_matrices=False)
    left = left[:, sizes > 1e-13 * sizes[0]]
    left, _ = np.linalg.qr(left)
    values, turned = np.linalg.eigh(left.T @ matrix @ left)
    return values, left @ turned


def leading_pairs(
    spark: SparkSession, matrix: np.ndarray, wanted: int, seed: int = 42
) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their vectors as rows.

    Values that rounding cannot tell from zero are left out. Fails if an interval keeps fewer
    pairs than its inertia count says.
    """
    d = len(matrix)
    size = float(np.abs(matrix).max(initial=0.0))
    if not size:
        return np.zeros(0), np.zeros((0, d))
    scaled = matrix / size
    bands = tridiagonal(scaled)
    floor = d * np.finfo(float).eps * float(np.trace(scaled))
    wanted = min(wanted, int(above(bands, np.array([floor]))[0]))
    if not wanted:
        return np.zeros(0), np.zeros((0, d))
    spans = intervals(bands, wanted)
    rng = np.random.default_rng(seed)
    bases = [rng.standard_normal((d, min(d, 2 * count + 8))) for _, _, count in spans]
    done: dict[int, np.ndarray] = {}
    state = ""
    for _ in range(ROUNDS):
        open_ = [k for k in range(len(spans)) if k not in done]
        if not open_:
            break
        filtered = _filtered(spark, scaled, [spans[k] for k in open_], [bases[k] for k in open_])
        for k, basis in zip(open_, filtered):
            low, high, count = spans[k]
            values, vectors = _ritz(scaled, basis)
            inside = (values > low) & (values < high)
            pairs = vectors[:, inside]
            worst = np.linalg.norm(scaled @ pairs - pairs * values[inside], axis=0).max(initial=0.0)
            if inside.sum() == count and worst <= RESIDUAL * np.sqrt(d):
                done[k] = pairs
            else:
                state = f"{inside.sum()} of {count} pairs in {low:.6g} to {high:.6g}, residual {worst:.1e}"
                fresh = rng.standard_normal((d, bases[k].shape[1]))
                fresh[:, : vectors.shape[1]] = vectors[:, ::-1][:, : fresh.shape[1]]
                bases[k] = fresh
    if len(done) < len(spans):
        raise RuntimeError(f"the contour filter did not settle: {state}")
    values, vectors = _ritz(scaled, np.concatenate([done[k] for k in sorted(done)], axis=1))
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted].T
    heads = vectors[np.arange(wanted), np.abs(vectors).argmax(axis=1)]
    return values * size, vectors * np.sign(heads)[:, None]


@dataclass
class Whitening:
    """Exact count and sums, the trace of the covariance, and its leading pairs."""

    n: int
    sums: list[int]
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.eigenvalues]


def fit(vectors: DataFrame, components: int = 8, name: str = "x") -> Whitening:
    """The leading components of all vectors.

    There are as many as the covariance has positive eigenvalues, at most ``components``: none
    for an empty table, one vector or equal vectors. Repeated rows count as often as they
    occur. Vectors of several lengths raise. What reaches the driver is a row per pair of
    dimensions, whatever the number of vectors.
    """
    n, sums = _sums(vectors, name)
    if not n:
        return Whitening(0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    matrix = covariance(vectors, n, sums, name)
    values, pairs = leading_pairs(vectors.sparkSession, matrix, components)
    return Whitening(n, sums, float(np.trace(matrix)), values, pairs)


def whiten(vectors: DataFrame, model: Whitening, keep: Sequence[str] = ("vec_id",), name: str = "x") -> DataFrame:
    """``keep`` and ``whitened``: centred vectors on each component over its deviation.

    Rows stay as they are, repeats and NULL ids included; empty lists under a model without
    components.
    """
    out = "whitened"
    kept = vectors.select(F.col(f"`{name}`").alias(spare_name(vectors, "_vector")), *keep)
    types = extended(kept.select(*keep), f"{out} array<double>")
    k = len(model.eigenvalues)
    centre = np.array([s // model.n for s in model.sums] if model.n else [], np.int64)
    rest = np.array([(s - model.n * int(c)) / model.n for s, c in zip(model.sums, centre)])
    axes = (model.components / np.sqrt(model.eigenvalues)[:, None]).T if k else np.zeros((len(centre), 0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.zeros((0, k))
            if batch.num_rows:
                rows = ((_matrix(batch.column(0)) - centre) - rest) @ axes
            ends = pa.array(np.arange(batch.num_rows + 1) * k, pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(rows.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], lists], types.names)

    return kept.mapInArrow(run, types)


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured.

    The rows are centred already; 0 without components.
    """
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(0))
                total += rows.T @ rows
        i, j = np.tril_indices(k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "total"]
        )

    found = whitened.select("whitened").mapInArrow(scan, "i int, j int, total double")
    rows = found.groupBy("i", "j").agg((F.sum("total") / model.n).alias("value")).collect()
    return max(abs(r["value"] - (r["i"] == r["j"])) for r in rows)  # one row per pair of components
