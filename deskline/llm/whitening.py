"""Whitening of embeddings by an incremental eigendecomposition.

The covariance is never formed. Every task keeps eigenvalues and eigenvectors of the
scatter of its own rows and brings centred rows in as rank-one updates; each update
solves the secular equation for the new eigenvalues, after deflation. The spectra of
tasks are combined pairwise in a tree, where the eigenpairs of one are successive
rank-one updates of the other. A last pass over all rows refines the result: Rayleigh
and Ritz's projection of the covariance on the basis found, summed over tasks.

Entries are made whole numbers first, ``floor(scale * c) + shift``, so sums, means and
deviations are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskline.llm.common import saved, table_of

# Every task holds matrices of dimension squared.
_MAX_DIMENSION = 2048
# Results of tasks that one task combines.
_FAN_IN = 16
# Whole numbers up to here are exact as doubles. Larger entries count as not finite.
_LARGEST = float(1 << 52)
_LOW_BITS = 31
_EPS = np.finfo(float).eps


class Whitening(NamedTuple):
    """``n`` vectors, ``sums`` of their whole numbers for each dimension, ``values``
    (eigenvalues of the covariance, falling) and ``basis`` (their unit eigenvectors, one
    a column), ``trace`` of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    basis: np.ndarray
    trace: float
    scale: int
    shift: int


# -- eigenvalues after a rank-one update ----------------------------------------


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For rising ``poles`` and positive ``weights``, the roots of
    1 + sum(weights / (poles - x)): row i holds ``poles`` minus root i, each difference
    accurate by itself.

    Root i lies between pole i and the next one (the last within the sum of the weights).
    It is counted from the nearer of the two, and moved by a rational fit of both halves
    of the sum; where a step leaves the bracket, the bracket is halved.
    """
    k = len(poles)
    right_end = poles[-1] + 2 * weights.sum()
    following = np.append(poles[1:], right_end)
    gaps = following - poles
    terms = weights / (poles - (poles + gaps / 2)[:, None])
    from_left = 1 + terms.sum(axis=1) >= 0
    origin = np.where(from_left, poles, following)
    shifted = poles - origin[:, None]
    shifted_end = following - origin
    own = np.arange(k)
    lower = np.tri(k, dtype=bool)  # poles up to that of the root
    low = np.where(from_left, 0.0, -gaps / 2)
    high = np.where(from_left, gaps / 2, 0.0)
    # Start: the two nearest poles, the others as they are in the middle.
    next_weight = np.append(weights[1:], 0.0)
    rest = 1 + terms.sum(axis=1) - terms[own, own]
    rest[:-1] -= terms[own[:-1], own[1:]]
    both = weights + next_weight
    a = np.where(from_left, rest, -rest) * gaps + both
    b = np.where(from_left, weights, -next_weight) * gaps
    at = _inside(_quadratic(rest, a, b), low, high)
    active = own
    for _ in range(100):
        delta = shifted[active] - at[active, None]
        terms = weights / delta
        slopes = terms / delta
        f, slope, place = 1 + terms.sum(axis=1), slopes.sum(axis=1), np.arange(len(active))
        # What the sum may be off by rounding, and what the last digit of x changes in it.
        noise = 8 * (1 + np.abs(terms).sum(axis=1)) + np.abs(at[active]) * slope
        high[active[f > 0]] = at[active[f > 0]]
        low[active[f <= 0]] = at[active[f <= 0]]
        left = (slopes * lower[active]).sum(axis=1)
        near, far = delta[place, active], shifted_end[active] - at[active]
        c = f - near * left - far * (slope - left)
        moved = at[active] + _quadratic(c, (near + far) * f - near * far * slope, near * far * f)
        moved = _inside(moved, low[active], high[active])
        wanted = (np.abs(f) > _EPS * noise) & (moved != at[active])
        if not wanted.any():
            break
        active = active[wanted]
        at[active] = moved[wanted]
    return shifted - at[:, None]


def _quadratic(c: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The root of c x^2 - a x + b that is the right one in a secular step."""
    root = np.sqrt(np.abs(a * a - 4 * b * c))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))


def _inside(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``at`` where it lies within the bracket, else a point between its ends: the
    geometric mean, unless one of them is 0."""
    same_sign = low * high > 0
    middle = np.where(same_sign, np.sign(low + high) * np.sqrt(np.abs(low)) * np.sqrt(np.abs(high)), (low + high) / 2)
    with np.errstate(invalid="ignore"):
        return np.where((at > low) & (at < high), at, middle)


class Spectrum:
    """Eigenvalues (rising) and eigenvectors (columns) of a growing scatter matrix."""

    def __init__(self, dimension: int):
        self.values = np.zeros(dimension)
        self.basis = np.eye(dimension)

    def add(self, row: np.ndarray) -> None:
        """Adds the outer product of ``row`` with itself."""
        size = float(row @ row)
        if not size > 0:
            return
        z = self.basis.T @ (row / np.sqrt(size))
        kept = self._deflate(z, size)
        if not len(kept):
            return
        poles, own = self.values[kept], z[kept]
        delta = secular_roots(poles, size * own * own)
        # Loewner's formula: the vector for which these roots are exact, which makes the
        # eigenvectors orthogonal however close the roots are.
        apart = poles[:, None] - poles
        np.fill_diagonal(apart, -1.0)
        exact = np.sqrt(np.abs(np.prod(delta / apart, axis=0)))
        vectors = np.copysign(exact, own) / delta
        vectors /= np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        self.values[kept] = poles - delta[np.arange(len(kept)), np.arange(len(kept))]
        self.basis[:, kept] = self.basis[:, kept] @ vectors.T
        order = np.argsort(self.values, kind="stable")
        self.values, self.basis = self.values[order], np.ascontiguousarray(self.basis[:, order])

    def _deflate(self, z: np.ndarray, size: float) -> np.ndarray:
        """The eigenpairs that the update changes. Those that ``z`` hardly touches stay
        as they are; of two with almost the same value, a rotation frees one."""
        tolerance = 8 * _EPS * max(self.values[-1], size)
        touched = np.flatnonzero(size * np.abs(z) > tolerance)
        gaps = np.diff(self.values[touched])
        if not (gaps <= tolerance / np.maximum(np.abs(z[touched[1:]] * z[touched[:-1]]), _EPS)).any():
            return touched
        kept: list[int] = []
        for i in touched.tolist():
            if kept:
                last = kept[-1]
                length = np.hypot(z[last], z[i])
                c, s = z[i] / length, z[last] / length
                if (self.values[i] - self.values[last]) * abs(c * s) <= tolerance:
                    z[i], z[last] = length, 0.0
                    pair = self.basis[:, [last, i]] @ np.array([[c, s], [-s, c]])
                    self.basis[:, last], self.basis[:, i] = pair.T
                    low, high = self.values[last], self.values[i]
                    self.values[last], self.values[i] = c * c * low + s * s * high, s * s * low + c * c * high
                    kept.pop()
            kept.append(i)
        return np.array(kept, np.int64)

    def add_block(self, rows: np.ndarray) -> None:
        """Adds many rows: those of their triangular factor, which has the same scatter
        and no more rows than columns."""
        if len(rows) > rows.shape[1]:
            rows = np.linalg.qr(rows, mode="r")
        for row in rows:
            self.add(row)

    def add_spectrum(self, values: np.ndarray, basis: np.ndarray) -> None:
        for value, vector in zip(values, basis.T):
            if value > 0:
                self.add(np.sqrt(value) * vector)


# -- rows -------------------------------------------------------------------------


def _vectors(column: pa.Array, dimension: int, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows with a usable vector, and their whole numbers."""
    offsets = column.offsets.to_numpy()
    usable = np.asarray(column.is_valid()) & (np.diff(offsets) == dimension)
    at = offsets[:-1][usable]
    entries = column.values.to_numpy(zero_copy_only=False)  # null entries become NaN
    scaled = entries[at[:, None] + np.arange(dimension)].astype(np.float64) * scale
    finite = (np.abs(scaled) < _LARGEST).all(axis=1)  # not true of NaN
    return np.flatnonzero(usable)[finite], np.floor(scaled[finite]).astype(np.int64) + shift


def _part(values: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    """What one task found, under its number."""
    columns = [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([values.tolist()], pa.list_(kind))]
    return pa.RecordBatch.from_arrays(columns, ["part", "found"])


def _arrays(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _combined(parts: DataFrame, merge: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The results of all tasks merged in a tree, ``_FAN_IN`` at a time. None without any."""
    kind = parts.schema["found"].dataType.simpleString()

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        found = merge(_arrays(table.sort_by("part").column("found")))
        held = pa.array([found.tolist()], table.schema.field("found").type)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "found": held})

    while True:
        parts = saved(parts)
        rows = parts.limit(2).collect()
        if len(rows) < 2:
            return np.array(rows[0].found) if rows else None
        parts = parts.groupBy(F.floor(F.col("part") / _FAN_IN).cast("long").alias("group")).applyInArrow(merged, f"part long, found {kind}")


def _sum(found: np.ndarray) -> np.ndarray:
    return found.sum(axis=0)


def fit_whitening(
    vectors: DataFrame, vector_col: str = "embedding", scale: int = 1024, shift: int = 100_000, block: int = 1024
) -> Whitening | None:
    """The eigendecomposition of the covariance (divisor n) of all usable vectors.

    A vector is usable if it is not null, has no null, NaN or infinite entry, none of
    2^52 / ``scale`` and more in size, and the length that most vectors without null and
    non-finite entries have (of equally frequent ones the greatest). Rows are read in blocks of
    ``block``: the triangular factor of a block takes the place of its rows, so a block
    costs at most a rank-one update for each dimension; 1 updates by every row. Without
    usable vectors, or if they have no entries, the result is None. Vectors of more than
    2,048 entries are refused, as every task holds square matrices of that size.
    """
    rows = vectors.select(F.col(vector_col).cast("array<double>").alias("vector"))
    entry = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    length = F.size("vector").alias("length")
    lengths = rows.where(F.col("vector").isNotNull() & entry).groupBy(length).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if common is None or not common.length:
        return None
    dimension = common.length
    if dimension > _MAX_DIMENSION:
        raise ValueError(f"vectors of {dimension} entries, more than {_MAX_DIMENSION}")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(dimension, np.int64), np.zeros(dimension, np.int64), 0
        for batch in batches:
            _, x = _vectors(batch.column(0), dimension, scale, shift)
            high += (x >> _LOW_BITS).sum(axis=0)
            low += (x & ((1 << _LOW_BITS) - 1)).sum(axis=0)
            n += len(x)
        if n:
            yield _part(carried(np.concatenate([high, low, [n]])), pa.int64())

    def carried(found: np.ndarray) -> np.ndarray:
        high, low = found[:dimension], found[dimension:-1]
        return np.concatenate([high + (low >> _LOW_BITS), low & ((1 << _LOW_BITS) - 1), found[-1:]])

    found = _combined(rows.mapInArrow(add_up, "part long, found array<long>"), lambda held: carried(held.sum(axis=0)))
    if found is None:
        return None
    n = int(found[-1])
    sums = [(int(high) << _LOW_BITS) + int(low) for high, low in zip(found[:dimension], found[dimension:-1])]
    centre = _Centre(n, sums)

    def local_spectrum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum, held, seen = Spectrum(dimension), [], 0
        for batch in batches:
            _, x = _vectors(batch.column(0), dimension, scale, shift)
            for start in range(0, len(x), block):
                held.append(centre.centred(x[start : start + block]))
                seen += len(held[-1])
                if seen >= block:
                    spectrum.add_block(np.concatenate(held))
                    held, seen = [], 0
        if held:
            spectrum.add_block(np.concatenate(held))
        if spectrum.values[-1] > 0:
            yield _part(np.concatenate([spectrum.values, spectrum.basis.ravel()]), pa.float64())

    def merge(held: np.ndarray) -> np.ndarray:
        spectrum = Spectrum(dimension)
        spectrum.values, spectrum.basis = held[0, :dimension].copy(), held[0, dimension:].reshape(dimension, dimension).copy()
        for other in held[1:]:
            spectrum.add_spectrum(other[:dimension], other[dimension:].reshape(dimension, dimension))
        return np.concatenate([spectrum.values, spectrum.basis.ravel()])

    found = _combined(rows.mapInArrow(local_spectrum, "part long, found array<double>"), merge)
    if found is None:  # all vectors are equal
        return Whitening(n, sums, np.zeros(0), np.zeros((dimension, 0)), 0.0, scale, shift)
    basis = np.linalg.qr(found[dimension:].reshape(dimension, dimension))[0]
    shared = rows.sparkSession.sparkContext.broadcast(basis)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares, seen = np.zeros((dimension, dimension)), 0.0, 0
        for batch in batches:
            _, x = _vectors(batch.column(0), dimension, scale, shift)
            for start in range(0, len(x), block):
                z = centre.centred(x[start : start + block])
                on_basis = z @ shared.value
                total += on_basis.T @ on_basis
                squares += float((z * z).sum())
            seen += len(x)
        if seen:
            yield _part(np.append(total.ravel(), squares), pa.float64())

    found = _combined(rows.mapInArrow(project, "part long, found array<double>"), _sum) / n
    values, rotation = np.linalg.eigh(found[:-1].reshape(dimension, dimension))
    falling = np.argsort(-values, kind="stable")
    values, basis = values[falling], (basis @ rotation)[:, falling]
    # Either sign would do: the largest entry is positive.
    largest = basis[np.abs(basis).argmax(axis=0), np.arange(dimension)]
    basis = basis * np.where(largest < 0, -1.0, 1.0)
    trace = float(found[-1])
    varying = values > trace * dimension * _EPS
    return Whitening(n, sums, values[varying], basis[:, varying], trace, scale, shift)


class _Centre:
    """Subtracts the mean, which is a whole number and a fraction of n."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums over the dimensions of (n x - sum)^2, exact; null beyond 64 bits."""
        beyond = ((self.centred(x) * self.n) ** 2).sum(axis=1) >= 2.0**63 * (1 - 1e-9)
        # Whole numbers wrap round, so a total that fits is right whatever its parts are.
        scaled = (x - self.whole) * np.int64(self.n) - self.rest
        return pa.array((scaled * scaled).sum(axis=1), pa.int64(), mask=beyond)


def whiten(
    vectors: DataFrame,
    model: Whitening | None,
    components: int = 8,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row for each usable vector (see :func:`fit_whitening`) and component:
    ``id``, ``component`` (from 1, falling eigenvalues), ``n``, ``deviation`` (the sum over
    dimensions of (n x - sum)^2, exact; null beyond 64 bits), ``whitened`` (the centred
    vector on the component over the root of its eigenvalue), ``explained`` (its share of
    the variance) and ``identity_error`` (the largest absolute entry of the covariance of
    the whitened vectors minus the identity).

    Components without variance have no rows, so there are at most as many as the rank;
    equal vectors alone, one vector or an empty table give no rows. Rows that are there
    twice are both returned. Other columns are not read, whatever their names; ids may be
    null.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    many = 0 if model is None else min(components, len(model.values))
    if not many:
        return vectors.sparkSession.createDataFrame([], schema)
    dimension, scale, shift = len(model.sums), model.scale, model.shift
    centre = _Centre(model.n, model.sums)
    axes = rows.sparkSession.sparkContext.broadcast(model.basis[:, :many] / np.sqrt(model.values[:many]))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, x = _vectors(batch.column("vector"), dimension, scale, shift)
            on_axes = centre.centred(x) @ axes.value
            lists = pa.ListArray.from_arrays(np.arange(0, on_axes.size + 1, many, dtype=np.int32), pa.array(on_axes.ravel()))
            columns = [batch.column("id").take(pa.array(own)), centre.deviations(x), lists]
            yield pa.RecordBatch.from_arrays(columns, ["id", "deviation", "whitened"])

    projected = table_of(rows.mapInArrow(project, f"id {id_type}, deviation long, whitened array<double>"), "whitened")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products, n = np.zeros(many), np.zeros((many, many)), 0
        for batch in batches:
            w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, many)
            total += w.sum(axis=0)
            products += w.T @ w
            n += len(w)
        if n:
            yield _part(np.concatenate([total, products.ravel(), [n]]), pa.float64())

    # The whitened vectors are centred already: their mean is 0 but for rounding.
    found = _combined(projected.select("whitened").mapInArrow(moments, "part long, found array<double>"), _sum)
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema)
    found = found / found[-1]
    covariance = found[many:-1].reshape(many, many) - np.outer(found[:many], found[:many])
    error = float(np.abs(covariance - np.eye(many)).max())
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values[:many]])
    return projected.select("id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
