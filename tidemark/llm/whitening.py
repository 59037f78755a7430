"""Whitening of embeddings from an exact scatter matrix, counted in bits.

**Integers.** An entry ``c`` becomes ``floor(64 * c)``, plus an offset of a million that shifts
every entry alike and drops out of all differences. What a long can't hold counts as the
nearest long.

**Bit-sliced scatter.** Per batch, each dimension is shifted to start at 0, and each bit of the
shifted numbers is packed across the rows into words: a plane. The sum over the rows of a
product of two dimensions is the sum, over pairs of their planes, of the number of common bits
times the planes' weights. A further plane of ones gives the sums and the count in the same way.
All are exact integers, so batches, tasks and retries add up to the same matrix whatever the
partitioning. Tasks send them in limbs of 60 bits, which Spark adds up as decimals; the driver
gets one number per pair of dimensions, however many rows there are.

**Fit.** ``n * n`` times the covariance is ``n * C - S * S``, an integer; it is divided once, into
doubles, for ``eigh``. Rows are centred as integers too, ``n * x - S``, before they are projected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64.0, 1_000_000
COMPONENTS = 32
_LIMB = 60
_LONG = 1 << 62
_SUMS = "dims int, i int, j int, low long, middle long, high long"


@dataclass(frozen=True)
class Fit:
    """What the vectors of one length are whitened by: a square matrix and some sums, of no more rows
    than dimensions, so it is sent with the tasks."""

    n: int
    sums: tuple[int, ...]  # of floor(SCALE * c), without the offset
    covariance: np.ndarray
    vectors: np.ndarray  # one component per column, by falling eigenvalue
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def projection(self) -> np.ndarray:
        """Components over the roots of their eigenvalues; zeros where there is no variance."""
        scale = np.zeros(len(self.values))
        np.divide(1.0, np.sqrt(self.values), out=scale, where=self.values > 0)
        return self.vectors * scale


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> dict[int, Fit]:
    """A fit per length of the vectors, over all vectors without NULL, NaN or infinite entries.

    There is one length as a rule; vectors of other lengths are lists of their own. Components
    whose eigenvalue can't be told from 0 (not above the largest one times the length times the
    double's precision) whiten to 0. No vectors give no fit.
    """
    sums = (
        rows.select(F.col(f"`{vector_col}`").cast("array<double>").alias("vector")).mapInArrow(_scatter, _SUMS)
        .groupBy("dims", "i", "j")
        .agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("low", "middle", "high")])
    )
    scatter: dict[int, dict[tuple[int, int], int]] = {}
    for dims, i, j, low, middle, high in sums.collect():
        total = int(low) + (int(middle) << _LIMB) + (int(high) << 2 * _LIMB)
        scatter.setdefault(dims, {})[i, j] = total
    fits = {dims: _solved(dims, products, components) for dims, products in scatter.items()}
    return _with_errors(rows, vector_col, fits)


def whitened(
    rows: DataFrame, fits: dict[int, Fit], id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """A row per vector and component: ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``.

    Vectors that are NULL, or hold NULL, NaN or infinite entries, and empty ones have no row.
    Repeated rows and ids are vectors like others, NULL ids too. ``deviation`` is exact, and
    NULL where 38 digits don't hold it. Other columns are left behind, whatever their names.
    """
    kind = dict(rows.dtypes)[id_col]
    return rows.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    ).mapInArrow(
        _whitener(fits),
        f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double",
    ).withColumnRenamed("id", id_col)


def integers(vectors: np.ndarray) -> np.ndarray:
    """``floor(SCALE * c)`` as longs; beyond a long's range less the offset, the nearest of its bounds."""
    scaled = np.floor(vectors * SCALE)
    low, high = float(-(2**63)), float(2**63)
    out = np.zeros(scaled.shape, np.int64)
    inside = (scaled >= low) & (scaled < high)
    out[inside] = scaled[inside].astype(np.int64)
    top = 2**63 - 1 - OFFSET
    out[(scaled >= high) | (out > top)] = top
    out[scaled < low] = -(2**63)
    return out


def scatter(x: np.ndarray) -> list[list[int]]:
    """Exact ``[x 1]' [x 1]`` of whole numbers by rows: sums of products, of entries, and the count."""
    n, dims = x.shape
    shift = [int(v) for v in x.min(axis=0)] + [0]
    # The difference of two longs, as it is in an unsigned word.
    shifted = x.astype(np.uint64) - np.array(shift[:-1], object).astype(np.int64).astype(np.uint64)
    owners, weights, planes = [], [], []
    for d in range(dims):
        column = shifted[:, d]
        for bit in range(int(column.max()).bit_length()):
            owners.append(d)
            weights.append(bit)
            planes.append(((column >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8))
    owners.append(dims)
    weights.append(0)
    planes.append(np.ones(n, np.uint8))
    words = np.zeros((len(planes), -(-n // 64) * 8), np.uint8)
    packed = np.packbits(np.array(planes), axis=1)
    words[:, : packed.shape[1]] = packed
    words = words.view(np.uint64)
    total = [[0] * (dims + 1) for _ in range(dims + 1)]
    owners, weights = np.array(owners), np.array(weights)
    starts = np.searchsorted(owners, np.arange(dims + 2))
    for p in range(len(words)):
        d = owners[p]
        common = np.bitwise_count(words[p] & words[starts[d] :]).sum(axis=1, dtype=np.int64)
        # Counts of one dimension's planes fall into its product with d; by weight, in Python's integers if large.
        bits = weights[starts[d] :] + weights[p]
        ends = starts[d:] - starts[d]
        kept = np.flatnonzero(np.diff(ends))
        if bits.max() + n.bit_length() < 62:
            parts = np.add.reduceat(common << bits, ends[kept]).tolist()
        else:
            parts = np.add.reduceat(common.astype(object) << bits.astype(object), ends[kept])
        row = total[d]
        for k, part in zip(kept, parts):
            row[d + k] += int(part)
    sums = [total[d][dims] for d in range(dims + 1)]
    # Back from shifted numbers: (u + s)(v + t) = uv + sv + tu + st.
    for i in range(dims + 1):
        for j in range(i, dims + 1):
            both = n * shift[i] * shift[j] if j < dims else 0
            if j < dims:
                total[i][j] += shift[i] * sums[j] + shift[j] * sums[i] + both
            elif i < dims:
                total[i][j] += n * shift[i]
    return total


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of the valid vectors of each length."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()
    flat = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for dims in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == dims)
        matrix = flat[starts[rows][:, None] + np.arange(dims)]
        good = np.isfinite(matrix).all(axis=1)
        if good.any():
            yield rows[good], matrix[good]


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, matrix in _vectors(batch.column("vector")):
            found = np.array(scatter(integers(matrix)), object)
            dims = matrix.shape[1]
            totals[dims] = totals[dims] + found if dims in totals else found
    mask = (1 << _LIMB) - 1
    for dims, total in totals.items():
        cells = [(dims, i, j, int(total[i, j])) for i in range(dims + 1) for j in range(i, dims + 1)]
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.array([c[k] for c in cells], pa.int32()) for k in range(3)],
                pa.array([c[3] & mask for c in cells], pa.int64()),
                pa.array([(c[3] >> _LIMB) & mask for c in cells], pa.int64()),
                pa.array([c[3] >> 2 * _LIMB for c in cells], pa.int64()),
            ],
            names=["dims", "i", "j", "low", "middle", "high"],
        )


def _solved(dims: int, products: dict[tuple[int, int], int], components: int) -> Fit:
    n = products[dims, dims]
    sums = tuple(products[i, dims] for i in range(dims))
    covariance = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            # A quotient of whole numbers is rounded once.
            covariance[i, j] = covariance[j, i] = (n * products[i, j] - sums[i] * sums[j]) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    values = np.where(values > max(values[0], 0.0) * dims * np.finfo(float).eps, values, 0.0)
    # The largest entry of a component is positive.
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(dims)]
    vectors = vectors * np.where(largest < 0, -1.0, 1.0)
    trace = float(np.trace(covariance))
    shares = values / trace if trace > 0 else np.zeros(dims)
    return Fit(n, sums, covariance, vectors[:, :components], values[:components], shares[:components])


def _centred(matrix: np.ndarray, fitted: Fit) -> np.ndarray:
    """``n * x - S``: as longs where they hold it, otherwise as Python's integers."""
    x = integers(matrix)
    bound = fitted.n * max(abs(int(x.min())), abs(int(x.max()))) + max(abs(s) for s in fitted.sums)
    if bound < _LONG:
        return fitted.n * x - np.array(fitted.sums, np.int64)
    return x.astype(object) * fitted.n - np.array(fitted.sums, object)


def _projected(centred: np.ndarray, fitted: Fit) -> np.ndarray:
    return (centred / fitted.n).astype(float) @ fitted.projection


def _with_errors(rows: DataFrame, vector_col: str, fits: dict[int, Fit]) -> dict[int, Fit]:
    """The fits with what the whitened rows' covariance, measured in a second pass, is off the identity."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, matrix in _vectors(batch.column("vector")):
                fitted = fits[matrix.shape[1]]
                z = _projected(_centred(matrix, fitted), fitted)
                z = np.column_stack([z, np.ones(len(z))])
                totals[matrix.shape[1]] = totals.get(matrix.shape[1], 0.0) + z.T @ z
        for dims, total in totals.items():
            size = len(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size * size, dims, np.int32)), pa.array(np.repeat(np.arange(size), size), pa.int32()),
                    pa.array(np.tile(np.arange(size), size), pa.int32()), pa.array(total.ravel()),
                ],
                names=["dims", "i", "j", "total"],
            )

    measured = (
        rows.select(F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
        .mapInArrow(moments, "dims int, i int, j int, total double")
        .groupBy("dims", "i", "j").agg(F.sum("total").alias("total"))
    )
    cells: dict[int, dict] = {}
    for dims, i, j, total in measured.collect():
        cells.setdefault(dims, {})[i, j] = total
    out = {}
    for dims, fitted in fits.items():
        size = len(fitted.values)
        total = np.array([[cells[dims][i, j] for j in range(size + 1)] for i in range(size + 1)])
        mean = total[:size, size] / fitted.n
        off = total[:size, :size] / fitted.n - np.outer(mean, mean) - np.diag((fitted.values > 0).astype(float))
        out[dims] = replace(fitted, identity_error=float(np.abs(off).max()))
    return out


def _whitener(fits: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in _vectors(batch.column("vector")):
                fitted = fits.get(matrix.shape[1])
                if fitted is None:
                    continue
                # A part of the batch at a time: each row becomes as many rows as there are components.
                for first in range(0, len(at), 1024):
                    yield _long_rows(batch, at[first : first + 1024], matrix[first : first + 1024], fitted)

    return run


def _long_rows(batch: pa.RecordBatch, at: np.ndarray, matrix: np.ndarray, fitted: Fit) -> pa.RecordBatch:
    centred = _centred(matrix, fitted)
    rows, size = len(at), len(fitted.values)
    largest = max(abs(int(centred.min())), abs(int(centred.max())))
    if largest * largest * matrix.shape[1] < _LONG:
        deviation = pa.array((centred * centred).sum(axis=1)).cast(pa.decimal128(38, 0))
    else:
        exact = [sum(int(v) ** 2 for v in row) for row in centred.tolist()]
        deviation = pa.array([v if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
    each = pa.array(np.repeat(np.arange(rows), size))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id").take(pa.array(at)).take(each),
            pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), rows)),
            pa.array(np.full(rows * size, fitted.n, np.int64)),
            deviation.take(each),
            pa.array(_projected(centred, fitted).ravel()),
            pa.array(np.tile(fitted.explained, rows)),
            pa.array(np.full(rows * size, fitted.identity_error)),
        ],
        names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    )
