"""Whitening of embeddings: principal components by mixed-precision refinement.

Vectors become whole numbers, so their sums and their centred second moments are exact
in any order and partitioning. The covariance has a row and a column for each dimension,
whatever the number of vectors: its eigenvectors are found on the driver, first in
float32, then corrected by the iteration of Ogita and Aishima (matrix products in
extended precision, each of which squares the error). Eigenvalues closer than the error
bound form a cluster: there the iteration only restores orthogonality, and a small
eigenproblem of the shifted cluster turns its vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, DecimalType, DoubleType, IntegerType, LongType, StructField, StructType,
)

from .common import checkpointed, small_batches, without

#: What the query's contract adds to an entry, and multiplies it with.
SCALE, SHIFT = 1024, 100_000
#: Scaled entries from here on are no exact whole numbers in double precision.
LARGEST = 2**52
#: Bits of one digit when numbers beyond it are multiplied digit by digit.
DIGIT = 20
#: Rows whose products of two digits still add up exactly in double precision.
EXACT_ROWS = 1 << (53 - 2 * DIGIT)
#: Eigenvalues up to this share of the greatest are zero: no double separates them from it.
ZERO = 1e-13
ROUNDS = 60

_TOTAL = DecimalType(38, 0)


# --- eigenvectors ---------------------------------------------------------------------


def _norm(matrix: np.ndarray) -> float:
    """The largest absolute row sum: no less than the spectral norm of a symmetric matrix."""
    return float(np.abs(matrix).sum(axis=1).max(initial=0))


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Indices of the values, cut where neighbours in order are further apart than ``width``."""
    order = np.argsort(values, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(values[order]) > width) + 1)


def _corrected(matrix: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One step of the iteration: new vectors, values, and the bound within which values are a cluster.

    With R = I - X'X and S = X'AX the values are S_jj / (1 - R_jj), and X gains X E, where
    E_ij = (S_ij + value_j R_ij) / (value_j - value_i); within a cluster E_ij = R_ij / 2.
    E is R / 2 and an antisymmetric part; kept so in rounding, close values cannot spoil orthogonality.
    """
    rest = np.eye(x.shape[1], dtype=x.dtype) - x.T @ x
    rest = (rest + rest.T) / 2
    product = x.T @ (matrix @ x)
    product = (product + product.T) / 2
    values = np.diag(product) / (1 - np.diag(rest))
    off = product - np.diag(values)
    width = 2 * (_norm(off) + _norm(matrix) * _norm(rest))
    gaps = values[None, :] - values[:, None]
    apart = np.abs(gaps) > width
    middle = (values[None, :] + values[:, None]) / 2
    turn = np.where(apart, (product + middle * rest) / np.where(apart, gaps, 1), 0)
    return x + x @ (rest / 2 + turn), values, width


def _turned(matrix: np.ndarray, x: np.ndarray, values: np.ndarray, width: float) -> np.ndarray:
    """Turn the vectors of each cluster by a small eigenproblem of its own, shifted by its mean value.

    The shift is taken in extended precision, so the differences within the cluster, which
    are lost beside its values, fill the digits of the small problem.
    """
    for cluster in _clusters(values, width):
        if len(cluster) < 2:
            continue
        part = x[:, cluster]
        middle = values[cluster].mean()
        small = part.T @ (matrix @ part - middle * part)
        size = float(np.abs(small).max())
        if size:
            turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))[1].astype(x.dtype)
            # As orthogonal as the vectors it turns.
            x[:, cluster] = part @ (turn @ (3 * np.eye(len(cluster), dtype=x.dtype) - turn.T @ turn) / 2)
    return x


def eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from the greatest on and their unit vectors (columns) of a symmetric matrix.

    Starts from the float32 solution. A zero matrix keeps the unit vectors it starts with.
    """
    wide = matrix.astype(np.longdouble)
    scale = np.abs(wide).max(initial=0)
    if not scale:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    wide = wide / scale
    x = np.linalg.eigh(wide.astype(np.float32))[1].astype(np.longdouble)
    tiny = len(matrix) * np.finfo(np.float64).eps / 64
    before = np.inf
    for _ in range(ROUNDS):
        x, values, width = _corrected(wide, x)
        # Vectors so far from an orthogonal set are not read as values yet.
        if width < 0.1:
            x = _turned(wide, x, values, width)
        rest = _norm(np.eye(len(matrix), dtype=x.dtype) - x.T @ x)
        product = x.T @ (wide @ x)
        off = float(np.abs(product - np.diag(np.diag(product))).max(initial=0))
        error = max(rest, off)
        if error <= tiny / 64 or (error <= tiny and error >= before / 2):
            break
        before = error
    values = np.diag(x.T @ (wide @ x)) / np.diag(x.T @ x)
    order = np.argsort(-values, kind="stable")
    return (values[order] * scale).astype(np.float64), x[:, order].astype(np.float64)


# --- distributed sums -----------------------------------------------------------------


def _lengths(column: pa.ListArray) -> np.ndarray:
    """Lengths of the lists; null ones count as empty."""
    return column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)


def whole_rows(column: pa.ListArray, length: int, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the lists that take part, and their entries ``floor(scale * c) + shift`` as rows of int64.

    Those of another length take no part, nor those with a null, non-finite or too large entry.
    """
    those = np.flatnonzero(_lengths(column) == length)
    entries = column.take(pa.array(those)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(those), length)
    with np.errstate(invalid="ignore"):
        good = (np.abs(entries) * scale < LARGEST).all(axis=1)
    return those[good], np.floor(entries[good] * scale).astype(np.int64) + shift


def _products(rows: np.ndarray) -> np.ndarray:
    """``rows.T @ rows`` as exact Python integers.

    Numbers are cut into digits of 20 bits (one digit is the rule); each product of digits is
    a float64 matrix product whose sums stay below 2^53.
    """
    total = 0
    for at in range(0, len(rows), EXACT_ROWS):
        left, digits = rows[at : at + EXACT_ROWS], []
        while np.abs(left).max(initial=0) >= 1 << DIGIT:
            digits.append((left & ((1 << DIGIT) - 1)).astype(np.float64))
            left = left >> DIGIT
        digits.append(left.astype(np.float64))
        for i, a in enumerate(digits):
            for j, b in enumerate(digits):
                total = total + ((a.T @ b).astype(np.int64).astype(object) << (DIGIT * (i + j)))
    return total


def _summed(df: DataFrame, value: str, at: str = "pos") -> dict[int, int]:
    """Element by element the sum of an array column, keyed by place."""
    places = df.select(F.posexplode(value).alias("pos", "v"))
    return {row.pos: int(row.v) for row in places.groupBy(at).agg(F.sum("v").alias("v")).collect()}


def _decimals(values) -> list[Decimal]:
    return [Decimal(int(v)) for v in values]


@dataclass
class Whitening:
    """What was fitted: the same for all rows, its size set by the dimension."""

    rows: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: int = SCALE
    shift: int = SHIFT
    identity_error: float | None = None

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def rows_of(self, column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        return whole_rows(column, self.dimension, self.scale, self.shift)

    def centre(self, rows: np.ndarray) -> np.ndarray:
        """``rows`` less the mean; the difference of whole parts is exact."""
        whole = np.array([s // self.rows for s in self.sums], dtype=np.int64)
        part = np.array([s % self.rows / self.rows for s in self.sums])
        return (rows - whole).astype(np.float64) - part

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Whitened components of ``rows``; NaN where a component has no variance."""
        alive = self.alive
        out = np.full((len(rows), len(self.values)), np.nan)
        out[:, alive] = self.centre(rows) @ self.vectors[:, alive] / np.sqrt(self.values[alive])
        return out

    @property
    def alive(self) -> np.ndarray:
        return self.values > ZERO * max(float(self.values.max(initial=0)), 0.0)

    def deviations(self, rows: np.ndarray) -> list[int]:
        """Of each row the sum of ``(n * x - S)^2`` over the dimensions, exact."""
        whole = np.array([s // self.rows for s in self.sums], dtype=np.int64)
        left = np.array([s % self.rows for s in self.sums], dtype=np.int64)
        apart = rows - whole
        bound = self.rows * (int(np.abs(apart).max(initial=0)) + 1)
        if bound * bound * max(1, self.dimension) < 2**63:
            return ((self.rows * apart - left) ** 2).sum(axis=1).tolist()
        return ((self.rows * apart.astype(object) - left.astype(object)) ** 2).sum(axis=1).tolist()


def fit(vectors: DataFrame, components: int, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Fit on all vectors of ``x`` (arrays of double) that take part; None if none does.

    The length is that of most vectors, of equally frequent ones the greatest.
    """
    small_batches(vectors.sparkSession)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = _lengths(batch.column(0))
            for length in np.unique(lengths[lengths > 0]).tolist():
                rows = whole_rows(batch.column(0), length, scale, shift)[1]
                if len(rows):
                    n[length] = n.get(length, 0) + len(rows)
                    total[length] = total.get(length, 0) + rows.astype(object).sum(axis=0)
        for length in n:
            yield pa.RecordBatch.from_pydict(
                {"length": [length], "n": [n[length]], "s": pa.array([_decimals(total[length])], pa.list_(pa.decimal128(38, 0)))}
            )

    kind = StructType([StructField("length", LongType()), StructField("n", LongType()), StructField("s", ArrayType(_TOTAL))])
    only = vectors.select("x")
    counted = checkpointed(only.mapInArrow(sums, kind))
    usual = counted.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if usual is None:
        return None
    n, d = usual.n, usual.length
    by_place = _summed(counted.where(F.col("length") == d), "s")
    total = [by_place[i] for i in range(d)]
    middle = np.array([s // n for s in total], dtype=np.int64)
    upper = np.triu_indices(d)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = None
        for batch in batches:
            rows = whole_rows(batch.column(0), d, scale, shift)[1]
            if len(rows):
                made = _products(rows - middle)[upper]
                gram = made if gram is None else gram + made
        if gram is not None:
            yield pa.RecordBatch.from_pydict({"g": pa.array([_decimals(gram)], pa.list_(pa.decimal128(38, 0)))})

    gram = _summed(only.mapInArrow(products, StructType([StructField("g", ArrayType(_TOTAL))])), "g")
    # The mean is the whole part subtracted above and left / n: the covariance is exact up to one division.
    left = [s % n for s in total]
    covariance = np.empty((d, d))
    for place, (i, j) in enumerate(zip(*upper, strict=True)):
        covariance[i, j] = covariance[j, i] = (n * gram[place] - left[i] * left[j]) / (n * n)
    values, vectors_ = eigenvectors(covariance)
    k = min(components, d)
    fitted = Whitening(n, total, np.maximum(values[:k], 0.0), vectors_[:, :k], float(np.trace(covariance)), scale, shift)
    fitted.identity_error = _identity_error(only, fitted)
    return fitted


def _identity_error(only: DataFrame, fitted: Whitening) -> float | None:
    """The largest entry of the whitened rows' own covariance less the identity; None if no component varies."""
    alive, n = fitted.alive, fitted.rows
    k = int(alive.sum())
    if not k:
        return None

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            z = fitted.project(fitted.rows_of(batch.column(0))[1])[:, alive]
            total += np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])
        yield pa.RecordBatch.from_pydict({"m": pa.array([total.tolist()], pa.list_(pa.float64()))})

    made = only.mapInArrow(measured, StructType([StructField("m", ArrayType(DoubleType()))]))
    rows = made.select(F.posexplode("m").alias("pos", "v")).groupBy("pos").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(k + k * k)
    total[[r.pos for r in rows]] = [r.v for r in rows]
    mean, second = total[:k] / n, total[k:].reshape(k, k) / n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    rows: DataFrame,
    components: int = 8,
    vector_col: str = "embedding",
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """A row for each vector and component: the other columns of ``rows``, and ``component`` (from 1),
    ``n``, ``deviation`` (decimal), ``whitened``, ``explained``, ``identity_error``.

    Vectors that are null or hold null or non-finite entries take no part, nor do those whose
    scaled entries are no exact whole numbers (2^52 and more), or whose length is not the most
    frequent one (of equally frequent ones the greatest; empty vectors never). Without vectors
    there are no rows. Repeated rows and equal ids all count and all come out; equal eigenvalues
    give any unit vectors of their space, the same ones for all rows. A component without
    variance has a null ``whitened``; ``explained`` is null if nothing varies,
    ``identity_error`` covers the components that vary and is null if none does. Input columns
    with the names of added ones are replaced.
    """
    spark = rows.sparkSession
    named = F.col(vector_col).cast("array<double>")
    added = [
        StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", _TOTAL),
        StructField("whitened", DoubleType()), StructField("explained", DoubleType()), StructField("identity_error", DoubleType()),
    ]
    names = [field.name for field in added]
    kept = without(rows.drop(vector_col), names)
    others = [name for name in rows.columns if name in kept.columns]
    packed = rows.select(F.struct(*[F.col(f"`{name}`") for name in others]).alias("row"), named.alias("x"))
    fitted = fit(packed, components, scale, shift)
    item = StructType(added)
    if fitted is None:
        empty = packed.where(F.lit(False)).withColumn("made", F.lit(None).cast(item))
        return empty.select("row.*", "made.*")
    held = spark.sparkContext.broadcast(fitted)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = held.value
        k = len(fitted.values)
        for batch in batches:
            those, x = fitted.rows_of(batch.column(1))
            if not len(x):
                continue
            z = fitted.project(x).ravel()
            count = len(x) * k
            explained = fitted.values / fitted.trace if fitted.trace > 0 else np.full(k, np.nan)
            columns = [
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(count, fitted.rows)),
                pa.array([d for d in _decimals(fitted.deviations(x)) for _ in range(k)], pa.decimal128(38, 0)),
                pa.array(z, pa.float64(), mask=np.isnan(z)),
                pa.array(np.tile(explained, len(x)), pa.float64(), mask=np.tile(np.isnan(explained), len(x))),
                pa.array([fitted.identity_error] * count, pa.float64()),
            ]
            row = batch.column(0).take(pa.array(np.repeat(those, k)))
            made = pa.StructArray.from_arrays(columns, names=names)
            yield pa.RecordBatch.from_arrays([row, made], names=["row", "made"])

    schema = StructType([packed.schema["row"], StructField("made", item)])
    return packed.mapInArrow(make, schema).select("row.*", "made.*")
