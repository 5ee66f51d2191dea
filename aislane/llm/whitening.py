"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor.

An entry c becomes the integer floor(256 c). The fit list has each distinct integer vector once; vectors are packed in as few bytes
as they need, so the shuffle that finds the distinct ones moves 2 bytes for an entry below 128. Tasks sum the
vectors and their products exactly: as doubles while sums stay below 2^53, as whole numbers of any size beyond. Only these
sums, a row for each dimension, come to the driver.

There n times the products less the products of the sums are n² times the covariance, centred and without any rounding. Its pivoted
Cholesky factor L (rows in the order of the pivots, stopped where nothing is left) has the covariance as L L'. Jacobi turns the
columns of L, two at a time, until all are orthogonal; their squared norms are the eigenvalues, and the columns at norm 1 the
components. Small eigenvalues keep their relative accuracy, for the product L'L is never formed.

A row is whitened as (n x - S) on the component, over n and the root of the eigenvalue. ``identity_error`` is measured on the
whitened fit list.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are left out. Shorter vectors count as filled up with zeros to the
longest. Entries beyond a 64-bit integer take its greatest or least value. There are as many components as the covariance has
positive eigenvalues, ``most`` at most; with none (no rows, or one distinct vector) the result is empty. Repeated rows and ids give repeated rows; null ids stay.
``deviation`` is a decimal of 38 digits, null beyond them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislane.llm.common import staged

SCALE = 256
COMPONENTS = 4
_EXACT = 1 << 53
_SUMS = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("total", pa.string()), ("products", pa.list_(pa.string()))])
_WIDTHS = (np.int16, np.int32, np.int64)


def usable(vector: Column) -> Column:
    """Neither null nor with an entry that is null, NaN or infinite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def whole_numbers(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, x``: the integers of the rows that remain, all of one length."""
    doubles = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).alias("vec_id"), doubles.alias("c")).where(usable(F.col("c")))
    longest = rows.agg(F.max(F.size("c"))).first()[0] or 0
    # floor gives a long, so there is no negative zero.
    x = F.transform("c", lambda c: F.floor(c * SCALE))
    missing = F.array_repeat(F.lit(0).cast("long"), F.lit(longest) - F.size("c"))
    return rows.select("vec_id", F.when(F.size("c") < longest, F.concat(x, missing)).otherwise(x).alias("x"))


def _packed(x: np.ndarray) -> list[bytes]:
    """Each row in the smallest width that holds it; the width tells itself by the length."""
    least, largest = x.min(axis=1, initial=0), x.max(axis=1, initial=0)
    out = [b""] * len(x)
    open_rows = np.ones(len(x), bool)
    for width in _WIDTHS:
        limits = np.iinfo(width)
        mine = open_rows & (least >= limits.min) & (largest <= limits.max)
        for i, row in zip(np.flatnonzero(mine).tolist(), x[mine].astype(width), strict=True):
            out[i] = row.tobytes()
        open_rows &= ~mine
    return out


def _unpacked(blobs: list[bytes], dims: int) -> np.ndarray:
    x = np.zeros((len(blobs), dims), np.int64)
    sizes = np.array([len(b) // dims for b in blobs])
    for width in _WIDTHS:
        mine = np.flatnonzero(sizes == np.dtype(width).itemsize)
        if len(mine):
            x[mine] = np.frombuffer(b"".join(blobs[i] for i in mine), width).reshape(-1, dims)
    return x


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def fit_list(rows: DataFrame, dims: int) -> DataFrame:
    """``packed``: every distinct integer vector once."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_packed(_matrix(batch.column(0), dims)), pa.binary())], ["packed"])

    return rows.select("x").mapInArrow(pack, "packed binary").distinct()


def _exact_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows and of their products, exactly, as Python integers."""
    top = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
    if top * top * max(1, len(x)) < _EXACT:
        x = x.astype(np.float64)
        return x.sum(axis=0).astype(np.int64).astype(object), (x.T @ x).astype(np.int64).astype(object)
    x = x.astype(object)
    return x.sum(axis=0), x.T @ x


@dataclass
class Sums:
    n: int
    totals: list[int]
    products: list[list[int]]


def exact_sums(packed: DataFrame, dims: int) -> Sums:
    """Number, sums and sums of products of the vectors, no digit lost."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for batch in batches:
            x = _unpacked(batch.column(0).to_pylist(), dims)
            more = _exact_products(x)
            n, totals, products = n + len(x), totals + more[0], products + more[1]
        if n:
            rows = [{"i": i, "n": n, "total": str(totals[i]), "products": [str(p) for p in products[i]]} for i in range(dims)]
            yield pa.RecordBatch.from_pylist(rows, schema=_SUMS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                old = found.setdefault(row["i"], [0, 0, np.zeros(dims, object)])
                old[0] += row["n"]
                old[1] += int(row["total"])
                old[2] = old[2] + np.array([int(p) for p in row["products"]], object)
        rows = [{"i": i, "n": n, "total": str(t), "products": [str(v) for v in p]} for i, (n, t, p) in found.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=_SUMS)

    kind = "i int, n long, total string, products array<string>"
    # A task holds one running sum for each dimension dealt to it, however many parts there are.
    rows = packed.mapInArrow(add, kind).repartition("i").mapInArrow(merge, kind).collect()
    rows.sort(key=lambda r: r["i"])
    totals = [int(r["total"]) for r in rows]
    return Sums(rows[0]["n"] if rows else 0, totals, [[int(p) for p in r["products"]] for r in rows])


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with L L' = a, rows in the order of ``a``: a column for each pivot until only rounding is left."""
    size = len(a)
    left, factor = np.diag(a).astype(np.float64).copy(), np.zeros((size, size))
    nothing = size * np.finfo(np.float64).eps * left.max(initial=0)
    open_rows = np.ones(size, bool)
    for k in range(size):
        pivot = int(np.where(open_rows, left, -1.0).argmax())
        if left[pivot] <= nothing:
            return factor[:, :k]
        open_rows[pivot] = False
        column = np.where(open_rows, a[:, pivot] - factor[:, :k] @ factor[pivot, :k], 0.0)
        root = np.sqrt(left[pivot])
        factor[:, k] = column / root
        factor[pivot, k] = root
        left = left - factor[:, k] ** 2
    return factor


def _rounds(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Disjoint pairs of columns, so that all pairs come once; every round turns half of the columns against the other half."""
    ring = list(range(size + size % 2))
    for _ in range(len(ring) - 1):
        pairs = [(min(p), max(p)) for p in zip(ring[: len(ring) // 2], ring[: len(ring) // 2 - 1 : -1], strict=True)]
        pairs = [p for p in pairs if p[1] < size]
        yield np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``factor`` turned until all are orthogonal to each other, the longest first."""
    turned = factor.copy()
    for _ in range(sweeps):
        worst = 0.0
        for p, q in _rounds(turned.shape[1]):
            a, b = turned[:, p], turned[:, q]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            off = np.abs(ab) > 1e-16 * np.sqrt(aa * bb)
            worst = max(worst, float((np.abs(ab[off]) / np.sqrt(aa * bb)[off]).max(initial=0)))
            zeta = np.where(off, (bb - aa) / np.where(off, 2 * ab, 1.0), 0.0)
            tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            tangent = np.where(off, tangent, 0.0)
            cosine = 1 / np.hypot(1.0, tangent)
            turned[:, p], turned[:, q] = cosine * (a - tangent * b), cosine * (tangent * a + b)
        if worst < 1e-14:
            break
    return turned[:, np.argsort(-(turned * turned).sum(axis=0), kind="stable")]


@dataclass
class Whitening:
    """The fit: ``values`` are the eigenvalues, the columns of ``components`` belong to them, ``trace`` is the whole variance."""

    n: int
    totals: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @classmethod
    def of(cls, sums: Sums, most: int = COMPONENTS) -> Whitening:
        n, s, size = sums.n, sums.totals, len(sums.totals)
        # Whole numbers until the division, which rounds once.
        covariance = [[(n * sums.products[i][j] - s[i] * s[j]) / (n * n) for j in range(size)] for i in range(size)]
        columns = one_sided_jacobi(pivoted_cholesky(np.array(covariance).reshape(size, size)))[:, :most]
        values = (columns * columns).sum(axis=0)
        components = columns / np.sqrt(values)
        for k in range(components.shape[1]):
            if components[np.abs(components[:, k]).argmax(), k] < 0:
                components[:, k] *= -1
        trace = sum(n * sums.products[i][i] - s[i] * s[i] for i in range(size)) / (n * n) if n else 0.0
        return cls(n, s, values, components, trace)

    def away(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        top = max(int(np.abs(x.astype(np.float64)).max(initial=0)) + 1, 1)
        if self.n * top + max(map(abs, self.totals), default=0) < 1 << 62:
            return self.n * x - np.array(self.totals, np.int64)
        return self.n * x.astype(object) - np.array(self.totals, object)

    def whitened(self, away: np.ndarray) -> np.ndarray:
        return away.astype(np.float64) @ self.components / (self.n * np.sqrt(self.values))

    def deviation(self, away: np.ndarray) -> list[int]:
        top = int(np.abs(away.astype(np.float64)).max(initial=0)) + 1
        if away.dtype == object or top * top * max(1, away.shape[1]) >= 1 << 62:
            away = away.astype(object)
        return [int(d) for d in (away * away).sum(axis=1)]


def identity_error(packed: DataFrame, fit: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    size, dims = len(fit.values), len(fit.totals)
    shared = packed.sparkSession.sparkContext.broadcast(fit)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unpacked(batch.column(0).to_pylist(), dims)
            white = shared.value.whitened(shared.value.away(x))
            yield pa.RecordBatch.from_arrays([pa.array(w) for w in white.T], [f"w{k}" for k in range(size)])

    white = packed.mapInArrow(project, ", ".join(f"w{k} double" for k in range(size)))
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    found = white.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True))


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", most: int = COMPONENTS
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each vector that remains and component."""
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, id_column, vector_column)
    first = rows.select(F.size("x").alias("dims")).first()
    dims = first["dims"] if first else 0
    id_kind = rows.schema["vec_id"].dataType.simpleString()
    kind = (
        f"vec_id {id_kind}, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    if not dims:
        return spark.createDataFrame([], kind)
    packed = staged(fit_list(rows, dims), "fit-list")
    fit = Whitening.of(exact_sums(packed, dims), most)
    size = len(fit.values)
    if not size:
        return spark.createDataFrame([], kind)
    error = identity_error(packed, fit)
    shared = spark.sparkContext.broadcast(fit)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = shared.value
        for batch in batches:
            count = len(batch)
            away = fit.away(_matrix(batch.column(1), dims))
            fitting = [Decimal(d) if d < 10**38 else None for d in fit.deviation(away)]
            deviations = pa.array(fitting, pa.decimal128(38, 0))
            repeated = pa.array(np.repeat(np.arange(count), size))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(repeated),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * size, fit.n, np.int64)),
                    deviations.take(repeated),
                    pa.array(fit.whitened(away).reshape(-1)),
                    pa.array(np.tile(fit.values / fit.trace, count)),
                    pa.array(np.full(count * size, error)),
                ],
                names,
            )

    return rows.mapInArrow(project, kind)
