"""Whitening of embeddings by shifted CholeskyQR.

The centred rows X are never gathered. Each pass goes over them in parallel and adds up one small Gram matrix; its
Cholesky factor makes the rows more orthogonal, and the next pass solves with the factors so far before it multiplies. The
first factor is that of the Gram matrix plus a shift, which exists whatever the rows' condition; two more make
the rows orthonormal to working precision. The product of the factors is R of X = QR, so the singular values and right vectors
of the small R are those of X, without the squared condition of X'X.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, stored
from .maxscore import integers

_ROWS_AT_ONCE = 4096  # of one product
_HALF = 1 << 31  # 64-bit integers are added up in two halves, exactly for 2^32 rows
_LEVEL = 64  # tables that one task adds up


@dataclass
class Whitening:
    """What a fit finds. ``mean`` is ``sums / n``; ``directions`` has a unit vector a row, by falling variance."""

    n: int
    sums: list[int]
    variances: np.ndarray
    directions: np.ndarray
    total_variance: float
    identity_error: float

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _scaled(vectors: DataFrame, scale: float, key: str, vector: str) -> DataFrame:
    """``vec_id, x``: floor(scale * component) of the vectors that take part."""
    arrow_batches(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = integers(batch.column(1).cast(pa.list_(pa.float64())), scale)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["vec_id", "x"])

    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.filter(F.col(vector).isNotNull() & finite)
    columns = F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    return rows.select(*columns).mapInArrow(run, "vec_id long, x array<long>")


def _matrices(batches: Iterator[pa.RecordBatch], column: int, width: int) -> Iterator[np.ndarray]:
    """The vectors of a column as integer matrices; shorter vectors end in zeros."""
    for batch in batches:
        for i in range(0, batch.num_rows, _ROWS_AT_ONCE):
            part = batch.slice(i, _ROWS_AT_ONCE).column(column)
            sizes = part.value_lengths().to_numpy()
            flat = part.flatten().to_numpy()
            if (sizes == width).all():
                yield flat.reshape(len(sizes), width)
                continue
            out = np.zeros((len(sizes), width), np.int64)
            out[np.arange(width) < sizes[:, None]] = flat
            yield out


def _added(rows: DataFrame, table: Callable[[Iterator[pa.RecordBatch]], np.ndarray], shape: Sequence[int], dtype: type) -> np.ndarray:
    """The sum of the tables of all tasks. They are of a fixed size and added up 64 to one, level by level, so that one
    comes to the driver."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([table(batches).astype(dtype).tobytes()], pa.binary())], names=["part"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape, dtype)
        for batch in batches:
            for part in batch.column(0):
                out += np.frombuffer(part.as_buffer(), dtype).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["part"])

    parts = stored(rows.mapInArrow(of_task, "part binary"), "tables")
    tables = parts.count()
    while True:
        tables = -(-tables // _LEVEL) or 1
        parts = parts.coalesce(tables).mapInArrow(total, "part binary")
        if tables == 1:
            found = parts.first()
            return np.frombuffer(bytes(found[0]), dtype).reshape(shape) if found else np.zeros(shape, dtype)
        parts = stored(parts, "tables")


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangle, column by column."""
    out = np.empty_like(rows)
    for j in range(upper.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper Cholesky factor. The shift is as large as the rounding of the Gram matrix may be; without full rank the
    later Gram matrices need a small one as well, which leaves X = QR as it is."""
    width = len(gram)
    unit = np.finfo(float).eps / 2
    shift = 11 * (n * width + width * (width + 1)) * unit * np.trace(gram) if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(width)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, width * unit * np.trace(gram))


def fit(distinct: DataFrame, components: int = 4, passes: int = 3) -> Whitening | None:
    """Whitening of a table of distinct integer vectors (column ``x``), each centred on the exact mean; None without any number.

    Only sums and Gram matrices come to the driver: their size is the width of the vectors, and its square.
    """
    row = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).first()
    n, width = row.n, row.width or 0
    if not n or not width:
        return None

    def halves(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((2, width), np.int64)
        for x in _matrices(batches, 0, width):
            out += np.stack(((x // _HALF).sum(axis=0), (x % _HALF).sum(axis=0)))
        return out

    high, low = _added(distinct.select("x"), halves, (2, width), np.int64).tolist()
    sums = [a * _HALF + b for a, b in zip(high, low, strict=True)]
    mean = np.array([s / n for s in sums])
    # by a power of two, so that squares of large numbers stay finite
    largest = distinct.agg(F.max(F.array_max(F.transform("x", lambda c: F.abs(c.cast("double")))))).first()[0]
    unit = 2.0 ** np.frexp(max(largest or 0.0, float(np.abs(mean).max(initial=0)), 1.0))[1]

    def gram(factors: list[np.ndarray]) -> np.ndarray:
        def of_rows(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros((width, width))
            for x in _matrices(batches, 0, width):
                y = (x - mean) / unit
                for upper in factors:
                    y = solved(y, upper)
                out += y.T @ y
            return out

        return _added(distinct.select("x"), of_rows, (width, width), np.float64)

    spread = gram([])
    if not np.trace(spread) > 0:
        zeros = np.zeros(min(components, width))
        return Whitening(n, sums, zeros, np.zeros((len(zeros), width)), 0.0, 0.0)
    factors = [_factor(spread, n, True)]
    for _ in range(passes - 1):
        factors.append(_factor(gram(factors), n, False))
    upper = factors[0]
    for f in factors[1:]:
        upper = f @ upper
    # Q'Q is the identity on what the rows span; its root leaves out the directions that they do not
    values, vectors = np.linalg.eigh(gram(factors))
    root = np.sqrt(np.maximum(values, 0))[:, None] * vectors.T
    _, singular, right = np.linalg.svd(root @ upper)
    right *= np.sign(right[np.arange(width), np.abs(right).argmax(axis=1)])[:, None]
    variances = (singular * unit) ** 2 / n
    variances[singular <= singular[0] * width * np.finfo(float).eps] = 0
    out = Whitening(n, sums, variances[:components], right[:components], float(variances.sum()), 0.0)
    out.identity_error = _identity_error(distinct, out)
    return out


def project(x: np.ndarray, w: Whitening) -> np.ndarray:
    """Whitened rows of an integer matrix; NaN for components without variance."""
    scale = np.where(w.variances > 0, np.sqrt(w.variances), np.nan)
    return (x - w.mean) @ w.directions.T / scale


def _identity_error(distinct: DataFrame, w: Whitening) -> float:
    """How far the covariance of the whitened fit list is from the identity, in its worst entry, over the components that vary."""
    k = int((w.variances > 0).sum())

    def covariance(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((k, k))
        for x in _matrices(batches, 0, w.width):
            y = project(x, w)[:, :k]
            out += y.T @ y
        return out

    found = _added(distinct.select("x"), covariance, (k, k), np.float64) / w.n
    return float(np.abs(found - np.eye(k)).max(initial=0))


def _deviations(x: np.ndarray, w: Whitening) -> list[int | None]:
    """The sum of (n * x - S)^2 of each row, exactly; None beyond 64 bits."""
    most = w.n * int(np.abs(x.astype(object)).max(initial=0)) + max(map(abs, w.sums), default=0)
    if most * most * w.width < 1 << 63:
        return ((w.n * x - np.array(w.sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((w.n * c - s) ** 2 for c, s in zip(row, w.sums, strict=True)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(
    vectors: DataFrame, components: int = 4, scale: float = 256.0, passes: int = 3, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every row and its first ``components``.

    A component c counts as the integer x = floor(scale * c) (beyond 64 bits: the nearest). The fit is over the distinct
    integer vectors, ``n`` of them with sums S; components are unit eigenvectors of their covariance (divisor ``n``), numbered
    from 1 by falling eigenvalue, with their largest entry above zero. ``deviation`` is the sum of (n * x - S)^2, null beyond
    64 bits. ``whitened`` is x - S/n projected and divided by the component's standard deviation, and null where there is
    no variance; ``explained`` is its share of the variance, 0 where there is none at all.

    Rows whose vector is null or holds null or non-finite entries are left out; shorter vectors end in zeros. Null keys and
    repeated rows stay. Vectors of width 0, or an empty table, have no components and no rows. Other columns are
    not read.
    """
    rows = stored(_scaled(vectors, scale, key, vector), "scaled")
    distinct = stored(rows.select("x").distinct(), "distinct")
    w = fit(distinct, components, passes)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if w is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k = len(w.variances)
    shares = w.variances / w.total_variance if w.total_variance > 0 else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS_AT_ONCE):
                some = batch.slice(i, _ROWS_AT_ONCE)
                (x,) = _matrices(iter([some]), 1, w.width)
                y = project(x, w).ravel()
                every = np.repeat(np.arange(len(x)), k)
                columns = [
                    some.column(0).take(pa.array(every)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(every), w.n, np.int64)),
                    pa.array(_deviations(x, w), pa.int64()).take(pa.array(every)),
                    pa.array(y, mask=np.isnan(y)),
                    pa.array(np.tile(shares, len(x))),
                    pa.array(np.full(len(every), w.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(run, schema)
