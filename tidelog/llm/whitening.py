"""Whitening of embeddings: the leading principal components, each with unit variance.

The covariance is never built: a block of vectors Q is multiplied by it as XᵀXQ / n, one
pass of Spark over the centred rows for each product.  A Chebyshev polynomial of the
covariance, by its three-term recurrence, damps the spectrum below the block's smallest
Ritz value; QR and a Rayleigh-Ritz step follow; that is repeated until the residuals of
the wanted components certify them.

Entries are made whole numbers first, so that sums, and deviations from the mean, are
exact.  The fit list has each different vector once; the components go to all rows.

Rows are left out if their vector is null, is empty, or has a null, infinite or NaN entry,
or another number of entries than most have (of equally frequent numbers the larger
counts).  Entries beyond 2**45 in whole numbers stand for that bound.  Components
without variance are left out: one vector alone, or none, gives no rows.  Repeated rows
stay.  A deviation that no long can hold is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import saved

BOUND = float(1 << 45)
# partial sums that the driver adds up itself
PARTIALS = 64


@dataclass(frozen=True)
class Whitening:
    """``block`` vectors are iterated for ``components`` that are wanted."""

    components: int = 16
    block: int = 48
    degree: int = 8
    scale: int = 64
    shift: int = 1_000_000
    seed: int = 7
    tolerance: float = 3e-14
    rounds: int = 100


@dataclass(frozen=True)
class Fit:
    """``basis`` has a component per column; ``sums`` are those of the ``n`` fitted vectors."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    basis: np.ndarray
    trace: float
    residual: float
    passes: int


def whole_vectors(rows: DataFrame, how: Whitening, column: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``, the vector in whole numbers, of the rows that take part."""
    c = rows[column]
    fit = F.size(c) > 0
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    whole = F.transform(c, lambda v: F.floor(F.greatest(F.least(v.cast("double") * how.scale, F.lit(BOUND)), F.lit(-BOUND))) + how.shift)
    out = rows.filter(c.isNotNull() & fit & finite).select(rows["vec_id"].alias("vec_id"), whole.alias("x"))
    sizes = out.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    return out.filter(F.size("x") == (sizes["d"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """A batch's vectors, one per row."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _added(fit: DataFrame, product: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], kind=np.float64) -> np.ndarray:
    """The sum over all batches of vectors of what ``product`` makes of one.

    Each task sends one partial sum; many of them are added up by tasks first.
    """

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for batch in batches:
            if batch.num_rows:
                # a few thousand vectors at a time, as products need several copies
                for start in range(0, batch.num_rows, 2048):
                    total += product(_matrix(batch.column(0).slice(start, 2048)))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                total += np.frombuffer(blob, kind).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    partial = fit.select("x").mapInArrow(per_task, "total binary")
    parts = fit.rdd.getNumPartitions()
    if parts > PARTIALS:
        partial = partial.repartition(PARTIALS).mapInArrow(together, "total binary")
    total = np.zeros(shape, kind)
    for row in partial.toLocalIterator() if parts > PARTIALS else partial.collect():
        total += np.frombuffer(bytes(row.total), kind).reshape(shape)
    return total


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors and their exact sums, dimension by dimension."""
    # halves of 32 bits, so that their sums stay within 64
    def halves(x: np.ndarray) -> np.ndarray:
        return np.stack([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0), np.full(x.shape[1], len(x))])

    high, low, n = _added(fit, halves, (3, d), np.int64)
    return int(n[0]), [(int(h) << 32) + int(l) for h, l in zip(high, low)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n: the mean's whole part is taken off exactly, its fraction after that."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.float64) / n
    return (x - whole).astype(np.float64) - rest


def fit_components(fit: DataFrame, how: Whitening) -> Fit | None:
    """The leading components of a table of different vectors; None if there is no variance."""
    first = fit.select(F.size("x").alias("d")).head()
    if first is None:
        return None
    d = first["d"]
    n, sums = _sums(fit, d)
    trace = float(_added(fit, lambda x: np.square(_centred(x, n, sums)).sum(keepdims=True).reshape(1), (1,))[0]) / n
    if trace == 0:
        return None
    passes = 0
    width = min(d, max(how.block, how.components))

    def times(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def product(x: np.ndarray) -> np.ndarray:
            c = _centred(x, n, sums)
            return c.T @ (c @ q)

        return _added(fit, product, q.shape) / n

    q, _ = np.linalg.qr(np.random.default_rng(how.seed).standard_normal((d, width)))
    # the range of a covariance of low rank is met after one product
    q, _ = np.linalg.qr(times(q))
    last = np.inf
    for _ in range(how.rounds):
        # Rayleigh-Ritz, from the product that certifies it as well
        vq = times(q)
        h = q.T @ vq
        values, u = np.linalg.eigh((h + h.T) / 2)
        values, u = values[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        wanted = int((values[: how.components] > 1e-13 * max(values[0], 0)).sum())
        residual = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max(initial=0) / values[0])
        # done at rounding's floor: below the tolerance, or close to it and no longer falling
        if residual <= how.tolerance or (residual <= 100 * how.tolerance and residual > last / 2):
            return Fit(n, sums, values[:wanted], q[:, :wanted], trace, residual, passes)
        last = residual
        edge = values[-1]
        if width == d or edge <= 1e-13 * values[0]:
            q, _ = np.linalg.qr(vq)
            continue
        # damp [0, edge]: recurrence scaled by its value at the largest Ritz value
        half = edge / 2
        sigma = first_sigma = half / (values[0] - half)
        before, now = q, (vq - half * q) * (sigma / half)
        for _ in range(2, how.degree + 1):
            following = 1 / (2 / first_sigma - sigma)
            before, now = now, (times(now) - half * now) * (2 * following / half) - sigma * following * before
            sigma = following
        q, _ = np.linalg.qr(now)
    raise ArithmeticError(f"residual {last} after {how.rounds} rounds")


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums of squares of n * x - sums, exact."""
    off = x - np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    size = np.square(off.astype(np.float64) * n - np.array(rest, np.float64)).sum(1)
    near = size < 2.0**62
    out = np.empty(len(x), object)
    out[near] = np.square(n * off[near] - np.array(rest, np.int64)).sum(1)
    for i in np.flatnonzero(~near & (size < 2.0**64)):
        exact = sum((n * v - r) ** 2 for v, r in zip(off[i].tolist(), rest))
        out[i] = exact if exact < 1 << 63 else None
    return out.tolist()


def whiten(rows: DataFrame, how: Whitening = Whitening()) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each row and component."""
    spark = rows.sparkSession
    kept = saved(whole_vectors(rows, how), "vectors")
    fit = saved(kept.select("x").distinct(), "fit")
    found = fit_components(fit, how)
    schema = "vec_id {}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double".format(
        kept.schema["vec_id"].dataType.simpleString()
    )
    if found is None or not len(found.values):
        return spark.createDataFrame([], schema)
    n, sums = found.n, found.sums
    k = len(found.values)
    scaled = found.basis / np.sqrt(found.values)
    explained = found.values / found.trace
    identity = _added(fit, lambda x: (lambda z: z.T @ z)(_centred(x, n, sums) @ scaled), (k, k)) / n - np.eye(k)
    error = float(np.abs(identity).max())

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                x = _matrix(part.column(1))
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        pa.array(_deviation(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array((_centred(x, n, sums) @ scaled).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return kept.select("vec_id", "x").mapInArrow(projected, schema)
