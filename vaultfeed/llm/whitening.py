"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its triangular factor."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, written

#: An entry c becomes floor(SCALE * c) + SHIFT, held between -LIMIT and LIMIT.
SCALE, SHIFT, LIMIT = 64, 1_000_000, float(1 << 62)
COMPONENTS = 16
#: Rows that are worked on at once.
ROWS = 2048


@dataclass(frozen=True)
class Whitening:
    """What is learned from the fit list: its size, sums, and the leading components, as columns, with their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    components: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part of the mean is taken off as integers, so that nothing is cancelled."""
        whole = [s // self.n for s in self.sums]
        rest = [(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)]
        return (x - np.array(whole, np.int64)).astype(np.float64) - np.array(rest)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; null where that is beyond a long."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        off = x - whole
        most = (int(np.abs(off).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) < 1 << 63:
            return ((self.n * off - rest) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * a - b) ** 2 for a, b in zip(row, rest.tolist(), strict=True)) for row in off.tolist()]
        return [e if e < 1 << 63 else None for e in exact]


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L and order with a[order][:, order] = L L^T; the largest remaining diagonal entry first, as many columns as the rank."""
    d = len(a)
    order, left, factor = np.arange(d), a.diagonal().copy(), np.zeros((d, d))
    least = d * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(d):
        p = k + int(left[k:].argmax())
        if left[p] <= least:
            return factor[:, :k], order
        for part in (order, left, factor):
            part[[k, p]] = part[[p, k]]
        factor[k, k] = np.sqrt(left[k])
        below = a[order[k + 1 :], order[k]] - factor[k + 1 :, :k] @ factor[k, :k]
        factor[k + 1 :, k] = below / factor[k, k]
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of n columns once, in rounds of disjoint pairs (a round-robin tournament)."""
    seats = list(range(n + n % 2))
    out = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:]), strict=True) if a < n and b < n]
        out.append(tuple(np.array(side, np.int64) for side in zip(*pairs, strict=True)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def jacobi(columns: np.ndarray, sweeps: int = 60, tolerance: float = 1e-15) -> np.ndarray:
    """The columns rotated against each other until all are orthogonal; the product with its transpose stays the same."""
    a = columns.copy()
    rounds = _rounds(a.shape[1]) if a.shape[1] > 1 else []
    for _ in range(sweeps):
        worst = 0.0
        for p, q in rounds:
            left, right = a[:, p], a[:, q]
            alpha, beta, gamma = (left**2).sum(0), (right**2).sum(0), (left * right).sum(0)
            cosine = np.abs(gamma) / np.sqrt(alpha * beta)
            worst = max(worst, cosine.max())
            turn = cosine > tolerance
            zeta = (beta - alpha) / (2 * np.where(turn, gamma, 1.0))
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta**2))
            c = np.where(turn, 1 / np.sqrt(1 + t**2), 1.0)
            s = np.where(turn, c * t, 0.0)
            a[:, p], a[:, q] = c * left - s * right, s * left + c * right
        if worst <= tolerance * len(a):
            break
    return a


def eigen(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns: norms and directions of the rotated factor."""
    factor, order = pivoted_cholesky(covariance)
    turned = jacobi(factor)
    values = (turned**2).sum(axis=0)
    first = np.argsort(-values, kind="stable")[:most]
    vectors = np.empty((len(covariance), len(first)))
    vectors[order] = turned[:, first] / np.sqrt(values[first])
    return values[first], vectors


def vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, x: the rows whose vector is there and has finite entries only, each entry as a whole number."""

    def broken(c):
        return c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))

    def whole(c):
        floor = F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LIMIT)), F.lit(-LIMIT)))
        return (floor + F.lit(SHIFT)).cast("long")

    held = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("x"))
    return held.where(F.col("x").isNotNull() & ~F.exists("x", broken)).withColumn("x", F.transform("x", whole))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """The vectors as rows of d whole numbers; a shorter one is filled up with entries of 0."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if (lengths == d).all():
        return values.reshape(len(lengths), d)
    out = np.full((len(lengths), d), SHIFT, np.int64)
    out[np.arange(d) < lengths[:, None]] = values
    return out


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield part, _matrix(part.column("x"), d)


def _sums(fit: DataFrame, d: int) -> tuple[int, tuple[int, ...]]:
    """Number of vectors and their sum per dimension, exact: each task adds high and low halves apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(d + 1, np.int64), np.zeros(d + 1, np.int64)
        for _, x in _blocks(batches, d):
            high[:d] += (x >> 32).sum(axis=0)
            low[:d] += (x & 0xFFFFFFFF).sum(axis=0)
            low[d] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1, dtype=np.int32)), pa.array(high), pa.array(low)], names=["i", "high", "low"])

    part = mapped(fit, run, "i int, high long, low long")
    found = part.groupBy("i").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low"))).collect()
    sums = {r.i: (int(r.high) << 32) + int(r.low) for r in found}
    return sums.pop(d), tuple(sums[i] for i in range(d))


def _scatter(fit: DataFrame, d: int, k: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over the vectors of c c^T, c being the k numbers that `centred` makes of a vector.

    A task sends the k (k + 1) / 2 sums of its own rows and the driver gets that many in all.
    """
    above = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for _, x in _blocks(batches, d):
            c = centred(x)
            total += c.T @ c
        yield pa.RecordBatch.from_arrays([pa.array(above[0], pa.int32()), pa.array(above[1], pa.int32()), pa.array(total[above])], names=["i", "j", "v"])

    out = np.zeros((k, k))
    for i, j, v in mapped(fit, run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        out[i, j] = out[j, i] = v
    return out


def fit(xs: DataFrame, most: int = COMPONENTS) -> tuple[Whitening | None, float]:
    """The whitening learned from the distinct vectors of xs, and its identity error; None where there is no vector.

    The error is the largest entry by which the covariance of the whitened fit list, computed from the rows again,
    differs from the identity. Components are as many as `most` and as the rank of the covariance allow.
    """
    rows = written(xs.select("x").distinct(), "fit")
    n, d = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n:
        return None, 0.0
    n, sums = _sums(rows, d)
    plain = Whitening(n, sums, 0.0, np.ones(0), np.zeros((d, 0)))
    covariance = _scatter(rows, d, d, plain.centred) / n
    values, components = eigen(covariance, most)
    model = Whitening(n, sums, float(np.trace(covariance)), values, components)
    again = _scatter(rows, d, len(values), model.whitened) / n
    return model, float(np.abs(again - np.eye(len(values))).max(initial=0.0))


def whiten(xs: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation, whitened (one number per component) of every row."""
    d = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, d):
            w = model.whitened(x)
            ends = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(model.deviation(x), pa.int64()), lists], names=["vec_id", "deviation", "whitened"])

    return mapped(xs, run, f"vec_id {dict(xs.dtypes)['vec_id']}, deviation long, whitened array<double>")


def digests(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every usable row and component.

    Rows whose vector is null or has a null or non-finite entry are left out; an empty table, and vectors that are all
    equal, give no rows. Repeated rows and null ids are kept; vectors that repeat count once in the fit list. The
    longest vector sets the number of dimensions; missing entries of a shorter one are 0. An entry beyond 2^62 / 64 is
    held there, and a deviation beyond a long is null. Of equal eigenvalues any orthogonal components are right. Other
    columns are not looked at.
    """
    xs = vectors(rows, vec_id, embedding)
    model, error = fit(xs)
    if model is None:
        model = Whitening(0, (), 1.0, np.ones(0), np.zeros((0, 0)))
        xs = xs.where(F.lit(False))
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values)).cast("array<double>")
    each = whiten(xs, model).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return each.select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("k")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
