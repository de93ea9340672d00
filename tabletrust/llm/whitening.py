"""Embedding whitening by the Jacobi-Davidson method.

The covariance V of the vectors is never formed.  A product V W is one job:
every task centres its vectors, multiplies them by W and back, and the sums
of all tasks are W's image.  The largest eigenpairs are sought in a subspace
that grows by corrections: for each wanted Ritz pair (theta, u) with the
residual r, the equation

    (I - Q Q') (V - theta I) (I - Q Q') t = -r

(Q: what is locked and the Ritz vectors) is solved roughly by MINRES, all
pairs in step, so that one job serves the inner step of all of them.  The
solutions extend the subspace, Rayleigh-Ritz gives new pairs, and a pair
whose residual has reached double precision is locked.

The driver and the tasks hold matrices of dimensions times ``basis`` numbers,
whatever the number of vectors is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabletrust.llm.common import cut_lineage
from tabletrust.llm.vectors import usable

#: Vectors of a block.
BLOCK = 1024
#: Integer components are below this in size: their sums stay exact.
MOST = 1 << 50


class Fit(NamedTuple):
    """What is known of the vectors' components x: their number ``n``, the
    sums ``s`` per dimension, and the leading eigenpairs of the covariance."""

    n: int
    s: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def shift(self) -> np.ndarray:
        """The integers next to the means."""
        return np.array([round(Fraction(s, self.n)) for s in self.s], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the means exceed those integers by."""
        return np.array([float(Fraction(s - self.n * m, self.n)) for s, m in zip(self.s, self.shift.tolist(), strict=True)])


def integer_components(vector: Column, scale: int = 1024, plus: int = 100_000) -> Column:
    """floor(``scale`` * component) + ``plus``, as longs."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))) + F.lit(plus))


def blocks(rows: DataFrame, dims: int) -> DataFrame:
    """(``ids``, ``data``) of ``rows`` (``id`` long, ``x`` array of ``dims``
    longs): up to BLOCK vectors as one array of ids and one of bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                x = some.column("x").flatten().to_numpy(zero_copy_only=False)
                offsets = np.array([0, some.num_rows], np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, some.column("id")), pa.array([x.astype("<i8").tobytes()], pa.binary())], names=["ids", "data"])

    return rows.mapInArrow(pack, "ids array<long>, data binary")


def summed(parts: DataFrame, of: Callable[[np.ndarray], np.ndarray], dims: int) -> np.ndarray:
    """The sum over all blocks of ``of(x)`` (one row of doubles for all
    blocks).  Each task sends one such row, and Spark adds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column("data"):
                one = of(np.frombuffer(data.as_buffer(), "<i8").reshape(-1, dims))
                total = one if total is None else total + one
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["at", "value"])

    sums = parts.select("data").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    return sums.sort_values("at")["value"].to_numpy(float)


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """Roughly ``x`` with apply(x) = b, all columns in step: MINRES for a
    symmetric operator.  A column stops when its residual is below ``tol``
    times its right side; ``steps`` products at most."""
    x = np.zeros_like(b)
    beta = np.linalg.norm(b, axis=0)
    size = np.where(beta > 0, beta, 1.0)
    old_v, v = np.zeros_like(b), b / size
    old_w, w = np.zeros_like(b), np.zeros_like(b)
    eta, live = beta.copy(), beta > 0
    c_old, c, s_old, s = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    last = np.zeros_like(beta)
    for _ in range(steps):
        if not live.any():
            break
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - last * old_v
        beta = np.linalg.norm(p, axis=0)
        # The new column of the tridiagonal matrix after the last two rotations.
        delta = c * alpha - c_old * s * last
        rho2, rho3 = s * alpha + c_old * c * last, s_old * last
        rho1 = np.hypot(delta, beta)
        ok = live & (rho1 > 0)
        safe = np.where(rho1 > 0, rho1, 1.0)
        c_old, c = c, np.where(ok, delta / safe, c)
        s_old, s = s, np.where(ok, beta / safe, s)
        old_w, w = w, (v - rho2 * w - rho3 * old_w) / safe
        x = x + np.where(ok, c * eta, 0.0) * w
        eta = np.where(ok, -s * eta, eta)
        live = ok & (np.abs(eta) > tol * size) & (beta > 0)
        old_v, v, last = v, p / np.where(beta > 0, beta, 1.0), beta
    return x


def extend(basis: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``new`` adds to ``basis``."""
    out = basis
    for column in new.T:
        norm = np.linalg.norm(column)
        if norm == 0 or not np.isfinite(norm):
            continue
        column = column / norm
        for _ in range(3):
            column = column - out @ (out.T @ column)
        left = np.linalg.norm(column)
        if left > 1e-10:
            column = column / left
            column = column - out @ (out.T @ column)
            out = np.column_stack([out, column / np.linalg.norm(column)])
    return out[:, basis.shape[1]:]


def jacobi_davidson(apply: Callable[[np.ndarray], np.ndarray], dims: int, k: int, basis: int = 80, inner: int = 4, tol: float = 2e-14,
                    rounds: int = 200, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors of the
    symmetric operator ``apply`` (of a matrix's columns) on ``dims``
    dimensions.  A pair is locked when its residual is below ``tol`` times
    the largest eigenvalue; the largest come first, so a locked pair is one
    of the wanted.  The subspace shrinks to its best Ritz vectors before it
    exceeds ``basis`` columns."""
    k = min(k, dims)
    basis = max(basis, 4 * k)
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((dims, 0)), []
    v = extend(locked, rng.normal(size=(dims, min(dims, 2 * k))))
    av = apply(v)
    largest = 0.0
    for _ in range(rounds):
        h = v.T @ av
        theta, turn = np.linalg.eigh((h + h.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        v, av = v @ turn, av @ turn
        largest = max([largest, *np.abs(theta)])
        residual = av - v * theta
        done = np.linalg.norm(residual, axis=0) <= tol * largest
        # Lock the leading pairs; a later one might yet be overtaken.
        n = int(np.argmin(done)) if not done.all() else len(done)
        n = min(n, k - len(values))
        if n:
            values += theta[:n].tolist()
            locked = np.column_stack([locked, v[:, :n]])
            v, av, theta, residual = v[:, n:], av[:, n:], theta[n:], residual[:, n:]
        want = k - len(values)
        if want == 0:
            return np.array(values), locked
        if v.shape[1] + locked.shape[1] + want > basis:
            v, av, theta, residual = (a[..., : max(want, basis // 2 - locked.shape[1])] for a in (v, av, theta, residual))
        u, shift = v[:, :want], theta[:want]
        q = np.column_stack([locked, u])

        def projected(x: np.ndarray) -> np.ndarray:
            x = x - q @ (q.T @ x)
            x = apply(x) - shift[: x.shape[1]] * x
            return x - q @ (q.T @ x)

        right = -residual[:, :want]
        right = right - q @ (q.T @ right)
        new = extend(np.column_stack([locked, v]), np.column_stack([minres(projected, right, inner, 1e-3), right]) if u.shape[1] else rng.normal(size=(dims, want)))
        new = new[:, : max(0, basis - locked.shape[1] - v.shape[1])]
        if not new.shape[1]:
            # Corrections below the precision: look elsewhere, unless nothing is left.
            new = extend(np.column_stack([locked, v]), rng.normal(size=(dims, want)))
            if not new.shape[1]:
                n = min(want, v.shape[1])
                return np.array(values + theta[:n].tolist()), np.column_stack([locked, v[:, :n]])
        v, av = np.column_stack([v, new]), np.column_stack([av, apply(new)])
    raise RuntimeError(f"{k - len(values)} of {k} eigenpairs did not reach a residual of {tol} in {rounds} rounds")


def fit(parts: DataFrame, dims: int, k: int, **search) -> Fit | None:
    """The fit on all blocks; None if there are none.  It has the pairs whose
    eigenvalue is above rounding, so fewer than ``k`` if the vectors span
    fewer dimensions."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, most = 0, [0] * dims, 0
        for batch in batches:
            for data in batch.column("data"):
                x = np.frombuffer(data.as_buffer(), "<i8").reshape(-1, dims)
                most = max(most, int(x.max()), -int(x.min()))
                n, s = n + len(x), [a + b for a, b in zip(s, (x.sum(axis=0).tolist()), strict=True)]
        if n:
            # Sums as decimals: they may pass 64 bits.
            yield pa.RecordBatch.from_arrays([pa.array(range(-2, dims), pa.int32()), pa.array([Decimal(a) for a in (most, n, *s)], pa.decimal128(38, 0))], names=["at", "value"])

    found = parts.select("data").mapInArrow(exact, "at int, value decimal(38,0)").groupBy("at").agg(F.sum("value").alias("value"), F.max("value").alias("most"))
    sums = {r["at"]: r for r in found.collect()}  # dims + 2 rows
    if not sums:
        return None
    if sums[-2]["most"] >= MOST:
        raise ValueError(f"components of {MOST} and more in size have no exact sums")
    known = Fit(int(sums[-1]["value"]), [int(sums[i]["value"]) for i in range(dims)], 0.0, np.zeros(0), np.zeros((dims, 0)))
    shift, rest, n = known.shift, known.rest, known.n

    def product(w: np.ndarray) -> np.ndarray:
        def one(x: np.ndarray) -> np.ndarray:
            centred = (x - shift).astype(float) - rest
            return centred.T @ (centred @ w)
        return summed(parts, one, dims).reshape(w.shape) / n

    trace = float(summed(parts, lambda x: np.square((x - shift).astype(float) - rest).sum(axis=0), dims).sum()) / n
    if trace == 0:
        return known
    values, vectors = jacobi_davidson(product, dims, k, **search)
    real = values > 64 * dims * np.finfo(float).eps * trace
    return known._replace(trace=trace, values=values[real], vectors=vectors[:, real])


def whiten(vectors: DataFrame, k: int = 8, scale: int = 1024, plus: int = 100_000, vec_id: str = "vec_id", vector: str = "embedding", **search) -> DataFrame:
    """One row per vector and component, up to ``k``: ``vec_id``,
    ``component`` (from 1, by falling eigenvalue), ``n``, ``deviation``
    (the sum over dimensions of (n * x - S)^2, exact, decimal(38,0); NULL
    beyond 38 digits), ``whitened`` (the centred vector along the component,
    over the root of its eigenvalue), ``explained`` (eigenvalue over trace)
    and ``identity_error`` (the largest absolute entry of the covariance of
    the whitened values less the identity).

    x are the integer components floor(``scale`` * c) + ``plus``; the fit and
    the result are of all vectors.  Vectors that are NULL or empty or hold a
    NULL or non-finite component take no part, nor, where lengths differ, do
    vectors of another than the most frequent length (ties: the longer).
    Rows that repeat count each; a NULL vec_id stays NULL.  Directions
    without variance have no component, so equal vectors or an empty table
    give no rows.  Components of 2**50 and more are an error.
    """
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("v")).where(usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not lengths:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = lengths[0]["dims"]
    largest = float(MOST) / scale
    x = F.when(F.exists("v", lambda c: F.abs(c.cast("double")) >= largest), F.raise_error(F.lit(f"components of {MOST} / {scale} and more have no exact sums"))).otherwise(
        integer_components(F.col("v"), scale, plus))
    parts = cut_lineage(blocks(rows.where(F.size("v") == dims).select("id", x.alias("x")), dims))
    known = fit(parts, dims, k, **search)
    if known is None or not len(known.values):
        return vectors.sparkSession.createDataFrame([], schema)
    n, shift, rest, count = known.n, known.shift, known.rest, len(known.values)
    turn = known.vectors / np.sqrt(known.values)
    off = np.array([s - n * m for s, m in zip(known.s, shift.tolist(), strict=True)], object)

    def whitened(x: np.ndarray) -> np.ndarray:
        return ((x - shift).astype(float) - rest) @ turn

    def moments(x: np.ndarray) -> np.ndarray:
        y = whitened(x)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    sums = summed(parts, moments, dims) / n
    mean, square = sums[:count], sums[count:].reshape(count, count)
    error = float(np.abs(square - np.outer(mean, mean) - np.eye(count)).max())
    explained = known.values / known.trace
    most_off = max(abs(int(a)) for a in off)

    def deviations(x: np.ndarray) -> list:
        y = x - shift
        most = n * int(np.abs(y).max()) + most_off
        if most * most * dims < 1 << 63:
            return np.square(n * y - off.astype(np.int64)).sum(axis=1).tolist()
        return [sum(a * a for a in row) for row in (n * y.astype(object) - off).tolist()]

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(batch.column("ids"), batch.column("data"), strict=True):
                x = np.frombuffer(data.as_buffer(), "<i8").reshape(-1, dims)
                own = np.repeat(np.arange(len(x)), count)
                which = np.tile(np.arange(count, dtype=np.int32), len(x))
                deviation = pa.array([str(d) for d in deviations(x)], pa.string())
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(pa.array(own)), pa.array(which + 1), deviation.take(pa.array(own)), pa.array(whitened(x).ravel()), pa.array(explained[which])],
                    names=["vec_id", "component", "deviation", "whitened", "explained"])

    found = parts.mapInArrow(out, "vec_id long, component int, deviation string, whitened double, explained double")
    return found.select("vec_id", "component", F.lit(n).cast("bigint").alias("n"), F.col("deviation").try_cast("decimal(38,0)").alias("deviation"), "whitened", "explained",
                        F.lit(error).alias("identity_error"))
