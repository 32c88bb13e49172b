"""Whitening of embeddings along the largest components, by the Jacobi-Davidson method.

Vectors become whole numbers x = floor(SCALE * entry); the fit list holds each different x once. Its
covariance V is never formed: V times a few vectors is one Spark job over blocks of the fit list, which centres each block
before it multiplies and adds up in the shuffle. The method keeps a small subspace on the driver (SUBSPACE
vectors at most, each as long as an embedding). Rayleigh-Ritz on it gives the approximations; for those that have
not converged, the projected correction equation (I - QQ')(V - eI)(I - QQ')t = -r is solved by a few steps of MINRES,
all at once, so that a step of all is one job; the corrections widen the subspace. Pairs are locked in falling order of
their eigenvalue as soon as their residual is rounding error, and the loop ends when all wanted ones are locked.

Defined cases: see ``whole_vectors`` for null and non-finite vectors; repeated rows count once in the fit and each
gets its rows; null vec_ids stay; with fewer than 4 components of positive variance (few dimensions, few different vectors) there
are only these; a single different vector, or an empty table, gives no rows; extra columns are ignored. Where a deviation
exceeds 64 bits the job ends with an OverflowError.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerlens.llm.common import stored
from markerlens.llm.whole_vectors import grid, whole_rows, width_of

SCALE = 256
COMPONENTS = 4
#: Most vectors of the subspace, and how many stay when it is full.
SUBSPACE, KEPT = 24, 10
MINRES_STEPS = 8
MOST_ROUNDS = 200
#: Rows of a block of the fit list.
BLOCK_ROWS = 4096
EPS = float(np.finfo(float).eps)


def packed(fit: DataFrame, width: int) -> DataFrame:
    """The different vectors in blocks of bytes, with their number and sums."""

    def pack(batches):
        for batch in batches:
            x = grid(batch.column("x"), width)
            for p in range(0, len(x), BLOCK_ROWS):
                part = x[p: p + BLOCK_ROWS]
                yield pa.RecordBatch.from_arrays([pa.array([part.astype("<i4").tobytes()]), pa.array([len(part)], pa.int64()),
                                                  pa.array([part.sum(0).tolist()], pa.list_(pa.int64()))], names=["block", "n", "sums"])

    return stored(fit.mapInArrow(pack, "block binary, n long, sums array<long>"), "fit")


def summed(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], width: int, shape: tuple[int, ...]) -> np.ndarray:
    """Sum over all blocks of ``part(x)``, an array of a fixed shape, added up by Spark."""

    def emit(batches):
        total = np.zeros(shape)
        for batch in batches:
            for block in batch.column("block"):
                total += part(np.frombuffer(block.as_py(), "<i4").reshape(-1, width).astype(float))
        flat = total.reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["at", "v"])

    rows = blocks.select("block").mapInArrow(emit, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(int(np.prod(shape)))
    for r in rows:
        out[r["at"]] = r["v"]
    return out.reshape(shape)


def covariance_product(blocks: DataFrame, width: int, n: int, mean: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """v (width x any) -> V v, by one pass over the blocks."""

    def product(v: np.ndarray) -> np.ndarray:
        def part(x):
            c = x - mean
            return c.T @ (c @ v)

        return summed(blocks, part, width, v.shape) / n

    return product


def projected_out(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - q @ (q.T @ v)
    return v


def minres(product, shifts: np.ndarray, spaces: list[np.ndarray], rhs: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of (I - Q_i Q_i')(V - s_i I)(I - Q_i Q_i') t_i = rhs_i, all columns step by step together."""
    d, b = rhs.shape
    project = lambda v: np.column_stack([projected_out(spaces[i], v[:, i: i + 1]) for i in range(b)])
    v_old, w_old, w = np.zeros((d, b)), np.zeros((d, b)), np.zeros((d, b))
    v = project(rhs)
    beta = np.linalg.norm(v, axis=0)
    eta, first = beta.copy(), beta.copy()
    c_old, c = np.ones(b), np.ones(b)
    s_old, s = np.zeros(b), np.zeros(b)
    t = np.zeros((d, b))
    alive = beta > 0
    v = np.where(alive, v / np.where(alive, beta, 1), 0)
    for _ in range(steps):
        if not alive.any():
            break
        p = project(product(v) - v * shifts)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta * v_old
        beta_new = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        r1 = np.hypot(delta, beta_new)
        r2 = s * alpha + c_old * c * beta
        r3 = s_old * beta
        ok = alive & (r1 > 0)
        safe = np.where(ok, r1, 1)
        c_old, s_old = c, s
        c, s = np.where(ok, delta / safe, c), np.where(ok, beta_new / safe, s)
        w_new = (v - r3 * w_old - r2 * w) / safe
        t = t + np.where(ok, c * eta * w_new, 0)
        eta = np.where(ok, -s * eta, 0)
        w_old, w = w, w_new
        alive = ok & (beta_new > 1e-14 * np.abs(shifts)) & (np.abs(eta) > 1e-10 * first)
        v_old, v = v, np.where(alive, p / np.where(alive, beta_new, 1), 0)
        beta = np.where(alive, beta_new, 0)
    return t


def orthonormal(basis: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The directions of ``new`` outside the basis, orthonormal."""
    out = basis
    for i in range(new.shape[1]):
        v = new[:, i: i + 1]
        size = np.linalg.norm(v)
        if not np.isfinite(size) or size == 0 or out.shape[1] == len(basis):
            continue
        v = projected_out(out, v / size)
        left = np.linalg.norm(v)
        if left > 1e-10:
            out = np.column_stack([out, projected_out(out, v / left)])
            out[:, -1] /= np.linalg.norm(out[:, -1])
    return out[:, basis.shape[1]:]


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], width: int, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors (columns), to rounding error."""
    wanted = min(wanted, width)
    rng = np.random.default_rng(0)
    basis = orthonormal(np.zeros((width, 0)), rng.standard_normal((width, min(width, wanted + 4))))
    image = product(basis)
    locked, values = np.zeros((width, 0)), []
    for _ in range(MOST_ROUNDS):
        small = basis.T @ image
        theta, s = np.linalg.eigh((small + small.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        ritz, moved = basis @ s, image @ s
        residual = moved - ritz * theta
        scale = max([*values, abs(theta[0]) if len(theta) else 0.0])
        close = np.linalg.norm(residual, axis=0) <= 64 * EPS * scale * max(1.0, np.sqrt(width) / 8)
        done = 0
        while done < len(theta) and len(values) < wanted and close[done]:  # in falling order only
            locked = np.column_stack([locked, ritz[:, done]])
            values.append(float(theta[done]))
            done += 1
        if len(values) == wanted:
            break
        basis, image, theta, residual = ritz[:, done:], moved[:, done:], theta[done:], residual[:, done:]
        if basis.shape[1] > SUBSPACE - wanted:
            basis, image = basis[:, :KEPT], product(basis[:, :KEPT])  # afresh, without gathered rounding
        todo = range(min(wanted - len(values), basis.shape[1]))
        spaces = [np.column_stack([locked, basis[:, i]]) for i in todo]
        t = minres(product, theta[: len(spaces)], spaces, -residual[:, : len(spaces)], MINRES_STEPS)
        new = orthonormal(np.column_stack([locked, basis]), np.column_stack([t, residual[:, : len(spaces)]]))[:, : len(spaces)]
        if not new.shape[1]:  # the corrections are in the subspace: a fresh direction, or a subspace that is the whole space
            new = orthonormal(np.column_stack([locked, basis]), rng.standard_normal((width, 1)))
        if new.shape[1]:
            basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
        else:
            image = product(basis)
    else:
        raise ArithmeticError(f"{wanted - len(values)} eigenpairs have not converged in {MOST_ROUNDS} rounds")
    order = np.argsort(values)[::-1]
    return np.array(values)[order], locked[:, order]


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """For each row of ``vectors`` (vec_id, embedding) and component, from 1 by falling variance: vec_id, component, n (different
    vectors), deviation (exact sum over dimensions of (n * x - sum)^2), whitened (the centred x on the component, over the root of its variance), explained
    (share of the variance), identity_error (largest entry of the whitened fit list's covariance minus the identity)."""
    rows = whole_rows(vectors, SCALE)
    spark = rows.sparkSession
    width = width_of(rows)
    none = spark.createDataFrame([], WHITENED)
    if not width:
        return none
    fit = packed(rows.select("x").distinct(), width).persist(StorageLevel.MEMORY_AND_DISK)  # a lost part is read again
    try:
        n = fit.agg(F.sum("n")).first()[0]
        by_place = fit.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
        sums = np.array([r["s"] for r in sorted(by_place)], np.int64)
        mean = sums / n
        spread = summed(fit, lambda x: ((x - mean) ** 2).sum(0), width, (width,)).sum() / n
        if spread <= 0:
            return none
        product = covariance_product(fit, width, n, mean)
        values, vectors_ = jacobi_davidson(product, width, components)
        real = values > 64 * EPS * width * values[0]
        values, vectors_ = values[real], vectors_[:, real]
        vectors_ = vectors_ * np.where(vectors_[np.abs(vectors_).argmax(0), np.arange(len(values))] < 0, -1, 1)
        turned = vectors_ / np.sqrt(values)

        def moments(x):
            w = (x - mean) @ turned
            return np.vstack([w.T @ w, w.sum(0)])

        m = summed(fit, moments, width, (len(values) + 1, len(values))) / n
        error = float(np.abs(m[:-1] - np.outer(m[-1], m[-1]) - np.eye(len(values))).max())
    finally:
        fit.unpersist()
    k, share = len(values), values / spread

    def project(batches):
        for batch in batches:
            x = grid(batch.column("x"), width)
            far = x * n - sums
            if len(x) and width * float(np.abs(far).max()) ** 2 >= 2.0 ** 63:
                raise OverflowError("a deviation exceeds 64 bits")
            deviation = (far * far).sum(1)
            white = (x - mean) @ turned
            rep = lambda v: pa.array(np.repeat(v, k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 rep(np.full(len(x), n, np.int64)), rep(deviation), pa.array(white.reshape(-1)), pa.array(np.tile(share, len(x))),
                 rep(np.full(len(x), error))], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, WHITENED)
