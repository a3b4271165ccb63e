"""Whitening of embeddings by a Jacobi-Davidson solver whose matrix is never formed.

The covariance of the distinct vectors is only ever applied: a pass over the packed vectors, in Spark, centres each vector and sums
its part of ``V u`` for a block of directions u. The driver holds a search space of a few dozen directions: Rayleigh-Ritz
in that space gives approximate components, converged ones are locked, and for each of the others the projected
correction equation is solved by a few steps of MINRES, all of them with one pass a step. It ends when every residual is at double precision.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored, table
from .negatives import usable, whole_numbers

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
ROWS = 2048  # vectors of a packed block
GUARD = 8  # directions beyond the wanted ones
INNER = 5  # MINRES steps for a correction
TOLERANCE = 1e-13  # residual, as a share of the largest eigenvalue
_LONG = 2**63 - 1


def packed(vectors: DataFrame) -> DataFrame:
    """Whole-number vectors of one length (column x) as blocks of 64-bit words."""

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                values = np.asarray(batch["x"].slice(at, ROWS).flatten(), dtype="<i8")
                yield pa.RecordBatch.from_arrays([pa.array([values.tobytes()], pa.binary())], names=["block"])

    return vectors.select("x").mapInArrow(pack, "block binary")


def gathered(blocks: DataFrame, work, shape: tuple[int, ...], dtype="<f8") -> np.ndarray:
    """The sum over all blocks of ``work(block)``; tasks add up their own, and the driver meets 64 parts, or the root of the tasks, at most."""

    def run(batches):
        total = np.zeros(shape, dtype=dtype)
        for batch in batches:
            for block in batch["block"]:
                total += work(np.frombuffer(block.as_buffer(), dtype="<i8"))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def merge(batches):
        total = np.zeros(shape, dtype=dtype)
        for batch in batches:
            for part in batch["part"]:
                total += np.frombuffer(part.as_buffer(), dtype=dtype).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts, tasks = blocks.mapInArrow(run, "part binary"), blocks.rdd.getNumPartitions()
    if tasks > 64:
        parts = parts.repartition(int(np.ceil(np.sqrt(tasks)))).mapInArrow(merge, "part binary")
    out = np.zeros(shape, dtype=dtype)
    for row in parts.collect():
        out += np.frombuffer(row["part"], dtype=dtype).reshape(shape)
    return out


class Centre:
    """Count n and exact sums of the vectors; the mean of a dimension is whole + part / n, so that centring loses nothing to a large mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.part = np.array([s % n for s in sums], dtype=np.int64)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        return (values.reshape(-1, len(self.whole)) - self.whole).astype(np.float64) - self.part / self.n

    def deviations(self, values: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2 by row; null beyond a long."""
        away = values.reshape(-1, len(self.whole)) - self.whole
        most = (int(np.abs(away).max(initial=0)) + 1) * self.n
        if most**2 * len(self.whole) <= _LONG:
            return ((away * self.n - self.part) ** 2).sum(1).tolist()
        exact = ((away.astype(object) * self.n - self.part.astype(object)) ** 2).sum(1)
        return [x if x <= _LONG else None for x in exact]


def centre_of(blocks: DataFrame, n: int, size: int) -> Centre:
    """Exact sums: high and low halves of the words are added up apart."""

    def halves(values):
        values = values.reshape(-1, size)
        return np.stack([(values >> 32).sum(0), (values & 0xFFFFFFFF).sum(0)])

    high, low = gathered(blocks, halves, (2, size), "<i8").tolist()
    return Centre(n, [(h << 32) + x for h, x in zip(high, low, strict=True)])


def minres(apply, right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of symmetric systems, one per column of ``right``; every step applies the operators to one block."""
    safe = lambda a, b: np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=b > 1e-300)
    beta = np.linalg.norm(right, axis=0)
    v, v_old, w, w_old, out = safe(right, beta), 0.0, np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    eta, c, c_old = beta, np.ones_like(beta), np.ones_like(beta)
    s, s_old = np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta * v_old
        after = np.linalg.norm(p, axis=0)
        turn, two, three = c * alpha - c_old * s * beta, s * alpha + c_old * c * beta, s_old * beta
        one = np.hypot(turn, after)
        c_old, s_old, c, s = c, s, safe(turn, one), safe(after, one)
        w, w_old = safe(v - three * w_old - two * w, one), w
        out = out + c * eta * w
        eta = -s * eta
        v, v_old, beta = safe(p, after), v, after
    return out


def _fresh(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``new`` beyond what the bases span."""
    new = new / np.maximum(np.linalg.norm(new, axis=0), 1e-300)
    for _ in range(2):
        for base in bases:
            new = new - base @ (base.T @ new)
    left, values, _ = np.linalg.svd(new, full_matrices=False)
    left = left[:, values > 1e-10]
    for base in bases:
        left = left - base @ (base.T @ left)
    return np.linalg.qr(left)[0]


def jacobi_davidson(product, size: int, count: int, inner: int = INNER, tolerance: float = TOLERANCE, seed: int = 1, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, with unit eigenvectors (columns) of the symmetric positive semidefinite operator ``product``.

    ``product`` maps a block of columns. Pairs are locked from the top, once their residual is at most ``tolerance`` times the largest
    eigenvalue; a search space that is the whole space gives them at the rounding of the products.
    """
    count = min(count, size)
    keep = min(size, count + GUARD)
    space = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, keep)))[0]
    image = product(space)
    locked, values, largest = np.zeros((size, 0)), [], 0.0
    for _ in range(rounds):
        small = space.T @ image
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        largest = max(largest, float(ritz[0]))
        residual = image - space * ritz
        small_enough = np.linalg.norm(residual, axis=0) <= tolerance * largest
        if locked.shape[1] + space.shape[1] == size:
            small_enough[:] = True
        done = 0
        while done < len(ritz) and len(values) + done < count and small_enough[done]:
            done += 1
        values += ritz[:done].tolist()
        locked = np.hstack([locked, space[:, :done]])
        space, image, residual, ritz = space[:, done:], image[:, done:], residual[:, done:], ritz[done:]
        if len(values) == count:
            order = np.argsort(-np.array(values), kind="stable")
            return np.array(values)[order], locked[:, order]
        if space.shape[1] > 4 * count + 2 * GUARD:
            space, image, residual, ritz = space[:, :keep], image[:, :keep], residual[:, :keep], ritz[:keep]
        open_ = min(count - len(values), space.shape[1])
        u, theta = space[:, :open_], ritz[:open_]

        def project(t, u=u, locked=locked):
            t = t - locked @ (locked.T @ t)
            return t - u * (u * t).sum(0)

        def correction(t, project=project, theta=theta):
            t = project(t)
            return project(product(t) - t * theta)

        steps = minres(correction, -project(residual[:, :open_]), inner)
        fresh = _fresh(project(steps), locked, space)
        if not fresh.shape[1]:  # nothing new from the corrections: a random direction goes on
            fresh = _fresh(np.random.default_rng(seed + space.shape[1]).normal(size=(size, 1)), locked, space)
        space, image = np.hstack([space, fresh]), np.hstack([image, product(fresh)])
    raise RuntimeError("residuals did not reach double precision")


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _family(rows: DataFrame, size: int, components: int) -> DataFrame:
    """Whitened rows (vec_id, x) of one vector length."""
    distinct = rows.select("x").distinct()
    blocks = stored(packed(distinct))
    n = int(gathered(blocks, lambda values: np.array([len(values) // size]), (1,), "<i8")[0])
    centre = centre_of(blocks, n, size)

    def apply(values, u):
        y = centre(values)
        return y.T @ (y @ u)

    product = lambda u: gathered(blocks, partial(apply, u=u), u.shape) / n
    trace = float(gathered(blocks, lambda values: np.array([np.square(centre(values)).sum()]), (1,))[0]) / n
    values, vectors = jacobi_davidson(product, size, components) if trace > 0 else (np.zeros(0), np.zeros((size, 0)))
    real = values > 1e-13 * max(values, default=0.0) * size  # a direction without spread cannot be whitened
    values, vectors = values[real], vectors[:, real]
    scaled = vectors / np.sqrt(values)
    count = len(values)

    def moments(block):
        w = centre(block) @ scaled
        return np.vstack([w.sum(0), w.T @ w])

    sums = gathered(blocks, moments, (count + 1, count)) / n if count else np.zeros((1, 0))
    error = float(np.abs(sums[1:] - np.outer(sums[0], sums[0]) - np.eye(count)).max(initial=0.0))
    discard(blocks)
    explained = values / trace if count else values

    def whitened(batches):
        for batch in batches:
            x = np.asarray(batch["x"].flatten(), dtype=np.int64)
            k = batch.num_rows
            if not count or not k:
                continue
            columns = [
                pa.array(np.repeat(batch["vec_id"].to_numpy(zero_copy_only=False), count), pa.int64(), from_pandas=True), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), k)),
                pa.array(np.full(k * count, n), pa.int64()), pa.array([d for d in centre.deviations(x) for _ in range(count)], pa.int64()),
                pa.array((centre(x) @ scaled).ravel()), pa.array(np.tile(explained, k)), pa.array(np.full(k * count, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(whitened, _OUT)


def whiten(df: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every row and component up to ``components``.

    Entries become x = floor(scale * c) + offset. Mean and covariance (divisor n) are those of the distinct x vectors; components are numbered by
    falling eigenvalue, and a row's projection is divided by the root of it. ``deviation`` is exact, null beyond a long.

    Rows whose vector is null or holds a null or non-finite entry are dropped. A null vec_id stays null; repeated rows give their rows each.
    Vectors of different length are families of their own, each with its own n and components; empty vectors have no components. Directions
    without spread (one distinct vector, fewer vectors than dimensions) cannot be whitened and give no rows. Equal eigenvalues: any orthonormal
    directions of their space. Other columns are left out, so their names cannot clash. An empty table gives an empty result.
    """
    vector = F.col("embedding").cast("array<double>")
    numbers = F.transform(whole_numbers(vector, scale), lambda x: x + F.lit(offset).cast("long"))
    rows = stored(df.where(usable(vector)).select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("x")).withColumn("size", F.size("x")))
    sizes = sorted(r["size"] for r in rows.groupBy("size").count().collect() if r["size"])
    out = [_family(rows.where(F.col("size") == size).select("vec_id", "x"), size, components) for size in sizes]
    if not out:
        return rows.sparkSession.createDataFrame([], _OUT)
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def op12(spark, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))
