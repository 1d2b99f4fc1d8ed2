"""Whitening of embeddings: leading eigenvectors by a block Jacobi-Davidson method.

The covariance is never formed. A product with it is one Spark job: each task
multiplies its centred vectors with the block and with the result again, and the
partial sums, as many numbers as the block has, are added up by Spark. The driver
holds a search space of a few dozen vectors, whatever the number of rows:

* Rayleigh-Ritz on the search space gives approximate pairs and residuals;
* pairs whose residual has reached double precision are locked;
* for each of the others the correction equation, projected off the leading Ritz
  vectors, is solved by a few steps of MINRES; all of them advance in step, so
  that a step costs one job for the whole block;
* the corrections widen the search space, which restarts from its best vectors
  when it becomes too wide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from layerwell.llm.common import batch_of, columns, in_batches
from layerwell.sinks.parquet import stage

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
SPARE = 4  # vectors of the search space beyond the wanted ones after a restart
INNER_STEPS = 8  # of MINRES, at most
INNER_GAIN = 0.01
MOST_ROUNDS = 200
SEED = 13
LARGEST = 2.0**40  # scaled entries beyond count as this
NO_VARIANCE = 1e-10  # of the largest eigenvalue: below, a component has no variance

Product = Callable[[np.ndarray], np.ndarray]


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and x, the scaled and shifted entries as long, of the vectors that
    are neither null nor empty nor hold null or non-finite entries. If lengths
    differ, only vectors of the most frequent length are kept (of equally
    frequent ones, the longest)."""
    entry = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = columns(embeddings, "vec_id", "embedding").select("vec_id", entry.alias("v"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(finite)
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    scaled = lambda c: F.floor(F.least(F.greatest(SCALE * c, F.lit(-LARGEST)), F.lit(LARGEST))) + F.lit(SHIFT)
    return rows.where(F.size("v") == (most["d"] if most else 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("v", scaled).alias("x")
    )


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


def _summed(fit: DataFrame, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` (a vector of numbers) over all batches of ``fit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = part(_matrix(batch))
                total = made if total is None else total + made
        if total is not None:
            yield batch_of(["at", "value"], [np.arange(len(total)), total], [pa.int64(), pa.float64()])

    parts = in_batches(fit.select("x"), run, "at long, value double")
    rows = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(rows))
    for row in rows:
        out[row["at"]] = row["value"]
    return out


def exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors, and the sum of every entry, as exact integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sums = _matrix(batch).sum(axis=0)
                yield batch_of(
                    ["at", "value"],
                    [np.arange(-1, len(sums)), np.concatenate([[batch.num_rows], sums])], [pa.int64()] * 2,
                )

    parts = in_batches(fit.select("x"), run, "at long, value long")
    rows = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    sums = {row["at"]: int(row["value"]) for row in rows}
    return sums.pop(-1, 0), [sums[i] for i in range(len(sums))]


def differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: as long where that is wide enough, else as Python integers."""
    largest = max(int(np.abs(x).max(initial=0)) * n, *map(abs, sums))
    exact = np.int64 if largest < 2**62 else object
    return x.astype(exact) * n - np.array(sums, exact)


def deviations(d: np.ndarray) -> pa.Array:
    """Row sums of the squares of ``d``, exact, as decimal(38,0); null beyond it."""
    largest = int(np.abs(d).max(initial=0))
    if d.dtype != object and largest * largest * d.shape[1] < 2**63:
        return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
    exact = [sum(int(v) ** 2 for v in row) for row in d]
    return pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))


def covariance_product(fit: DataFrame, n: int, sums: list[int]) -> Product:
    """Products of the covariance with blocks of vectors, one job each."""

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            centred = differences(x, n, sums).astype(float) / n
            return (centred.T @ (centred @ block)).ravel()

        return _summed(fit, part).reshape(block.shape) / n

    return product


def minres(product: Product, shifts: np.ndarray, right: np.ndarray, project: Callable[[np.ndarray], np.ndarray],
           steps: int = INNER_STEPS, gain: float = INNER_GAIN) -> np.ndarray:
    """Column by column, an approximate solution t of P (A - shift) P t = right,
    with one product of A per step for all columns."""
    zero = np.zeros_like(right)
    x, v_before, w_before, w = zero.copy(), zero, zero, zero
    v = project(right)
    norm = np.linalg.norm(v, axis=0)
    start, eta = norm.copy(), norm.copy()
    c_before, c, s_before, s = (np.full(len(norm), k) for k in (1.0, 1.0, 0.0, 0.0))
    for _ in range(steps):
        active = (norm > 0) & (np.abs(eta) > gain * start)
        if not active.any():
            break
        scale = np.where(norm > 0, norm, 1)
        v = v / scale
        image = project(product(v) - v * shifts)
        delta = (image * v).sum(axis=0)
        v_next = image - delta * v - norm * v_before
        norm_next = np.linalg.norm(v_next, axis=0)
        a0 = c * delta - c_before * s * norm
        a1 = np.hypot(a0, norm_next)
        a2 = s * delta + c_before * c * norm
        a3 = s_before * norm
        active &= a1 > 0
        a1 = np.where(a1 > 0, a1, 1)
        c_before, c, s_before, s = c, a0 / a1, s, norm_next / a1
        w_before, w = w, (v - a3 * w_before - a2 * w) / a1
        x = np.where(active, x + c * eta * w, x)
        eta = np.where(active, -s * eta, 0)
        v_before, v = np.where(active, v, 0), np.where(active, v_next, 0)
        norm = np.where(active, norm_next, 0)
    return x


def _joined_to(basis: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``block`` that ``basis`` does not hold yet."""
    made = np.empty((len(basis), 0))
    for column in block.T:
        size = np.linalg.norm(column)
        for _ in range(3):
            column = column - basis @ (basis.T @ column) - made @ (made.T @ column)
        left = np.linalg.norm(column)
        if size > 0 and left > 1e-10 * size and basis.shape[1] + made.shape[1] < len(basis):
            column = column / left
            column = column - basis @ (basis.T @ column) - made @ (made.T @ column)
            made = np.column_stack([made, column / np.linalg.norm(column)])
    return made


def leading_pairs(product: Product, d: int, k: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors, of a
    symmetric matrix of order ``d`` that is known by its products only. Ends when
    all residuals are below d times the machine precision of the largest
    eigenvalue, or as near to it as rounding in the products allows."""
    random = np.random.default_rng(seed)
    kept = min(d, k + SPARE)
    widest = max(4 * kept, kept + 2 * k)
    basis = np.linalg.qr(random.standard_normal((d, kept)))[0]
    image = product(basis)
    best, idle = np.inf, 0
    for _ in range(MOST_ROUNDS):
        small = basis.T @ image
        values, mix = np.linalg.eigh((small + small.T) / 2)
        values, mix = values[::-1], mix[:, ::-1]
        ritz, ritz_image = basis @ mix, image @ mix
        residual = ritz_image[:, :k] - ritz[:, :k] * values[:k]
        sizes = np.linalg.norm(residual, axis=0)
        limit = d * np.finfo(float).eps * max(abs(values[0]), np.finfo(float).tiny)
        locked = sizes <= limit
        idle = 0 if sizes.max() < best / 2 else idle + 1
        best = min(best, sizes.max())
        if locked.all() or (idle >= 3 and best <= 1000 * limit):
            return values[:k], ritz[:, :k]
        if basis.shape[1] == d:
            # The whole space: only rounding is left, and new products settle it.
            basis, image = np.linalg.qr(ritz)[0], None
            image = product(basis)
            continue
        leading = ritz[:, :k]
        off = lambda block: block - leading @ (leading.T @ block)  # noqa: B023,E731
        wanted = minres(product, values[:k][~locked], -residual[:, ~locked], off)
        if basis.shape[1] + wanted.shape[1] > widest:
            basis, image = ritz[:, :kept], ritz_image[:, :kept]
        fresh = _joined_to(basis, wanted)
        if not fresh.shape[1]:
            fresh = _joined_to(basis, random.standard_normal((d, 1)))
        basis = np.column_stack([basis, fresh])
        image = np.column_stack([image, product(fresh)])
    raise ArithmeticError(f"eigenvectors have not converged: largest residual {best:.3g}")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per usable row (see ``integer_vectors``) and component from 1: vec_id,
    component, n (distinct vectors fitted on), deviation (decimal, exact), whitened,
    explained and identity_error.

    Vectors that occur repeatedly are fitted on once, and returned for each row.
    Null and repeated vec_ids are kept. There are as many components as wanted, or
    as there are dimensions, but for those without variance: an empty table, one
    with a single distinct vector, or one without usable vectors gives no rows.
    Equal eigenvalues come in any order. Entries beyond 2^40 when scaled count as
    2^40. Columns other than vec_id and embedding are ignored.
    """
    vectors = integer_vectors(embeddings)
    fit = stage(vectors.select("x").distinct())
    n, sums = exact_sums(fit)
    schema = (
        "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double"
    )
    if n < 2:
        return embeddings.sparkSession.createDataFrame([], schema)
    d = len(sums)

    def spread(x: np.ndarray) -> np.ndarray:
        centred = differences(x, n, sums).astype(float) / n
        return np.array([(centred * centred).sum()])

    trace = _summed(fit, spread)[0] / n
    values, vectors_found = leading_pairs(covariance_product(fit, n, sums), d, min(components, d))
    usable = int((values > NO_VARIANCE * max(values[0], 0)).sum()) if values[0] > 0 else 0
    values, axes = values[:usable], vectors_found[:, :usable]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(usable)] < 0, -1.0, 1.0)
    whitening = axes / np.sqrt(values)

    def projected(x: np.ndarray) -> np.ndarray:
        return differences(x, n, sums).astype(float) / n @ whitening

    mean = _summed(fit, lambda x: projected(x).sum(axis=0)) / n

    def second_moments(x: np.ndarray) -> np.ndarray:
        centred = projected(x) - mean
        return (centred.T @ centred).ravel()

    covariance = _summed(fit, second_moments).reshape(usable, usable) / n
    identity_error = float(np.abs(covariance - np.eye(usable)).max(initial=0))
    explained = values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            repeat = np.repeat(np.arange(rows), usable)
            d_rows = differences(_matrix(batch), n, sums)
            yield batch_of(
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                [
                    batch.column("vec_id").take(pa.array(repeat)),
                    np.tile(np.arange(1, usable + 1), rows), np.full(len(repeat), n),
                    deviations(d_rows).take(pa.array(repeat)),
                    (d_rows.astype(float) / n @ whitening).ravel(),
                    np.tile(explained, rows), np.full(len(repeat), identity_error),
                ],
                [None, pa.int32(), pa.int64(), None, pa.float64(), pa.float64(), pa.float64()],
            )

    return in_batches(vectors, run, schema)
