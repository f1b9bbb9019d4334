"""Operator 11: whitening of embeddings along their leading principal components.

The covariance is never formed. The driver holds a few vectors of the embeddings'
dimension; every product of the covariance with a block of them is one Spark job over the
distinct vectors, whose tasks centre their rows, multiply, and send one partial sum each
to be added up by place. The leading eigenvectors come from a block Jacobi-Davidson
iteration: Rayleigh-Ritz in a growing subspace, corrections of the unconverged vectors
from projected equations that MINRES solves side by side (one product a step for all of
them), and locking in order once a residual is as small as double precision allows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import free_names, lean, materialise

COMPONENTS = 4
# Entries become whole numbers of this fraction.
STEPS = 256
# Larger numbers are not exact in a double, and count as not finite.
MOST = float(1 << 53)

Product = Callable[[np.ndarray], np.ndarray]

# -- eigenvectors -------------------------------------------------------------------------------


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """The block made orthonormal and orthogonal to the others, less what depends on them."""
    kept: list[np.ndarray] = []
    for column in block.T:
        norm = np.linalg.norm(column)
        if not norm > 0:
            continue
        column = column / norm
        for _ in range(3):
            for other in (*against, *((np.stack(kept, 1),) if kept else ())):
                column = column - other @ (other.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-12:
                break
            column = column / left
        else:
            kept.append(column)
    return np.stack(kept, 1) if kept else np.zeros((len(block), 0))


def _minres(
    product: Product, shifts: np.ndarray, right: np.ndarray, fixed: np.ndarray, steps: int, tolerance: float
) -> np.ndarray:
    """Solutions of P (A - shift) P x = right, a column each, P projecting `fixed` away.

    Each step costs one product with as many columns as are not solved yet.
    """

    def project(block: np.ndarray) -> np.ndarray:
        return block - fixed @ (fixed.T @ block)

    found = np.zeros_like(right)
    now = project(right)
    beta = np.linalg.norm(now, axis=0)
    goal = tolerance * beta
    open_ = np.flatnonzero(beta > 0)
    now = now[:, open_] / beta[open_]
    before = np.zeros_like(now)
    beta, eta = beta[open_], beta[open_].copy()
    c_now = c_before = np.ones(len(open_))
    s_now = s_before = np.zeros(len(open_))
    w_now, w_before = np.zeros_like(now), np.zeros_like(now)
    for _ in range(steps):
        if not len(open_):
            break
        ahead = project(product(now) - now * shifts[open_])
        alpha = np.sum(now * ahead, axis=0)
        ahead = project(ahead - now * alpha - before * beta)
        beta_ahead = np.linalg.norm(ahead, axis=0)
        delta = c_now * alpha - c_before * s_now * beta
        rho = np.maximum(np.hypot(delta, beta_ahead), np.finfo(float).tiny)
        above = s_now * alpha + c_before * c_now * beta
        c_before, s_before, c_now, s_now, far = c_now, s_now, delta / rho, beta_ahead / rho, s_before * beta
        w_before, w_now = w_now, (now - w_before * far - w_now * above) / rho
        found[:, open_] += w_now * (c_now * eta)
        eta = -s_now * eta
        going = (np.abs(eta) > goal[open_]) & (beta_ahead > 1e-14 * np.maximum(np.abs(alpha), 1e-300))
        before, now = now[:, going], ahead[:, going] / np.maximum(beta_ahead[going], 1e-300)
        w_before, w_now, beta, eta = w_before[:, going], w_now[:, going], beta_ahead[going], eta[going]
        c_before, s_before, c_now, s_now = (a[going] for a in (c_before, s_before, c_now, s_now))
        open_ = open_[going]
    return found


def jacobi_davidson(
    product: Product, dimension: int, count: int, *, inner: int = 5, most: int = 48, seed: int = 11
) -> tuple[np.ndarray, np.ndarray]:
    """The greatest `count` eigenvalues of a symmetric positive operator, falling, and their
    unit eigenvectors as columns, each with its largest entry positive.

    Runs until every residual is at the rounding error of a product, or no longer falls
    and is below 1e-12 of the greatest eigenvalue; raises if that is not reached.
    """
    count = min(count, dimension)
    most = max(most, 4 * count)
    draws = np.random.default_rng(seed)
    locked, values = np.zeros((dimension, 0)), np.zeros(0)
    basis = _orthonormal(draws.standard_normal((dimension, min(2 * count, dimension))))
    images = product(basis)
    rounding = 4 * np.finfo(float).eps
    best, stale = math.inf, 0
    for _ in range(64 + 4 * dimension):
        wanted = count - len(values)
        small = basis.T @ images
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        front, theta = basis[:, :wanted], ritz[:wanted]
        residual = images[:, :wanted] - front * theta
        residual -= locked @ (locked.T @ residual)
        sizes = np.linalg.norm(residual, axis=0)
        scale = max(float(ritz[0]), float(values.max(initial=0.0)), np.finfo(float).tiny)
        worst = float(sizes.max())
        best, stale = (worst, 0) if worst < best / 2 else (best, stale + 1)
        full = locked.shape[1] + basis.shape[1] == dimension
        bar = scale * (1e-12 if stale >= 3 or full else rounding * math.sqrt(dimension))
        done = 0
        while done < wanted and sizes[done] <= bar:
            done += 1
        if done:
            locked = np.concatenate([locked, front[:, :done]], axis=1)
            values = np.concatenate([values, theta[:done]])
            basis, images = basis[:, done:], images[:, done:]
            images = images - locked @ (locked.T @ images)
            best, stale = math.inf, 0
            if len(values) == count:
                order = np.argsort(-values, kind="stable")
                values, locked = values[order], locked[:, order]
                signs = np.sign(locked[np.abs(locked).argmax(axis=0), np.arange(count)])
                return np.maximum(values, 0.0), locked * signs
            front, theta, residual = front[:, done:], theta[done:], residual[:, done:]
        if basis.shape[1] + len(theta) > most:
            keep = max(2 * count, most // 3)
            basis, images = basis[:, :keep], images[:, :keep]
        fixed = np.concatenate([locked, front], axis=1)
        fixed = _orthonormal(fixed)
        ahead = _minres(product, theta, -residual, fixed, inner, 0.01)
        ahead = _orthonormal(ahead, locked, basis)
        if not ahead.shape[1] and not full:
            ahead = _orthonormal(draws.standard_normal((dimension, 1)), locked, basis)
        if ahead.shape[1]:
            added = product(ahead)
            basis = np.concatenate([basis, ahead], axis=1)
            images = np.concatenate([images, added - locked @ (locked.T @ added)], axis=1)
        else:
            basis = _orthonormal(basis, locked)
            images = product(basis)
    raise RuntimeError(f"residual {best:.3g} after all rounds, eigenvalue {scale:.3g}")


# -- jobs over the vectors ----------------------------------------------------------------------

# Entries turned into doubles at a time.
_BLOCK_ENTRIES = 1 << 20


def _blocks(column: pa.ListArray, dimension: int) -> Iterator[np.ndarray]:
    """The whole-number vectors of a column, some rows at a time."""
    rows = max(1, _BLOCK_ENTRIES // max(dimension, 1))
    for low in range(0, len(column), rows):
        part = column.slice(low, rows)
        yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), dimension)


def _summed(
    vectors: DataFrame, dimension: int, partial: Callable[[np.ndarray], np.ndarray], kind: str = "double"
) -> np.ndarray:
    """Sum of `partial(block)` over blocks of the vectors, as a flat array.

    Each task adds up its own blocks and sends one row per place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in _blocks(batch.column(0), dimension):
                part = partial(block)
                total = part if total is None else total + part
        if total is not None:
            flat = np.ravel(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["place", "value"]
            )

    parts = vectors.select("x").mapInArrow(lean(run), f"place int, value {kind}")
    rows = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    return np.array([r.value for r in sorted(rows)])


def whole_vector(vector: Column) -> Column:
    """Each entry as `floor(256 entry)`; null where the vector or an entry is null, or an entry
    is not finite or too large for that number to be exact."""

    def unfit(entry: Column) -> Column:
        size = F.abs(entry.cast("double") * STEPS)
        return entry.isNull() | F.isnan(size) | (size >= MOST)

    steps = F.transform(vector, lambda c: F.floor(c.cast("double") * STEPS).cast("long"))
    return F.when(vector.isNotNull() & ~F.exists(vector, unfit), steps)


class Whitening(NamedTuple):
    """What is learnt from the distinct vectors; all of it as large as the dimension."""

    dimension: int
    n: int
    sums: list[int]
    mean: np.ndarray
    vectors: np.ndarray  # a component per column
    values: np.ndarray  # variances, falling
    trace: float
    identity_error: float | None

    @property
    def scales(self) -> np.ndarray:
        """What a projection is multiplied by; NaN for a component without variance."""
        least = self.trace * max(self.dimension, 1) * np.finfo(float).eps
        with np.errstate(divide="ignore"):
            return np.where(self.values > least, 1 / np.sqrt(self.values), np.nan)

    @property
    def explained(self) -> list[float | None]:
        """Each component's share of all variance; None where there is none at all."""
        return [float(v / self.trace) if self.trace > 0 else None for v in self.values]


def fit(rows: DataFrame, *, column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Mean, leading components and their variances over the distinct whole-number vectors.

    Vectors that `whole_vector` refuses are left out, and of the others those that do not
    have the most common length (of equally common ones the greatest). Without vectors
    there are no components. Of components of equal variance, any basis may come out.
    """
    whole = rows.select(whole_vector(F.col(column)).alias("x")).where(F.col("x").isNotNull())
    sizes = whole.groupBy(F.size("x").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    dimension = common["size"] if common else 0
    if not dimension:
        empty = np.zeros((0, 0))
        return Whitening(0, 0, [], np.zeros(0), empty, np.zeros(0), 0.0, None)
    distinct = materialise(whole.where(F.size("x") == dimension).distinct(), "whitening-vectors")

    # Entries in two halves, so that neither sum leaves the range of a long.
    half = 26

    def sums(block: np.ndarray) -> np.ndarray:
        low, high = block & ((1 << half) - 1), block >> half
        return np.concatenate([[len(block)], low.sum(axis=0), high.sum(axis=0)])

    n, *halves = (int(v) for v in _summed(distinct, dimension, sums, "long"))
    total = [low + (high << half) for low, high in zip(halves[:dimension], halves[dimension:], strict=True)]
    mean = np.array([s / n for s in total])
    trace = float(_summed(distinct, dimension, lambda b: np.array([np.sum((b - mean) ** 2)]))[0] / n)

    def product(block: np.ndarray) -> np.ndarray:
        def partial(rows: np.ndarray) -> np.ndarray:
            centred = rows - mean
            return centred.T @ (centred @ block)

        return _summed(distinct, dimension, partial).reshape(block.shape) / n

    values, vectors = jacobi_davidson(product, dimension, components)
    learnt = Whitening(dimension, n, total, mean, vectors, values, trace, None)
    return learnt._replace(identity_error=_identity_error(distinct, learnt))


def _identity_error(distinct: DataFrame, learnt: Whitening) -> float | None:
    """Largest entry of the whitened vectors' covariance minus the identity."""
    usable = np.isfinite(learnt.scales)
    if not usable.any():
        return None
    mean, turn = learnt.mean, (learnt.vectors * learnt.scales)[:, usable]
    centre = _summed(distinct, learnt.dimension, lambda b: ((b - mean) @ turn).sum(axis=0)) / learnt.n

    def partial(block: np.ndarray) -> np.ndarray:
        white = (block - mean) @ turn - centre
        return white.T @ white

    size = turn.shape[1]
    covariance = _summed(distinct, learnt.dimension, partial).reshape(size, size) / learnt.n
    return float(np.abs(covariance - np.eye(size)).max())


def _deviations(block: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - S)^2 of each row, exactly; None where it does not fit a long."""
    most = n * int(np.abs(block).max(initial=0)) + max(map(abs, sums))
    if most * most * block.shape[1] < 1 << 63:
        return ((n * block - np.array(sums)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in block.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def with_whitened(rows: DataFrame, learnt: Whitening, *, column: str = "embedding") -> DataFrame:
    """Rows with a usable vector, with `deviation` (sum over dimensions of (n x - S)^2, null
    where it does not fit a long) and `whitened`, an array with one number per component
    (null for a component without variance).

    A row whose vector is not usable, or not of the learnt length, is left out; repeated
    rows stay; columns of these two names are replaced.
    """
    dimension, n, sums, mean = learnt.dimension, learnt.n, learnt.sums, learnt.mean
    turn = learnt.vectors * learnt.scales

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            deviation, white = [], [np.zeros((0, turn.shape[1]))]
            for block in _blocks(column, dimension):
                deviation += _deviations(block, n, sums)
                white.append((block - mean) @ turn)
            flat = pa.array(np.concatenate(white).ravel(), pa.float64(), from_pandas=True)
            offsets = pa.array(np.arange(len(column) + 1, dtype=np.int32) * turn.shape[1])
            lists = pa.ListArray.from_arrays(offsets, flat)
            yield pa.StructArray.from_arrays(
                [pa.array(deviation, pa.int64()), lists], ["deviation", "whitened"]
            )

    whiten = F.arrow_udf(lean(run), "struct<deviation:long,whitened:array<double>>")
    x, both = free_names(rows, "whole_vector", "whitened_both")
    kept = rows.withColumn(x, whole_vector(F.col(column))).where(F.size(x) == F.lit(dimension))
    if not dimension:
        kept = kept.limit(0)
    kept = kept.withColumn(both, whiten(F.col(x)))
    found = {"deviation": F.col(f"{both}.deviation"), "whitened": F.col(f"{both}.whitened")}
    return kept.withColumns(found).drop(x, both)
