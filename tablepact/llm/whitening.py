"""Whitening of embeddings: leading eigenpairs of their covariance by Jacobi-Davidson.

The covariance itself is never built. What the method asks for are products with a few
vectors at once; each is one pass over the table, in which every task centres its rows
and sends one partial sum. The driver holds vectors of as many numbers as an embedding
has, never rows.

1. Rayleigh-Ritz: the covariance is projected on a subspace, whose own eigenpairs are
   the best guesses there.
2. Guesses whose residual is at rounding level, from the largest on, are locked and
   taken out of the problem.
3. For the next few guesses the correction equation, projected off the locked vectors
   and the guesses, is solved roughly by MINRES, all of them in step, so that an inner
   step is one pass. The corrections widen the subspace; a full one is cut back to its
   best guesses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

#: Fixed by the query's definition: entries become floor(STEPS * c) + SHIFT.
STEPS, SHIFT = 64, 1_000_000
#: Guesses corrected together, MINRES steps a correction, and rounds before giving up.
BLOCK, INNER, ROUNDS = 16, 4, 500
#: Numbers of vectors looked at together.
PIECE = 1 << 21
_EPS = np.finfo(float).eps

Product = Callable[[np.ndarray], np.ndarray]


def vectors(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows whose vector is neither null nor holds a null or non-finite entry, in pieces, and their entries.

    All vectors of a piece must have one length.
    """
    size = pa.compute.list_value_length(batch.column(batch.schema.get_field_index(column)))
    widest = pa.compute.max(size).as_py() or 0
    step = max(1, PIECE // max(1, widest))
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        lists = part.column(part.schema.get_field_index(column))
        part = part.filter(lists.is_valid())
        lists = part.column(part.schema.get_field_index(column))
        sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        bad = np.r_[0, np.cumsum(~np.isfinite(flat))]
        ends = np.cumsum(np.r_[0, sizes])
        good = bad[ends[1:]] == bad[ends[:-1]]
        if not good.any():
            continue
        sizes = sizes[good]
        if (sizes != sizes[0]).any():
            raise ValueError(f"vectors of {sizes.min()} and of {sizes.max()} entries in {column!r}")
        values = flat[np.repeat(good, np.diff(ends))].reshape(len(sizes), sizes[0])
        yield part.filter(pa.array(good)), values


def whole(values: np.ndarray) -> np.ndarray:
    """floor(STEPS * c) + SHIFT as longs."""
    scaled = np.floor(STEPS * values)
    if scaled.size and np.abs(scaled).max() > 2.0**52:
        raise ValueError("an entry is too large for a whole number of 53 bits")
    return scaled.astype(np.int64) + SHIFT


def _totals(df: DataFrame, column: str, kind: str, part: Callable[[np.ndarray], dict[int, np.ndarray]]) -> dict:
    """Sums over all pieces of what ``part`` gives for a piece's whole numbers: place to number.

    A task adds its pieces up, so it sends a row a place; the rest is a Spark aggregate.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, values in vectors(batch, column):
                for start, sums in part(whole(values)).items():
                    held[start] = held[start] + sums if start in held else sums
        for start, sums in held.items():
            places = pa.array(np.arange(start, start + len(sums)), pa.int64())
            yield pa.RecordBatch.from_arrays([places, pa.array(sums)], names=["place", "total"])

    sums = df.select(f"`{column}`").mapInArrow(run, f"place long, total {kind}")
    return {r.place: r.total for r in sums.groupBy("place").agg({"total": "sum"}).toDF("place", "total").collect()}


def _fitted(df: DataFrame, column: str) -> tuple[int, np.ndarray]:
    """How many vectors there are, and the sums of their whole numbers."""
    # counts stand at -1 - dimensions, so that vectors of several lengths show
    got = _totals(df, column, "long", lambda x: {0: x.sum(axis=0), -1 - x.shape[1]: np.array([len(x)])})
    counts = {-1 - k: v for k, v in got.items() if k < 0}
    if len(counts) > 1:
        raise ValueError(f"vectors of {min(counts)} and of {max(counts)} entries in {column!r}")
    size, n = next(iter(counts.items()), (0, 0))
    return n, np.array([got[j] for j in range(size)], np.int64)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, from whole numbers where n * x fits, so that nothing cancels."""
    if n * float(np.abs(x).max(initial=0)) < 2.0**62:
        return (n * x - sums) / n
    base, rest = sums // n, sums % n
    return (x - base) - rest / n


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """The sum over dimensions of (n*x - S)^2, exact; an error where it is no long."""
    if n * float(np.abs(x).max(initial=0)) < 2.0**62:
        apart = n * x - sums
        if (apart.astype(float) ** 2).sum(axis=1).max(initial=0) < 2.0**62:
            return (apart * apart).sum(axis=1).tolist()
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    if max(exact) >= 2**63:
        raise OverflowError("a deviation does not fit a long")
    return exact


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to orthonormal ``against``."""
    old = np.hstack(against)
    for _ in range(2):  # the second time for what rounding left
        new = new - old @ (old.T @ new)
        size = np.linalg.norm(new, axis=0)
        new = new[:, size > 0] / size[size > 0]
        left, weight, _ = np.linalg.svd(new, full_matrices=False)
        new = left[:, weight > 1e-8]
    return new


def minres(product: Product, right: np.ndarray, steps: int) -> np.ndarray:
    """Solutions of product(x) = right after ``steps`` steps, for a symmetric product; columns go in step."""
    beta = np.linalg.norm(right, axis=0)
    v, before = right / np.where(beta > 0, beta, 1), np.zeros_like(right)
    x, w, w_before = (np.zeros_like(right) for _ in range(3))
    cos, sin = np.ones_like(beta), np.zeros_like(beta)
    cos_before, sin_before = cos, sin
    left = beta.copy()
    coupling = np.zeros_like(beta)
    for _ in range(steps):
        p = product(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - coupling * before
        beta = np.linalg.norm(p, axis=0)
        delta = cos * alpha - cos_before * sin * coupling
        high = sin * alpha + cos_before * cos * coupling
        higher = sin_before * coupling
        pivot = np.hypot(delta, beta)
        live = pivot > 0
        pivot = np.where(live, pivot, 1)
        cos_before, sin_before = cos, sin
        cos, sin = np.where(live, delta / pivot, 1), np.where(live, beta / pivot, 0)
        w, w_before = np.where(live, (v - higher * w_before - high * w) / pivot, 0), w
        x = x + cos * left * w
        left = -sin * left
        before, v, coupling = v, p / np.where(beta > 0, beta, 1), beta
    return x


def jacobi_davidson(
    product: Product, size: int, wanted: int, scale: float, block: int = BLOCK, inner: int = INNER, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and unit eigenvectors (columns) of a symmetric, semidefinite product.

    ``scale`` bounds the eigenvalues (the trace does). A pair is locked once its residual
    is within ``size`` roundings of the largest eigenvalue. The sign is such that the
    entry of greatest size, the first of equals, is positive. ``product`` takes a block
    of columns.
    """
    wanted = min(wanted, size)
    locked, values = np.zeros((size, 0)), np.zeros(0)
    if not wanted or not scale > 0:
        return values, locked
    room = wanted + 4 * block
    basis = _orthonormal(np.random.default_rng(seed).normal(size=(size, min(block, size))), locked)
    image = product(basis)
    for _ in range(ROUNDS):
        projected = basis.T @ image
        theta, turn = np.linalg.eigh((projected + projected.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        guess, moved = basis @ turn, image @ turn
        everything = basis.shape[1] + locked.shape[1] >= size
        if everything:  # nothing is left to add: rounding of old products is all that stands between
            moved = product(guess)
            theta = (guess * moved).sum(axis=0)
        residual = moved - guess * theta
        residual -= locked @ (locked.T @ residual)
        top = max([*theta[:1], *values[:1]])
        small = np.linalg.norm(residual, axis=0) <= max(16, size) * _EPS * top
        # pairs are taken from the largest on; one more than wanted must not exceed those
        done = len(small) if small.all() or everything else int(np.argmin(small))
        enough = len(values) >= wanted and theta[0] <= values[wanted - 1] * (1 + 1e-12)
        if not enough and done:
            locked, values = np.hstack([locked, guess[:, :done]]), np.r_[values, theta[:done]]
            order = np.argsort(-values, kind="stable")
            locked, values = locked[:, order], values[order]
            theta, guess, moved, residual = theta[done:], guess[:, done:], moved[:, done:], residual[:, done:]
            enough = len(values) >= wanted and (not len(theta) or theta[0] <= values[wanted - 1] * (1 + 1e-12))
        if enough or everything:
            locked, values = locked[:, :wanted], values[:wanted]
            lead = locked[np.abs(locked).argmax(axis=0), np.arange(len(values))]
            return values, locked * np.where(lead < 0, -1, 1)
        count = min(block, size - locked.shape[1] - guess.shape[1])
        near, wrong, shift = guess[:, :count], residual[:, :count], theta[:count]
        fixed = np.hstack([locked, near])

        def off(x: np.ndarray) -> np.ndarray:
            return x - fixed @ (fixed.T @ x)

        step = minres(lambda x: off(product(off(x)) - off(x) * shift), off(-wrong), inner) if near.size else wrong
        if guess.shape[1] + count > room - locked.shape[1] + block and guess.shape[1] > 2 * block:
            guess, moved = guess[:, : 2 * block], moved[:, : 2 * block]
        fresh = _orthonormal(step, locked, guess)
        if not fresh.shape[1]:  # the corrections say nothing new: go on in a random direction
            fresh = _orthonormal(np.random.default_rng(seed + 1 + len(values)).normal(size=(size, 1)), locked, guess)
        basis, image = np.hstack([guess, fresh]), np.hstack([moved, product(fresh)])
    raise ArithmeticError(f"{len(values)} of {wanted} eigenpairs after {ROUNDS} rounds")


def whiten(
    df: DataFrame, wanted: int = 32, column: str = "embedding", key: str = "vec_id"
) -> DataFrame:
    """A row for each vector and component: its whitened coordinate and the fit's figures.

    Vectors that are null or hold a null or non-finite entry are dropped; the others, each
    row on its own however often it is repeated, are the fit list and the result. Entries c
    count as the long floor(64 * c) + 1000000. Columns: the key (null keys stay), component
    (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error.
    Components whose eigenvalue is zero up to rounding, of which there are some where
    vectors are fewer than dimensions or all alike, have no whitened coordinate and are
    left out; an empty table gives an empty one. Vectors of several lengths, and entries
    or deviations beyond a long, are errors. Equal eigenvalues have some orthonormal basis
    of their space. Vectors may be long: a task holds ``PIECE`` numbers of them at once,
    and the driver some hundred vectors. Texts and all other columns, whatever their
    names, aren't read.

    The table is read once for each product, about thirty times; persist it if reading
    is dear.
    """
    df = df.select(df[f"`{key}`"].alias("vec_id"), df[f"`{column}`"].alias("embedding"))
    n, sums = _fitted(df, "embedding")
    size = len(sums)
    fields = [
        df.schema["vec_id"], StructField("component", IntegerType()), StructField("n", LongType()),
        StructField("deviation", LongType()), StructField("whitened", DoubleType()),
        StructField("explained", DoubleType()), StructField("identity_error", DoubleType()),
    ]
    schema = StructType(fields)
    if not n or not size:
        return df.sparkSession.createDataFrame([], schema)

    def spread(x: np.ndarray) -> dict[int, np.ndarray]:
        return {0: (_centred(x, n, sums) ** 2).sum(axis=0)}

    trace = sum(_totals(df, "embedding", "double", spread).values()) / n

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> dict[int, np.ndarray]:
            apart = _centred(x, n, sums)
            return {0: (apart.T @ (apart @ block)).ravel()}

        got = _totals(df, "embedding", "double", part)
        return np.array([got[i] for i in range(block.size)]).reshape(block.shape) / n

    values, axes = jacobi_davidson(product, size, wanted, trace)
    real = values > size * _EPS * max(values, default=0) * 16
    values, axes = values[real], axes[:, real]
    if not len(values):
        return df.sparkSession.createDataFrame([], schema)
    into = axes / np.sqrt(values)

    def second(x: np.ndarray) -> dict[int, np.ndarray]:
        white = _centred(x, n, sums) @ into
        return {0: (white.T @ white).ravel(), white.shape[1] ** 2: white.sum(axis=0)}

    got = _totals(df, "embedding", "double", second)
    k = len(values)
    moments = np.array([got[i] for i in range(k * k + k)])
    mean = moments[k * k :] / n
    error = float(np.abs(moments[: k * k].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())
    explained = values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, entries in vectors(batch, "embedding"):
                x = whole(entries)
                m = len(x)
                white = _centred(x, n, sums) @ into
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        pa.array(np.repeat(np.array(_deviation(x, n, sums), np.int64), k)),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=schema.names,
                )

    return df.mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on up to 32 whitened components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
