"""Whitening of embeddings: leading eigenvectors of their covariance by Jacobi-Davidson."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stash

COMPONENTS = 4
SCALE = 256  # entries are rounded down to this fraction
EXACT = 2.0**53  # scaled entries beyond it are no whole numbers any more
BLOCK_BYTES = 1 << 20  # of vectors in a stored block
PRECISION = 1e-13  # residuals, in parts of the largest eigenvalue
INNER_STEPS = 12
INNER_PRECISION = 0.05
OUTER_STEPS = 200
NOTHING = 1e-12  # eigenvalues below this part of the largest cannot be told from zero

Product = Callable[[np.ndarray], np.ndarray]


def _scaled(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, whole numbers) of the usable vectors of a list column, for each length in turn.

    A vector is left out if it is null or has an entry that is null, not finite, or too large to be a whole
    number exactly in a double.
    """
    lists = column.cast(pa.large_list(pa.float64()))
    present = np.asarray(lists.is_valid())
    lengths = np.asarray(pc.fill_null(lists.value_lengths(), 0), np.int64)
    flat = lists.flatten()
    values = np.asarray(pc.fill_null(flat, np.nan), np.float64) * SCALE
    good = np.abs(values) <= EXACT  # false for NaN
    bad = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[~good], minlength=len(lengths)) > 0
    starts = np.cumsum(lengths) - lengths
    usable = present & ~bad
    for length in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == length))
        yield rows, np.floor(values[starts[rows][:, None] + np.arange(length)]).astype(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole numbers of each usable vector as bytes."""
    for batch in batches:
        for _, x in _scaled(batch.column(0)):
            if x.shape[1]:
                names = pa.array([r.tobytes() for r in x.astype("<i8")], pa.binary())
                size = pa.array(np.full(len(x), x.shape[1], np.int32))
                yield pa.RecordBatch.from_arrays([size, names], ["size", "x"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct vectors put together to blocks, with how many and their sums by dimension."""

    def block(size: int, rows: list[bytes]) -> pa.RecordBatch:
        data = b"".join(rows)
        sums = np.frombuffer(data, "<i8").reshape(-1, size).sum(0, dtype=object)
        columns = [pa.array([size], pa.int32()), pa.array([len(rows)], pa.int64()), pa.array([data], pa.binary())]
        columns.append(pa.array([[str(s) for s in sums]], pa.list_(pa.string())))
        return pa.RecordBatch.from_arrays(columns, ["size", "n", "x", "sums"])

    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for size, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows = held.setdefault(size, [])
            rows.append(x)
            if len(rows) * size * 8 >= BLOCK_BYTES:
                yield block(size, held.pop(size))
    for size, rows in held.items():
        yield block(size, rows)


class _Sum:
    """A sum of arrays that keeps what rounding loses, so its error does not grow with the terms."""

    def __init__(self, shape: tuple[int, ...]):
        self.high, self.low = np.zeros(shape), np.zeros(shape)

    def add(self, x: np.ndarray) -> None:
        total = self.high + x
        back = total - self.high
        self.low += (self.high - (total - back)) + (x - back)
        self.high = total

    def value(self) -> np.ndarray:
        return self.high + self.low


def _summed(blocks: DataFrame, shape: tuple[int, ...], mean: np.ndarray, part: Callable) -> np.ndarray:
    """Sum over all blocks of ``part`` of the block's centred vectors.

    Each task adds up its blocks, Spark adds up the tasks' results entry by entry, and the driver gets one
    array, whose size does not depend on the number of vectors.  There are no more tasks than cores, so
    neither do the tasks' results grow with the number of files.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Sum(shape)
        seen = False
        for batch in batches:
            for x in batch.column(0).to_pylist():
                vectors = np.frombuffer(x, "<i8").reshape(-1, len(mean))
                total.add(part(vectors.astype(np.float64) - mean))
                seen = True
        if seen:
            columns = [pa.array(np.arange(total.high.size, dtype=np.int32))]
            columns += [pa.array(part.ravel()) for part in (total.high, total.low)]
            yield pa.RecordBatch.from_arrays(columns, ["entry", "high", "low"])

    dealt = blocks.select("x").coalesce(blocks.sparkSession.sparkContext.defaultParallelism)
    sums = dealt.mapInArrow(task, "entry int, high double, low double").groupBy("entry")
    out = np.zeros(int(np.prod(shape)))
    for entry, high, low in sums.agg(F.sum("high"), F.sum("low")).collect():  # a row for each entry
        out[entry] = high + low
    return out.reshape(shape)


def _orthonormal(new: np.ndarray, old: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``new`` adds to the orthonormal columns ``old``."""
    out = np.zeros((len(new), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):
            for held in (old, out):
                column = column - held @ (held.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-8:
                break
            column = column / left
        else:
            out = np.column_stack([out, column])
    return out


def _corrections(product: Product, shifts: np.ndarray, found: np.ndarray, residuals: np.ndarray) -> np.ndarray:
    """Approximate solutions t of (I-QQ')(V - shift)(I-QQ') t = -r for several r, by MINRES.

    Q has the Ritz vectors in its columns.  The equations are solved side by side, so a step is one
    distributed product for all of them.
    """

    def off(x: np.ndarray) -> np.ndarray:
        x = x - found @ (found.T @ x)
        return x - found @ (found.T @ x)

    right = off(-residuals)
    size = np.linalg.norm(right, axis=0)
    goal = INNER_PRECISION * size
    scale = np.where(size > 0, size, 1.0)
    v, v_old = right / scale, np.zeros_like(right)
    x = np.zeros_like(right)
    w, w_old = np.zeros_like(right), np.zeros_like(right)
    k = right.shape[1]
    beta, eta = np.zeros(k), size.copy()
    c, c_old, s, s_old = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    active = size > 0
    for _ in range(INNER_STEPS):
        if not active.any():
            break
        applied = off(product(v) - v * shifts)
        alpha = (v * applied).sum(0)
        following = applied - alpha * v - beta * v_old
        beta_next = np.linalg.norm(following, axis=0)
        # the rotations of the QR factors of the growing tridiagonal matrix
        delta = c * alpha - c_old * s * beta
        rho = np.hypot(delta, beta_next)
        usable = active & (rho > 0)
        safe = np.where(rho > 0, rho, 1.0)
        second = s * alpha + c_old * c * beta
        third = s_old * beta
        c_new, s_new = delta / safe, beta_next / safe
        w_new = (v - third * w_old - second * w) / safe
        x = np.where(usable, x + c_new * eta * w_new, x)
        eta = np.where(usable, -s_new * eta, eta)
        active = usable & (np.abs(eta) > goal) & (beta_next > 1e-14 * np.abs(shifts))
        v_old, v = v, np.where(beta_next > 0, following / np.where(beta_next > 0, beta_next, 1.0), 0.0)
        w_old, w = w, w_new
        c_old, c, s_old, s = c, c_new, s, s_new
        beta = beta_next
    return off(x)


def jacobi_davidson(product: Product, size: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors, of a symmetric positive matrix.

    ``product`` multiplies the matrix with a few columns; nothing else of it is known.  A
    subspace grows by solutions of the correction equations of the wanted Ritz pairs; a pair whose
    residual is below ``PRECISION`` is locked: it stays in the subspace but is corrected no more.
    The subspace is cut back to the best Ritz vectors when it is full.
    """
    wanted = min(wanted, size)
    most = min(size, max(8 * wanted, 32))
    rng = np.random.default_rng(7)
    space = _orthonormal(rng.standard_normal((size, min(size, 2 * wanted))), np.zeros((size, 0)))
    image = product(space)
    locked = np.zeros(wanted, bool)
    for _ in range(OUTER_STEPS):
        small = space.T @ image
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        ritz, moved = space @ turns[:, :wanted], image @ turns[:, :wanted]
        residuals = moved - ritz * values[:wanted]
        norms = np.linalg.norm(residuals, axis=0)
        locked = norms <= PRECISION * max(values[0], 0.0)
        if locked.all() or space.shape[1] == size:
            return values[:wanted], ritz
        if space.shape[1] + wanted > most and most < size:
            kept = turns[:, : 2 * wanted]
            space, image = space @ kept, image @ kept
        open_ = np.flatnonzero(~locked)
        added = _corrections(product, values[open_], ritz, residuals[:, open_])
        added = _orthonormal(added, space)
        if not added.shape[1]:  # the subspace holds all that rounding lets through
            added = _orthonormal(rng.standard_normal((size, wanted)), space)
        space, image = np.column_stack([space, added]), np.column_stack([image, product(added)])
    raise ArithmeticError(f"no convergence in {OUTER_STEPS} steps; residuals {norms}")


@dataclass
class Whitening:
    """Fit of the vectors of one length: numbers, exact sums, components and what they explain."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    components: np.ndarray  # a column each
    explained: np.ndarray
    identity_error: float


def _fit(blocks: DataFrame, n: int, sums: list[int], wanted: int) -> Whitening:
    mean = np.array([s / n for s in sums])
    size = len(sums)

    def product(u: np.ndarray) -> np.ndarray:
        return _summed(blocks, u.shape, mean, lambda x: x.T @ (x @ u)) / n

    trace = float(_summed(blocks, (1,), mean, lambda x: np.array([(x * x).sum()]))[0]) / n
    if trace == 0:
        values, vectors = np.zeros(0), np.zeros((size, 0))
    else:
        values, vectors = jacobi_davidson(product, size, wanted)
        above = values > NOTHING * values[0]
        values, vectors = values[above], vectors[:, above]
    k = len(values)
    error = 0.0
    if k:
        turned = vectors / np.sqrt(values)

        def moments(x: np.ndarray) -> np.ndarray:
            w = x @ turned
            return np.vstack([w.T @ w, w.sum(0)])

        summed = _summed(blocks, (k + 1, k), mean, moments) / n
        error = float(np.abs(summed[:k] - np.outer(summed[k], summed[k]) - np.eye(k)).max())
    return Whitening(n, sums, mean, values, vectors, values / trace if trace else values, error)


def fit_whitening(rows: DataFrame, *, vector: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitening]:
    """A fit for each length of vectors: components of the covariance of the distinct scaled vectors.

    Entries are multiplied by 256 and rounded down.  Distinct vectors are stored in blocks; every step of
    the eigensolver reads the blocks once, and only arrays of (length, components) entries leave the
    tasks.  Vectors of different lengths have nothing in common and are fitted one after another.

    Vectors that are null or hold null or non-finite entries, or ones of 2**45 and beyond, are left
    out; empty ones have no components.  Repeated vectors count once.  Components of zero variance
    (fewer distinct vectors than components) are left out.  No rows give no fits.
    """
    keys = rows.select(F.col(vector)).mapInArrow(_keys, "size int, x binary").distinct()
    blocks = stash(keys.mapInArrow(_packed, "size int, n long, x binary, sums array<string>"), "whitening-blocks")
    entries = blocks.select("size", "n", F.posexplode("sums").alias("entry", "s"))
    totals = entries.groupBy("size", "entry").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(28,0)")).alias("s"))
    by_size: dict[int, list] = {}
    for size, entry, n, s in totals.collect():  # a row per dimension
        by_size.setdefault(size, []).append((entry, n, int(s)))
    fits = {}
    for size, found in sorted(by_size.items()):
        found.sort()
        fits[size] = _fit(blocks.where(F.col("size") == size), found[0][1], [s for _, _, s in found], components)
    return fits


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)**2, exactly; None beyond 64 bits."""
    largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if largest * largest * len(sums) < 2**63:
        apart = n * x - np.array(sums, np.int64)
        return (apart * apart).sum(1).tolist()
    apart = n * x.astype(object) - np.array(sums, object)
    return [int(d) if d < 2**63 else None for d in (apart * apart).sum(1)]


COLUMNS = ["component", "n", "deviation", "whitened", "explained", "identity_error"]


def whiten(rows: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of all usable rows.

    A row for each vector and component: the centred vector projected on the component, over the root of its
    eigenvalue; how much of the variance the component explains; the squared distance of the vector
    from the mean, times n squared, exactly (null if it does not fit a long); and the largest
    deviation of the whitened fit list's covariance from the identity.

    Rows are left out, and components missing, as in ``fit_whitening``.  Null ids stay null; repeated rows
    are rows of their own; other columns are not read; an empty table gives no rows.
    """
    fits = fit_whitening(rows, vector=vector, components=components)
    plain = {size: tuple(vars(fit).values()) for size, fit in fits.items()}

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _scaled(batch.column(1)):
                if x.shape[1] not in plain:
                    continue
                n, sums, mean, values, vectors, explained, error = plain[x.shape[1]]
                k = len(values)
                if not k:
                    continue
                whitened = (x - mean) @ vectors / np.sqrt(values)
                m = len(at)
                columns = [
                    batch.column(0).take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", *COLUMNS])

    given = rows.select(F.col(vec_id).alias("id"), F.col(vector))
    kinds = [T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType()]
    fields = [T.StructField("id", given.schema["id"].dataType)]
    fields += [T.StructField(name, kind) for name, kind in zip(COLUMNS, kinds, strict=True)]
    return given.mapInArrow(project, T.StructType(fields))
