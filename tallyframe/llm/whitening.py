"""Whitening of vectors by the leading eigenvectors of their covariance: Jacobi-Davidson.

The covariance is never made. It acts on a block of vectors V as the mean over rows of
(x - mean) ((x - mean) . V), one pass over the rows by Spark tasks, of which only sums of
dimensions times columns leave a task; they are added up in tasks before the driver gets
a few. Blocks of rows are whole numbers, centred exactly at a whole number and then by the
rest of the mean.

On the driver there are only vectors of as many numbers as there are dimensions:

1. Rayleigh-Ritz on a subspace gives the wanted Ritz pairs and their residuals.
2. Pairs whose residuals have reached double precision are locked, in order.
3. The others get corrections: (I - QQ')(A - theta)(I - QQ') t = -r, Q the locked and the
   present Ritz vectors, solved by a few steps of MINRES, all columns in one pass a step.
4. The corrections join the subspace, which is thinned to its best Ritz vectors when it
   has grown too large. This ends when all pairs are locked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.rows import column_of, store, with_results

_SEED = 13
_EPS = float(np.finfo(float).eps)
#: MINRES steps a correction; residuals of that share of the first are good enough.
_STEPS, _GOOD = 4, 0.02
#: Rounds after which an error says that the pairs do not converge.
_ROUNDS = 300
#: Rows of a block at most, and sums that the driver adds up itself.
_ROWS, _FEW = 4096, 64


def whole_numbers(df: DataFrame, scale: int, offset: int, vector: str, id: str) -> DataFrame:
    """``(vec_id, x)``, x = floor(scale * entry) + offset, of the rows that take part.

    Rows with a null vector, or null, NaN or infinite entries, are dropped. An entry that
    exceeds a long is an error.
    """
    given = df.select(column_of(df, id).alias("vec_id"), column_of(df, vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    error = F.raise_error(F.lit("an entry exceeds a long")).cast("long")

    def number(c: Column) -> Column:
        return F.when(F.abs(c * scale) < float(1 << 62), F.floor(c * scale).cast("long") + offset).otherwise(error)

    return given.where(F.col("v").isNotNull() & finite).select("vec_id", F.transform("v", number).alias("x"))


def _rows_of(array: pa.Array, dims: int, filled: int) -> np.ndarray:
    """Lists as rows of a matrix; short ones are filled up."""
    values = array.flatten().to_numpy(zero_copy_only=False)
    lengths = array.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return values.reshape(len(array), dims)
    rows = np.full((len(array), dims), filled, dtype=np.int64)
    rows[np.arange(dims) < lengths[:, None]] = values
    return rows


@dataclass(frozen=True)
class Blocks:
    """Rows as a stored table of ``(x binary)``, a matrix of longs a row."""

    frame: DataFrame
    dims: int
    tasks: int

    @classmethod
    def of(cls, numbers: DataFrame, dims: int, filled: int) -> Blocks:
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, min(_ROWS, (8 << 20) // (8 * dims)))
            for batch in batches:
                rows = _rows_of(batch.column(0), dims, filled)
                for low in range(0, len(rows), step):
                    held = pa.array([rows[low : low + step].tobytes()], pa.binary())
                    yield pa.RecordBatch.from_arrays([held], names=["x"])

        frame = store(numbers.select("x").mapInArrow(pack, "x binary"), "blocks")
        return cls(frame, dims, frame.rdd.getNumPartitions())

    def summed(self, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of what a function makes of each block, arrays of one shape.

        Every task adds up its own; if many tasks did, fewer tasks add those up, and the
        driver gets the square root of their number.
        """
        dims = self.dims

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for x in batch.column(0):
                    made = of_block(np.frombuffer(x.as_buffer(), dtype="<i8").reshape(-1, dims))
                    total = made if total is None else total + made
            if total is not None:
                yield _as_batch(total)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [_as_array(b.as_py(), s.as_py()) for batch in batches for b, s in zip(*batch.columns, strict=True)]
            if parts:
                yield _as_batch(sum(parts[1:], parts[0]))

        schema = "sums binary, shape array<long>"
        sums = self.frame.mapInArrow(partial, schema)
        if self.tasks > _FEW:
            sums = sums.repartition(int(self.tasks**0.5)).mapInArrow(add, schema)
        # In an order of their own, so that equal sums are added up in one way.
        parts = [_as_array(b, s) for b, s in sorted((bytes(r["sums"]), r["shape"]) for r in sums.collect())]
        return sum(parts[1:], parts[0])


def _as_batch(array: np.ndarray) -> pa.RecordBatch:
    kind = 0 if array.dtype.kind == "i" else 1
    shape = pa.array([[kind, *array.shape]], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([array.tobytes()], pa.binary()), shape], names=["sums", "shape"])


def _as_array(data: bytes, shape: list[int]) -> np.ndarray:
    return np.frombuffer(data, dtype="<f8" if shape[0] else "<i8").reshape(shape[1:])


@dataclass(frozen=True)
class Mean:
    """Number of rows, sums of each dimension, and the mean as a whole number and a rest."""

    n: int
    sums: tuple[int, ...]

    @property
    def pivot(self) -> np.ndarray:
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([(s - int(p) * self.n) / self.n for s, p in zip(self.sums, self.pivot, strict=True)])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.pivot).astype(float) - self.rest


def mean_of(blocks: Blocks) -> Mean:
    """Exact: the halves of each long are added up apart."""
    def halves(x: np.ndarray) -> np.ndarray:
        return np.stack([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), np.full(x.shape[1], len(x))])

    high, low, count = blocks.summed(halves).tolist()
    return Mean(count[0], tuple((h << 32) + w for h, w in zip(high, low, strict=True)))


def _off(basis: np.ndarray, x: np.ndarray) -> np.ndarray:
    """What of the columns is at right angles to the basis."""
    return x - basis @ (basis.T @ x)


def _basis(known: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Unit columns at right angles that span, with ``known``, what both span."""
    out = np.zeros((len(new), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        for _ in range(3):
            column = _off(out, _off(known, column))
            if not np.linalg.norm(column) > 0:
                break
            column = column / np.linalg.norm(column) if np.linalg.norm(column) > _EPS * size else column * 0
        if abs(np.linalg.norm(column) - 1) < 1e-8:
            out = np.column_stack([out, column])
    return out


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, good: float) -> np.ndarray:
    """Columns t that make ``apply(t) - right`` small; ``apply`` is symmetric in each column.

    One product a step for all columns. Ends early when all residuals are below ``good``
    times the first.
    """
    beta = np.linalg.norm(right, axis=0)
    safe = lambda x: np.where(x == 0, 1, x)
    v_old, v = np.zeros_like(right), right / safe(beta)
    w_older, w_old = np.zeros_like(right), np.zeros_like(right)
    c_old, c = np.ones_like(beta), np.ones_like(beta)
    s_old, s = np.zeros_like(beta), np.zeros_like(beta)
    eta, first, found = beta.copy(), safe(beta), np.zeros_like(right)
    for _ in range(steps):
        u = apply(v)
        alpha = np.einsum("ij,ij->j", v, u)
        u = u - alpha * v - beta * v_old
        new_beta = np.linalg.norm(u, axis=0)
        diagonal = c * alpha - c_old * s * beta
        length = np.hypot(diagonal, new_beta)
        w = (v - (s_old * beta) * w_older - (s * alpha + c_old * c * beta) * w_old) / safe(length)
        c_old, c, s_old, s = c, diagonal / safe(length), s, new_beta / safe(length)
        found = found + np.where(length > 0, c * eta, 0) * w
        eta = -s * eta
        v_old, v, beta = v, u / safe(new_beta), new_beta
        w_older, w_old = w_old, w
        if (np.abs(eta) <= good * first).all():
            break
    return found


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a symmetric, positive operator, their unit vectors, and
    the norms of the residuals, which are at most ``dims`` (32 at least) roundings of the
    greatest eigenvalue.

    ``product`` maps columns to columns; it is called with several at a time.
    """
    wanted = min(wanted, dims)
    largest = min(dims, max(6 * wanted, 24))
    space = _basis(np.zeros((dims, 0)), np.random.default_rng(_SEED).normal(size=(dims, min(dims, 2 * wanted))))
    image = product(space)
    locked, values, norms = np.zeros((dims, 0)), [], []
    for _ in range(_ROUNDS):
        inner = space.T @ image
        theta, turn = np.linalg.eigh((inner + inner.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        missing = wanted - locked.shape[1]
        residuals = image[:, :missing] - space[:, :missing] * theta[:missing]
        size = np.linalg.norm(residuals, axis=0)
        bound = max(dims, 32) * _EPS * max([abs(theta[0]), *values])
        # Locked pairs are followed by the next ones in order only.
        done = int(np.argmin(size <= bound)) if (size > bound).any() else missing
        locked = np.column_stack([locked, space[:, :done]])
        values, norms = [*values, *theta[:done].tolist()], [*norms, *size[:done].tolist()]
        space, image, theta, residuals = space[:, done:], image[:, done:], theta[done:], residuals[:, done:]
        missing -= done
        if not missing:
            order = np.argsort(values)[::-1]
            return np.array(values)[order], locked[:, order], np.array(norms)[order]
        if space.shape[1] + missing > largest - locked.shape[1] and largest < dims:
            space, image = space[:, : 2 * missing], image[:, : 2 * missing]
        known = np.column_stack([locked, space[:, :missing]])
        shift = theta[:missing]
        corrected = lambda t: _off(known, product(_off(known, t)) - _off(known, t) * shift)
        new = minres(corrected, -_off(known, residuals), _STEPS, _GOOD)
        new = _basis(np.column_stack([locked, space]), new)
        if not new.shape[1]:
            # The corrections lie in the subspace; its products are made anew.
            space = _basis(locked, space)
            image = product(space)
            continue
        space, image = np.column_stack([space, new]), np.column_stack([image, product(new)])
        image = _off(locked, image)
    raise RuntimeError(f"eigenpairs did not reach double precision in {_ROUNDS} rounds")


@dataclass(frozen=True)
class Whitening:
    """What whitening needs of the rows it was fitted on.

    ``values`` are the eigenvalues and ``vectors`` has the unit eigenvectors as columns,
    each with its largest entry positive; ``trace`` is the sum of all variances.
    """

    mean: Mean
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    trace: float

    def of(self, x: np.ndarray) -> np.ndarray:
        return self.mean.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """The sum of (n * x - sum) ** 2 over the dimensions, exact; an error beyond a long."""
        n, pivot = self.mean.n, self.mean.pivot
        rest = [s - int(p) * n for s, p in zip(self.mean.sums, pivot, strict=True)]
        over = x - pivot
        most = n * (int(np.abs(over).max(initial=0)) + 1)
        if most * most * x.shape[1] < 1 << 62:
            return ((n * over - np.array(rest, dtype=np.int64)) ** 2).sum(axis=1)
        exact = [sum((n * c - r) ** 2 for c, r in zip(row, rest, strict=True)) for row in over.tolist()]
        if max(exact) >= 1 << 63:
            raise OverflowError("a deviation exceeds a long")
        return np.array(exact, dtype=np.int64)


def fit(blocks: Blocks, components: int) -> Whitening:
    """Mean, trace and leading eigenpairs of the rows of a table of blocks."""
    mean, dims = mean_of(blocks), blocks.dims
    squares = blocks.summed(lambda x: (mean.centred(x) ** 2).sum(axis=0, keepdims=True))

    def product(columns: np.ndarray) -> np.ndarray:
        def act(x: np.ndarray) -> np.ndarray:
            z = mean.centred(x)
            return z.T @ (z @ columns)

        return blocks.summed(act) / mean.n

    values, vectors, norms = jacobi_davidson(product, dims, components)
    some = values > max(dims, 32) * _EPS * values[0]
    values, vectors, norms = values[some], vectors[:, some], norms[some]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return Whitening(mean, values, vectors, norms, float(squares.sum()) / mean.n)


def identity_error(blocks: Blocks, model: Whitening) -> float:
    """The largest entry, without sign, of the whitened rows' covariance less the identity."""
    size = len(model.values)
    if not size:
        return 0.0
    middle = blocks.summed(lambda x: model.of(x).sum(axis=0, keepdims=True)) / model.mean.n

    def products(x: np.ndarray) -> np.ndarray:
        w = model.of(x) - middle
        return w.T @ w

    return float(np.abs(blocks.summed(products) / model.mean.n - np.eye(size)).max())


def whiten(
    df: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100_000, vector: str = "embedding", id: str = "vec_id"
) -> tuple[DataFrame, Whitening | None, float]:
    """The rows' ids with ``whitened`` and ``deviation``; the fitted model; its identity error.

    Every entry c becomes the long x = floor(scale * c) + offset. ``whitened`` has, for each
    of the leading ``components`` eigenvectors of the covariance of x (divisor n), the
    centred row's projection over the root of the eigenvalue; ``deviation`` is the sum over
    dimensions of (n * x - sum of x) ** 2, exact.

    Rows with a null vector or null, NaN or infinite entries are dropped; rows with null ids
    and repeated rows count as rows of their own. Shorter vectors count as filled up with
    zeros (x is ``offset`` there). Components without variance, up to rounding, are left
    out, so there are at most as many as dimensions, and none where all rows are equal.
    Equal eigenvalues have any orthogonal vectors of their space, the same for all rows. An
    empty table gives no rows and no model.
    """
    numbers = store(whole_numbers(df, scale, offset, vector, id), "whole-numbers")
    count, dims = numbers.agg(F.count("*"), F.max(F.size("x"))).first()
    results = [T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.LongType())]
    if not count or not dims:
        nothing = numbers.select(
            F.col("vec_id").alias(id), F.array().cast("array<double>").alias("whitened"), F.lit(0).cast("long").alias("deviation")
        )
        return nothing, None, 0.0
    blocks = Blocks.of(numbers, dims, offset)
    model = fit(blocks, components)

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        x = _rows_of(columns[0], dims, offset)
        made = np.ascontiguousarray(model.of(x))
        offsets = np.arange(len(x) + 1, dtype=np.int32) * made.shape[1]
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(made.ravel())), pa.array(model.deviations(x))]

    rows = with_results(numbers.select("vec_id", "x"), [F.col("x")], results, run)
    return rows.select(F.col("vec_id").alias(id), "whitened", "deviation"), model, identity_error(blocks, model)
