"""Whitening of embeddings by refined eigenvectors of their covariance.

An entry ``c`` counts as the whole number ``x = floor(1024 * c) + 100000``. Tasks add
up whole numbers only, after the nearest whole number to each mean is taken off, so
the covariance is exact up to one rounding, however many rows and in whatever order.

Its eigenvectors start in float32 and are then corrected by the steps of Ogita and
Aishima, which are a few matrix products in a wider type each and square the error.
Eigenvalues that a step cannot tell apart form a cluster: the covariance, shifted by
the cluster's mean, is projected on the cluster's vectors, and that small matrix is
solved again in float32, where what was the last bit of the eigenvalues is now the first.

A vector is left out if it is null, empty, holds a null or non-finite entry or one
whose ``x`` is beyond 2**62, or is of another length than most (of equally many the
longer). Ids may be null or repeat; equal vectors have equal results. A component
without variance has null in ``whitened`` and no share. No vectors, no rows. Only
matrices by dimension reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sources.relations import written

SCALE, SHIFT = 1024, 100_000
#: The type of the corrections: 64 bits of mantissa where the machine has them.
WIDE = np.longdouble
#: Correction steps at most. Three or four do; equal eigenvalues end when rounding does.
STEPS = 24
#: Whole numbers travel as limbs of so many bits, so that sums over tasks fit a long.
LIMB, LIMBS = 42, 4
#: Vectors multiplied at a time.
BLOCK = 4_096


def usable(vector: Column) -> Column:
    """No null, no infinite entry, none too large; not null or empty itself."""
    entry_fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0**62 / SCALE)
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, entry_fits)


def common_length(vectors: DataFrame) -> int:
    """Length of most vectors of the column ``_vector``; 0 without any."""
    counts = vectors.groupBy(F.size("_vector").alias("length")).count()
    found = counts.orderBy(F.desc("count"), F.desc("length")).first()
    return found.length if found else 0


def to_limbs(value: int) -> list[int]:
    """Limbs from the lowest up; the highest has the sign."""
    low = [value >> LIMB * i & (1 << LIMB) - 1 for i in range(LIMBS - 1)]
    return [*low, value >> LIMB * (LIMBS - 1)]


def summed(partial: DataFrame) -> dict[int, int]:
    """Totals of the cells that tasks give as ``(cell, l0, ..)``; one row a cell comes back."""
    rows = partial.groupBy("cell").agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS)]).collect()
    return {row.cell: sum(row[i + 1] << LIMB * i for i in range(LIMBS)) for row in rows}


def cells(totals: Iterator[tuple[int, int]]) -> pa.RecordBatch:
    rows = [[cell, *to_limbs(int(value))] for cell, value in totals]
    columns = list(zip(*rows)) or [()] * (LIMBS + 1)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=CELLS.names)


CELLS = T.StructType([T.StructField(name, T.LongType()) for name in ["cell", *[f"l{i}" for i in range(LIMBS)]]])


def whole_numbers(column: pa.Array, dims: int) -> np.ndarray:
    """``x`` of each vector, a row each."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    return np.floor(values * SCALE).astype(np.int64) + SHIFT


def exact_products(rows: np.ndarray) -> np.ndarray:
    """``rows.T @ rows`` of whole numbers, as whole numbers.

    Products of doubles are exact while every sum stays below 2**53; entries too
    large for that are multiplied as Python's numbers.
    """
    most = int(np.abs(rows).max(initial=0))
    if most * most * len(rows) < 2**53:
        real = rows.astype(np.float64)
        return (real.T @ real).astype(np.int64)
    if len(rows) > 1 and most * most < 2**52:
        half = len(rows) // 2
        return exact_products(rows[:half]).astype(object) + exact_products(rows[half:])
    large = rows.astype(object)
    return large.T @ large


def moments(vectors: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors, and the sum of ``x`` in each dimension."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dims, dtype=object)
        for batch in batches:
            x = whole_numbers(batch.column(0), dims)
            n += len(x)
            sums += (x >> 32).sum(axis=0).astype(object) * 2**32 + (x & (2**32 - 1)).sum(axis=0).astype(object)
        yield cells(enumerate([*sums, n]))

    found = summed(vectors.select("_vector").mapInArrow(added, CELLS))
    return found.get(dims, 0), [found.get(i, 0) for i in range(dims)]


def scatter(vectors: DataFrame, centre: list[int]) -> np.ndarray:
    """Sums of products of ``x - centre``, as whole numbers."""
    dims, middle = len(centre), np.array(centre, dtype=np.int64)
    upper = np.triu_indices(dims)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, blocks = np.zeros((dims, dims), dtype=object), np.zeros((dims, dims), dtype=np.int64), 0
        for batch in batches:
            x = whole_numbers(batch.column(0), dims) - middle
            for at in range(0, len(x), BLOCK):
                part = exact_products(x[at : at + BLOCK])
                if part.dtype == object:
                    total += part
                    continue
                held += part
                blocks += 1
                if blocks == 512:  # each below 2**53
                    total, held, blocks = total + held.astype(object), np.zeros_like(held), 0
        total += held.astype(object)
        yield cells(zip((upper[0] * dims + upper[1]).tolist(), total[upper]))

    found = summed(vectors.select("_vector").mapInArrow(added, CELLS))
    whole = np.zeros((dims, dims), dtype=object)
    for cell, value in found.items():
        i, j = divmod(cell, dims)
        whole[i, j] = whole[j, i] = value
    return whole


def covariance(n: int, sums: list[int], centre: list[int], products: np.ndarray) -> np.ndarray:
    """Covariance with divisor ``n``, each entry rounded once."""
    off = np.array([s - n * c for s, c in zip(sums, centre)], dtype=object)
    above = products * n - np.outer(off, off)  # times n * n
    whole = above // (n * n)
    return whole.astype(WIDE) + (above - whole * (n * n)).astype(WIDE) / WIDE(n * n)


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns, of a symmetric matrix.

    ``matrix`` is in the wide type, and so are the results.
    """
    size = np.abs(matrix).max(initial=WIDE(0))
    dims = len(matrix)
    if size == 0:
        return np.zeros(dims, dtype=WIDE), np.eye(dims, dtype=WIDE)
    a = matrix / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    one, eps = np.eye(dims, dtype=WIDE), np.finfo(WIDE).eps
    least, since = np.inf, 0
    for _ in range(STEPS):
        r, s = one - x.T @ x, x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        apart = s - np.diag(np.diag(s))
        off = float(np.abs(apart).max() + np.abs(r).max())
        # A cluster that falls apart may set a step back, and rounding ends all progress.
        least, since = (off, 0) if off < least / 2 else (least, since + 1)
        if off <= 4 * eps or since == 4:
            break
        unsure = 2 * (np.linalg.norm(apart.astype(np.float64)) + np.linalg.norm(r.astype(np.float64)))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= unsure
        x = x + x @ np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
        for group in clusters(values, unsure):
            x[:, group] = x[:, group] @ sub_solve(a, x[:, group])
    x = at_right_angles(x)
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0) * size
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    largest = x[np.abs(x).argmax(axis=0), np.arange(dims)]
    return values[order], x * np.sign(largest)


def clusters(values: np.ndarray, unsure: float) -> list[np.ndarray]:
    """Indices of eigenvalues in chains of steps of at most ``unsure``; two at least."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > unsure) + 1
    return [group for group in np.split(order, cuts) if len(group) > 1]


def sub_solve(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A rotation of the vectors of a cluster that separates their eigenvalues."""
    middle = (x * (a @ x)).sum() / x.shape[1]
    small = x.T @ (a @ x - middle * x)
    small = (small + small.T) / 2
    size = np.abs(small).max()
    if size <= np.finfo(WIDE).eps:
        return np.eye(x.shape[1], dtype=WIDE)  # equal as far as can be told: any basis will do
    turn = np.linalg.eigh((small / size).astype(np.float32))[1].astype(WIDE)
    return at_right_angles(turn)


def at_right_angles(x: np.ndarray) -> np.ndarray:
    """Columns that are at right angles to some seven digits, to all digits (two Newton steps)."""
    for _ in range(2):
        x = x @ (3 * np.eye(x.shape[1], dtype=WIDE) - x.T @ x) / 2
    return x


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``n`` vectors with ``sums`` of ``x``, and for each component
    its direction (a row of ``axes``), eigenvalue and share of all variance."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.sums)

    @property
    def centre(self) -> list[int]:
        """The whole number nearest to each mean."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    def has_variance(self) -> np.ndarray:
        """Components whose eigenvalue is more than rounding."""
        return self.eigenvalues > self.eigenvalues.max(initial=0) * self.dims * np.finfo(np.float64).eps

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of whole numbers ``x``; NaN without variance."""
        centre = self.centre
        rest = np.array([(s - self.n * c) / self.n for s, c in zip(self.sums, centre)])
        some = self.has_variance()
        scale = np.where(some, 1 / np.sqrt(np.where(some, self.eigenvalues, 1)), np.nan)
        return ((x - np.array(centre, dtype=np.int64)) - rest) @ (self.axes * scale[:, None]).T


def prepared(vectors: DataFrame, vector: str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns ``keep`` and ``_vector``, as doubles, of the vectors that are not left out for what they hold."""
    rows = vectors.select(F.col(vector).cast("array<double>").alias("_vector"), *[F.col(name) for name in keep])
    return rows.where(usable(F.col("_vector")))


def fit(vectors: DataFrame, vector: str = "embedding", components: int = 8) -> Whitening | None:
    """The whitening of all usable vectors; None without any."""
    rows = prepared(vectors, vector)
    dims = common_length(rows)
    if not dims:
        return None
    rows = rows.where(F.size("_vector") == dims)
    n, sums = moments(rows, dims)
    model = Whitening(n, tuple(sums), np.zeros((0, dims)), np.zeros(0), np.zeros(0))
    spread = covariance(n, sums, model.centre, scatter(rows, model.centre))
    values, axes = eigen(spread)
    values, trace = np.maximum(values[:components], 0), np.trace(spread)
    shares = values / trace if trace > 0 else np.zeros(len(values))
    return Whitening(
        n, tuple(sums), axes[:, :components].T.astype(np.float64), values.astype(np.float64), shares.astype(np.float64)
    )


def identity_error(vectors: DataFrame, model: Whitening, vector: str = "embedding") -> float | None:
    """Largest entry of the covariance of what ``project`` gives, minus the identity,
    over the fitted vectors; None if no component has variance.

    What is multiplied is centred already: the mean of ``x`` is taken off exactly.
    """
    some, dims = model.has_variance(), model.dims
    count = int(some.sum())
    if not count:
        return None

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count, count))
        for batch in batches:
            w = model.project(whole_numbers(batch.column(0), dims))[:, some]
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count**2)), pa.array(total.ravel())], names=["cell", "value"])

    rows = prepared(vectors, vector).where(F.size("_vector") == dims).select("_vector")
    parts = rows.mapInArrow(added, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    found = np.zeros(count**2)
    for row in parts.collect():
        found[row.cell] = row.value
    return float(np.abs(found.reshape(count, count) / model.n - np.eye(count)).max())


def deviations(x: np.ndarray, model: Whitening) -> pa.Array:
    """The exact sum over dimensions of ``(n * x - sum)**2``, as decimals."""
    kind, centre = pa.decimal128(38, 0), model.centre
    y = x - np.array(centre, dtype=np.int64)
    off = [s - model.n * c for s, c in zip(model.sums, centre)]
    most = int(np.abs(y).max(initial=0)) * model.n + max(map(abs, off), default=0)
    if most * most * max(1, model.dims) < 2**63:
        apart = y * model.n - np.array(off, dtype=np.int64)
        return pa.array((apart * apart).sum(axis=1)).cast(kind)
    apart = y.astype(object) * model.n - np.array(off, dtype=object)
    return pa.array([Decimal(v) if abs(v) < 10**38 else None for v in (apart * apart).sum(axis=1)], kind)


def whitened(vectors: DataFrame, model: Whitening | None, keep: Sequence[str], vector: str = "embedding") -> DataFrame:
    """Columns ``keep`` of each fitted vector with ``deviation``, an exact decimal that is
    null beyond 38 digits, and ``whitened``, an array with an entry a component."""
    rows = prepared(vectors, vector, keep)
    schema = T.StructType([*rows.schema.fields[1:], *T.StructType.fromDDL("deviation decimal(38,0), whitened array<double>").fields])
    if model is None:
        return rows.where("false").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(batch.column(0), model.dims)
            w = model.project(x)
            values = pa.array(w.ravel(), mask=np.isnan(w.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), values)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], deviations(x, model), lists], names=schema.names)

    return rows.where(F.size("_vector") == model.dims).mapInArrow(projected, schema)


def by_component(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """A row for each fitted vector and component, numbered from 1 by falling eigenvalue:
    ``(vec_id, component, n, deviation, whitened, explained, identity_error)``."""
    rows = written(vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("embedding")), "vectors")
    model = fit(rows, components=components)
    found = whitened(rows, model, ["vec_id"])
    error = None if model is None else identity_error(rows, model)
    shares = [] if model is None else model.explained.tolist()
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(0 if model is None else model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*map(F.lit, shares)).cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
