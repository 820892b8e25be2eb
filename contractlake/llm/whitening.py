"""Whitening of embeddings: principal components by pivoted Cholesky and one-sided Jacobi.

Tasks send sums and the scatter matrix of their vectors, which grow with the square of the
dimension and not with the rows; factoring that matrix is the only work on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from contractlake.llm.common import map_batches

# How an entry becomes a whole number.
SCALE, SHIFT = 64, 1_000_000
# Entries of this size or more have no such number and count as not finite.
TOO_LARGE = 2.0**55
COMPONENTS = 32
# A direction with less of the largest variance than this has none but rounding.
NO_VARIANCE = 1e-13


@dataclass(frozen=True)
class Whitening:
    """What is fitted: counts, exact sums, and per component its direction, variance and share."""

    n: int
    sums: np.ndarray
    directions: np.ndarray  # dimension x components
    variances: np.ndarray
    explained: np.ndarray
    largest: int  # bound of a row's deviation

    @property
    def dimension(self) -> int:
        return len(self.sums)


def usable(vector: Column, dimension: int | None = None) -> Column:
    """Whether a vector is there with finite entries only (and of the given length)."""
    entry = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(TOO_LARGE))
    found = vector.isNotNull() & F.forall(vector.cast("array<double>"), entry)
    found = found if dimension is None else found & (F.size(vector) == dimension)
    return F.coalesce(found, F.lit(False))


def whole(values: np.ndarray) -> np.ndarray:
    """Entries as whole numbers."""
    return np.floor(SCALE * values.astype(np.float64)).astype(np.int64) + SHIFT


def _vectors(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return whole(flat).reshape(-1, dimension)


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of about 4 MB as whole numbers."""
    rows = max(1, (1 << 19) // dimension)
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            part = batch.slice(first, rows)
            yield part, _vectors(part, dimension)


def _total(rows: DataFrame, columns: str) -> np.ndarray:
    """Sum of ``values`` over the rows of each ``place``, as one array in order of the places.

    The sums are made by tasks; the driver gets one row per place.
    """
    places = rows.select("place", F.posexplode("values").alias("i", "value"))
    sums = places.groupBy("place", "i").agg(F.sum("value").alias("value"))
    whole_row = sums.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("i", "value"))).alias("all"))
    found = whole_row.select("place", F.col("all.value").alias("values")).orderBy("place").collect()
    return np.array([row["values"] for row in found], columns)


def _dimension(vectors: DataFrame) -> int:
    """The most frequent length of usable vectors, of equally frequent ones the largest."""
    counts = vectors.where(usable(F.col("vector"))).groupBy(F.size("vector").alias("size")).count()
    found = counts.orderBy(F.desc("count"), F.desc("size")).first()
    return found["size"] if found else 0


def _sums(vectors: DataFrame, dimension: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Number of vectors; sum, least and largest of each dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n, sums = 0, np.zeros(dimension, np.int64)
        low, high = np.full(dimension, np.iinfo(np.int64).max), np.full(dimension, np.iinfo(np.int64).min)
        for _, x in _blocks(batches, dimension):
            n += len(x)
            sums += x.sum(axis=0)
            low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
        if n:
            yield {"n": [n] * dimension, "place": np.arange(dimension), "sum": sums, "low": low, "high": high}

    parts = map_batches(vectors, work, "n long, place int, sum long, low long, high long")
    total = parts.groupBy("place").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.min("low").alias("low"), F.max("high").alias("high"))
    rows = total.orderBy("place").collect()
    columns = (np.array([row[name] for row in rows], np.int64) for name in ("sum", "low", "high"))
    return rows[0]["n"], *columns


def _scatter(vectors: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Sum over the vectors of the products of their entries, centred before multiplying."""
    dimension, mean = len(sums), _mean(n, sums)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        scatter, met = np.zeros((dimension, dimension)), False
        for _, x in _blocks(batches, dimension):
            z = centred(x, mean)
            scatter += z.T @ z
            met = True
        if met:
            yield {"place": np.arange(dimension), "values": _lists(scatter, pa.float64())}

    return _total(map_batches(vectors, work, "place int, values array<double>"), "float64")


def _mean(n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mean as its whole part and the rest, so that nothing is lost when it is taken away."""
    base = sums // n
    return base, (sums - base * n) / n


def centred(x: np.ndarray, mean: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return (x - mean[0]).astype(np.float64) - mean[1]


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Rows of a matrix as lists."""
    flat = pa.array(np.ascontiguousarray(values).reshape(-1), kind)
    return pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], flat)


def pivoted_cholesky(matrix: np.ndarray, tolerance: float = NO_VARIANCE) -> tuple[np.ndarray, np.ndarray]:
    """``(factor, order)`` with ``factor @ factor.T`` equal to the matrix in that order.

    The largest rest of the diagonal comes next each time, so the factor's columns fall in
    size and it ends where nothing but rounding is left: a column per rank, lower triangular.
    """
    rest = np.array(matrix, np.float64)
    n = len(rest)
    order, factor = np.arange(n), np.zeros((n, n))
    floor = tolerance * rest.diagonal().max(initial=0)
    for k in range(n):
        at = k + int(np.argmax(rest.diagonal()[k:]))
        if rest[at, at] <= floor:
            return factor[:, :k], order
        if at != k:
            swap, places = [at, k], [k, at]
            rest[places] = rest[swap]
            rest[:, places] = rest[:, swap]
            factor[places], order[places] = factor[swap], order[swap]
        factor[k:, k] = rest[k:, k] / np.sqrt(rest[k, k])
        rest[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def jacobi_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor's columns turned, two by two, until all are at right angles to each other.

    A sweep pairs every column with every other in rounds of disjoint pairs, so a round is one
    operation on arrays. Turning from the right leaves ``factor @ factor.T`` as it is.
    """
    rank = factor.shape[1]
    width = rank + rank % 2
    turned = np.zeros((factor.shape[0], width))
    turned[:, :rank] = factor
    seats = np.arange(width)
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(width - 1):
            left, right = seats[: width // 2], seats[width // 2 :][::-1]
            a, b = turned[:, left], turned[:, right]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            size = np.sqrt(aa * bb)
            turn = np.abs(ab) > np.finfo(float).eps * size
            worst = max(worst, float((np.abs(ab)[turn] / size[turn]).max(initial=0)))
            half = np.where(turn, bb - aa, 1) / np.where(turn, 2 * ab, 1)
            t = np.where(turn, np.copysign(1, half) / (np.abs(half) + np.hypot(half, 1)), 0)
            c = 1 / np.sqrt(1 + t * t)
            turned[:, left], turned[:, right] = c * a - c * t * b, c * t * a + c * b
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if worst <= 4 * np.finfo(float).eps:
            break
    return turned[:, :rank]


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a covariance, as many as its rank."""
    factor, order = pivoted_cholesky(matrix)
    turned = jacobi_columns(factor)
    norms = np.sqrt((turned * turned).sum(axis=0))
    falling = np.argsort(-norms, kind="stable")
    vectors = np.empty_like(turned)
    vectors[order] = turned
    return norms[falling] ** 2, (vectors / np.where(norms > 0, norms, 1))[:, falling]


def fit_whitening(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> Whitening | None:
    """The model of all usable vectors; None where none of them differ, as in an empty table.

    Vectors that are null or hold a null or non-finite entry are left out, and so are those of
    another length than most: they have no entry for some dimension. Equal vectors count each.
    """
    vectors = embeddings.select(F.col(f"`{vector}`").alias("vector"))
    dimension = _dimension(vectors)
    if not dimension:
        return None
    vectors = vectors.where(usable(F.col("vector"), dimension))
    n, sums, low, high = _sums(vectors, dimension)
    scatter = _scatter(vectors, n, sums)
    values, directions = eigen(scatter)
    kept = min(components, len(values))
    if not kept:
        return None
    width = [max(abs(n * int(a) - int(s)), abs(n * int(b) - int(s))) for a, b, s in zip(low, high, sums)]
    return Whitening(
        n, sums, directions[:, :kept], values[:kept] / n, values[:kept] / scatter.trace(), sum(w * w for w in width)
    )


def whiten(embeddings: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """``row`` (a struct of all columns but the vector), ``deviation`` and ``whitened`` per usable
    vector of the model's length: one number per component.

    ``deviation`` is the sum of ``(n * x - sum) ** 2`` over the dimensions: a long where every row's fits,
    else decimal(38, 0); beyond that an error. Repeated rows and null keys stay rows; further
    columns may have any name.
    """
    dimension, n, sums = model.dimension, model.n, model.sums
    mean, project = _mean(n, sums), model.directions / np.sqrt(model.variances)
    others = [F.col(f"`{c}`") for c in embeddings.columns if c != vector]
    row = F.struct(*others) if others else F.lit(None).cast("int")
    named = embeddings.select(row.alias("row"), F.col(f"`{vector}`").alias("vector"))
    fits = model.largest < 2**63
    if model.largest >= 10**38:
        raise OverflowError("deviations of these vectors do not fit 38 digits")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, x in _blocks(batches, dimension):
            if fits:
                deviation = pa.array(((n * x - sums) ** 2).sum(axis=1))
            else:
                wide = (n * x.astype(object) - sums.astype(object)) ** 2
                deviation = pa.array([int(v) for v in wide.sum(axis=1)], pa.decimal128(38, 0))
            whitened = centred(x, mean) @ project
            yield {"row": batch.column("row"), "deviation": deviation, "whitened": _lists(whitened, pa.float64())}

    kind = "long" if fits else "decimal(38,0)"
    rows = named.where(usable(F.col("vector"), dimension))
    schema = rows.select("row", F.lit(None).cast(kind).alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"))
    return map_batches(rows, work, schema.schema)


def identity_error(whitened: DataFrame) -> float:
    """The largest entry of the covariance of ``whitened``, less the identity; one pass."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("whitened").flatten().to_numpy(zero_copy_only=False)
            w = flat.reshape(batch.num_rows, -1)
            # A column of ones carries the sums and the count along.
            w = np.column_stack([w, np.ones(len(w))])
            total = w.T @ w if total is None else total + w.T @ w
        if total is not None:
            yield {"place": np.arange(len(total)), "values": _lists(total, pa.float64())}

    total = _total(map_batches(whitened.select("whitened"), work, "place int, values array<double>"), "float64")
    n, mean = total[-1, -1], total[-1, :-1] / total[-1, -1]
    covariance = total[:-1, :-1] / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(len(mean))).max())


def whitened_rows(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: ``row``, ``component`` from 1, ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``.

    Where no vector differs from another (an empty table, one vector) there is no component and no
    row; with fewer directions of any variance than ``components`` there are as many as those. See
    :func:`fit_whitening` and :func:`whiten` for vectors left out and for awkward rows.
    """
    model = fit_whitening(embeddings, components, vector)
    if model is None:
        others = [F.col(f"`{c}`") for c in embeddings.columns if c != vector]
        row = F.struct(*others) if others else F.lit(None).cast("int")
        none = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        return embeddings.where(F.lit(False)).select(
            row.alias("row"), *[F.lit(None).cast(kind).alias(name) for name, kind in map(str.split, none.split(", "))]
        )
    found = whiten(embeddings, model, vector)
    error = identity_error(found)
    shares = F.array(*[F.lit(float(share)) for share in model.explained])
    each = found.select("row", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return each.select(
        "row", (F.col("_at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
