"""Whitening components of integer vectors by shifted CholeskyQR.

The distinct vectors are stored once.  Every pass over them solves the centred
rows against the triangular factors found so far and adds up the Gram matrix
of the solved rows; its Cholesky factor joins the others.  The first factor is
shifted, so the Gram matrix of ill-conditioned rows has one; later passes bring
the solved rows to orthogonality.  The product R of the factors has the
singular values and right singular vectors of the centred rows.

Only d x d matrices and sums of d numbers reach the driver, d being the
dimension; partial matrices of the partitions are added up in tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import ship, stored

MAX_PASSES = 8
ORTHOGONAL = 1e-12  # largest entry of Gram - I that ends the passes
SLICE_VALUES = 1 << 20  # entries of a block of rows that is solved at once
_LOW_BITS = 32
_INT64 = (-(1 << 63), (1 << 63) - 1)


@dataclass(frozen=True)
class Whitening:
    """Sums and factors of the fit list, with its leading components."""

    n: int
    sums: list[int]
    factors: list[np.ndarray]  # triangular, in the order they were applied
    components: np.ndarray  # d x k, unit columns
    eigenvalues: np.ndarray  # k, falling; 0 where the rows do not vary
    trace: float
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([_scaled(x[:, j], self.n, s) / self.n
                                for j, s in enumerate(self.sums)]).astype(np.float64)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows projected on the components, at unit variance; NaN at variance 0."""
        scale = np.where(self.eigenvalues > 0, np.sqrt(self.eigenvalues), np.nan)
        return (self.centred(x) @ self.components) / scale


def _scaled(column: np.ndarray, n: int, total: int) -> np.ndarray:
    """n * x - S, in Python integers where 64 bits could overflow."""
    largest = max(abs(int(column.min(initial=0))), abs(int(column.max(initial=0))))
    if n * largest + abs(total) < 1 << 62:
        return column * n - total
    return column.astype(object) * n - total


def grid_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(vid, x): floor(scale * c) of every usable vector, as longs.

    Null vectors and vectors with a null or non-finite entry are left out.
    Entries beyond the range of a long take its nearest end.
    """
    c = F.col(vec_col).cast("array<double>")
    usable = F.col(vec_col).isNotNull() & F.forall(
        c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))

    return vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col(id_col).alias("vid"),
        # floor gives a long, cut at the range's ends
        F.transform(c, lambda v: F.floor(v * F.lit(float(scale)))).alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of ``dim`` longs; a shorter vector counts as 0 where it ends."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(np.asarray(column.offsets))
    if (lengths == dim).all():
        return flat.reshape(len(column), dim)
    out = np.zeros((len(column), dim), dtype=np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    at = np.arange(flat.size) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = flat
    return out


def _slices(batches: Iterator[pa.RecordBatch], column: str, dim: int) -> Iterator[np.ndarray]:
    step = max(1, SLICE_VALUES // max(1, dim))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield _matrix(batch.column(batch.schema.get_field_index(column)).slice(start, step),
                          dim)


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverse of every factor, by forward substitution."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(r.shape[0]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Row count and exact sum of every dimension."""

    def add(batches):
        n, total = 0, [0] * dim
        for x in _slices(batches, "x", dim):
            n += len(x)
            high = (x >> _LOW_BITS).sum(0)
            low = (x & ((1 << _LOW_BITS) - 1)).sum(0)
            total = [t + (int(h) << _LOW_BITS) + int(lo) for t, h, lo in zip(total, high, low)]
        if n:
            yield pa.RecordBatch.from_pydict({
                "at": pa.array(range(-1, dim), pa.int32()),
                "total": pa.array([str(t) for t in [n, *total]], pa.string())})

    rows = (fit.mapInArrow(add, "at int, total string").groupBy("at")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    by_at = {r["at"]: int(r["total"]) for r in rows}
    return by_at.get(-1, 0), [by_at.get(j, 0) for j in range(dim)]


def _gram(fit: DataFrame, dim: int, width: int,
          rows_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows x of r r' with r = rows_of(x), ``width`` numbers long.

    A partition gives one partial matrix, as ``width`` rows; these are dealt by
    row number and added up in tasks, so the driver gets one matrix.
    """

    def partial(batches):
        total = np.zeros((width, width))
        for x in _slices(batches, "x", dim):
            r = rows_of(x)
            total += r.T @ r
        if total.any():
            yield _rows(dict(enumerate(total)))

    def add_up(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, values in zip(batch.column(0).to_pylist(), batch.column(1)):
                row = np.asarray(values.values)
                total[at] = total[at] + row if at in total else row
        if total:
            yield _rows(total)

    schema = "at int, entries array<double>"
    out = np.zeros((width, width))
    for r in (fit.mapInArrow(partial, schema).repartition("at")
              .mapInArrow(add_up, schema).collect()):
        out[r["at"]] = r["entries"]
    return (out + out.T) / 2


def _rows(matrix: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(matrix), pa.int32()),
         pa.array([row.tolist() for row in matrix.values()], pa.list_(pa.float64()))],
        ["at", "entries"])


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper triangular R with R'R = gram, plus a shift where it is needed."""
    dim = gram.shape[0]
    unit = np.finfo(np.float64).eps / 2
    scale = float(np.trace(gram))
    # sums are added in blocks, so the bound on rounding takes a block's rows
    shift = 11.0 * (dim * min(n, SLICE_VALUES) + dim * (dim + 1)) * unit * scale
    tries = [shift * 10.0**k for k in range(12)]
    for s in tries if shifted else [0.0, *tries]:
        try:
            return np.linalg.cholesky(gram + s * np.eye(dim)).T
        except np.linalg.LinAlgError:
            continue
    raise ArithmeticError("the Gram matrix holds values that are not finite")


def fit(vectors: DataFrame, k: int = 4) -> Whitening | None:
    """The leading ``k`` components of the distinct vectors of ``grid_vectors``.

    None if no vector has an entry.  The number of passes depends on the rows'
    conditioning only; rows that do not vary in some direction keep it at
    variance 0.
    """
    ship(vectors.sparkSession)
    distinct = stored(vectors.select("x").distinct(), "whitening-fit")
    dim = distinct.agg(F.max(F.size("x"))).first()[0]
    if not dim:
        return None
    # rows that differ only by zeros at the end are one row
    if distinct.agg(F.min(F.size("x"))).first()[0] < dim:
        padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x")))
        distinct = stored(distinct.select(padded.alias("x")).distinct(), "whitening-fit")
    n, sums = _sums(distinct, dim)
    model = Whitening(n, sums, [], np.zeros((dim, 0)), np.zeros(0), 0.0)
    factors: list[np.ndarray] = []
    trace = 0.0
    for _ in range(MAX_PASSES):
        done = list(factors)
        gram = _gram(distinct, dim, dim, lambda x: _solved(model.centred(x), done))
        if not factors:
            trace = float(np.trace(gram))
            if trace == 0:
                break
        else:
            off = float(np.abs(gram - np.eye(dim)).max())
            if off < ORTHOGONAL:
                break
            # rows without full rank never become orthogonal: stop at their best
            values = np.linalg.eigvalsh(gram)
            settled = np.minimum(np.abs(values - 1), np.abs(values)).max()
            if len(factors) >= 3 and settled < ORTHOGONAL:
                break
        factors.append(_factor(gram, n, shifted=not factors))
    k = min(k, dim)
    if not factors:
        model = Whitening(n, sums, [], np.eye(dim, k), np.zeros(k), 0.0)
        return model
    r = np.eye(dim)
    for factor in factors:
        r = factor @ r
    _, sigma, right = np.linalg.svd(r)
    # a variance that rounding alone explains is none
    sigma = np.where(sigma > sigma[0] * dim * np.finfo(np.float64).eps * 8, sigma, 0.0)
    model = Whitening(n, sums, factors, right[:k].T.copy(), (sigma[:k] ** 2) / n, trace / n)
    alive = int((model.eigenvalues > 0).sum())

    def with_one(x):
        return np.column_stack([np.ones(len(x)), model.whiten(x)[:, :alive]])

    moments = _gram(distinct, dim, alive + 1, with_one) / n
    mean = moments[0, 1:]
    covariance = moments[1:, 1:] - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(alive)).max())
    return Whitening(n, sums, factors, model.components, model.eigenvalues, model.trace, error)


def whiten(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error).

    One row per vector of ``grid_vectors`` and component, k of them or as many
    as there are dimensions; repeated rows give repeated rows and a null id
    stays.  ``deviation`` is the exact sum of (n*x - S)^2, null where it exceeds
    a long.  A component of variance 0 has null for ``whitened`` and 0 for
    ``explained``; if the fit list has one row or does not vary at all,
    ``explained`` and ``identity_error`` are null.  No vectors: no rows.  Vectors
    shorter than the longest count as 0 where they end.
    """
    schema = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dim, k = model.components.shape
    share = ([e / model.trace for e in model.eigenvalues.tolist()] if model.trace > 0
             else [None] * k)

    def rows(batches):
        step = max(1, SLICE_VALUES // dim)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                piece = batch.slice(start, step)
                x = _matrix(piece.column(1), dim)
                z = model.whiten(x).ravel()
                yield pa.RecordBatch.from_arrays([
                    piece.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array([model.n] * (len(x) * k), pa.int64()),
                    pa.array([d for d in _deviation(x, model) for _ in range(k)], pa.int64()),
                    pa.array(z, mask=np.isnan(z)),
                    pa.array(share * len(x), pa.float64()),
                    pa.array([model.identity_error] * (len(x) * k), pa.float64())],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained",
                     "identity_error"])

    return vectors.select(F.col("vid").cast("long"), "x").mapInArrow(rows, schema)


def _deviation(x: np.ndarray, model: Whitening) -> list[int | None]:
    columns = [_scaled(x[:, j], model.n, s) for j, s in enumerate(model.sums)]
    largest = max((max(abs(int(c.min())), abs(int(c.max()))) for c in columns if len(c)),
                  default=0)
    if largest * largest * len(columns) < 1 << 62:
        return (np.column_stack(columns).astype(np.int64) ** 2).sum(1).tolist()
    totals = sum(c.astype(object) ** 2 for c in columns)
    return [t if t <= _INT64[1] else None for t in totals]
