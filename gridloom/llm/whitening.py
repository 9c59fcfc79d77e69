"""Whitening of embeddings by a randomised range finder with Rayleigh-Ritz components.

The covariance is never formed unless it has to be: a pass over all centred rows multiplies it with
a thin orthonormal basis. The first basis is random, with some columns more than components are asked
for; each pass gives Ritz pairs and their residuals, and the product is the basis of the next pass.
Where the residuals do not fall fast enough for double precision, the basis is expanded to the full
dimension, and one more pass makes Rayleigh-Ritz exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import usable
from .common import by_batch, cut
from .moments import by_length, centred, count_and_sums, deviations, summed
from .topk import quantised

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Whitening:
    """The fit of one vector length: n distinct vectors, their sums, unit components as columns, their eigenvalues, the trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    passes: int = 0
    expanded: bool = False

    @property
    def scales(self) -> np.ndarray:
        """1 / sqrt(e), not a number where a component has no variance but rounding."""
        floor = len(self.sums) * np.finfo(float).eps * self.trace
        return np.where(self.eigenvalues > floor, 1 / np.sqrt(np.maximum(self.eigenvalues, np.finfo(float).tiny)), np.nan)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.components * self.scales


@dataclass
class Search:
    """The range finder's state for one vector length between two passes."""

    n: int
    sums: np.ndarray
    basis: np.ndarray
    last: float = math.inf  # largest residual, in units of what is allowed, of the pass before

    @property
    def full(self) -> bool:
        return self.basis.shape[1] == len(self.sums)


def orthonormal(start: np.ndarray, columns: int, seed: int) -> np.ndarray:
    """An orthonormal basis of `columns` columns that begins with the range of start and goes on at random."""
    more = np.random.default_rng([seed, len(start), columns]).standard_normal((len(start), columns - start.shape[1]))
    return np.linalg.qr(np.hstack([start, more]))[0]


def ritz(basis: np.ndarray, product: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The k leading Ritz values, their vectors, and the largest residual as a share of the vector's distance to other values."""
    small = basis.T @ product
    values, inner = np.linalg.eigh((small + small.T) / 2)
    values, inner = values[::-1], inner[:, ::-1]
    vectors = basis @ inner
    apart = np.abs(np.diff(values)) if len(values) > 1 else np.array([abs(values[0])])
    gaps = np.minimum(np.concatenate([[np.inf], apart])[: len(values)], np.concatenate([apart, [np.inf]])[: len(values)])[:k]
    residual = np.linalg.norm(product @ inner[:, :k] - vectors[:, :k] * values[:k], axis=0)
    return values[:k], vectors[:, :k], float((residual / np.maximum(gaps, np.finfo(float).tiny)).max())


def fit_whitening(distinct: DataFrame, k: int = 4, oversampling: int = 8, most_passes: int = 8, precision: float = 1e-12, seed: int = 11) -> dict[int, Whitening]:
    """Vector length -> Whitening of the rows (v array<long>) of distinct, which is read once a pass.

    precision: the largest residual of a component as a share of its eigenvalue's distance to the
    others, which bounds the component's error. Passes beyond most_passes, or whose residuals fall
    too slowly to get there by then, are replaced by one pass with a full basis.
    """
    totals = summed(distinct, count_and_sums, exact=True)
    open_ = {}
    for size, total in totals.items():
        if size:
            width = min(size, k + oversampling)
            open_[size] = Search(int(total[0]), total[1:], orthonormal(np.zeros((size, 0)), width, seed))
    done: dict[int, Whitening] = {}
    context = distinct.sparkSession.sparkContext
    for number in range(1, most_passes + 2):
        if not open_:
            break
        shared = context.broadcast(open_)

        def multiply(x: np.ndarray) -> np.ndarray:
            """The centred rows' share of covariance times basis, then of the trace."""
            if x.shape[1] not in shared.value:
                return np.zeros(0)
            s = shared.value[x.shape[1]]
            c = centred(x, s.n, s.sums)
            return np.concatenate([(c.T @ (c @ s.basis)).ravel(), [float((c * c).sum())]])

        for size, total in summed(distinct, multiply).items():
            s = open_.get(size)
            if s is None:
                continue
            product, trace = total[:-1].reshape(size, -1) / s.n, total[-1] / s.n
            values, vectors, left = ritz(s.basis, product, k)
            left /= precision
            if s.full or left <= 1:
                done[size] = Whitening(s.n, s.sums, vectors, np.maximum(values, 0), trace, number, s.full and size > k + oversampling)
                del open_[size]
                continue
            rate = left / s.last  # zero after the first pass, which tells nothing yet
            slow = rate >= 1 or rate > 0 and math.log(left) / -math.log(rate) > most_passes - number
            columns = size if slow or number >= most_passes else s.basis.shape[1]
            open_[size] = Search(s.n, s.sums, orthonormal(product, columns, seed), left)
        shared.unpersist()
    return done


def identity_error(distinct: DataFrame, fits: dict[int, Whitening]) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, over all rows and lengths."""
    shared = distinct.sparkSession.sparkContext.broadcast(fits)

    def products(x: np.ndarray) -> np.ndarray:
        if x.shape[1] not in shared.value:
            return np.zeros(0)
        w = np.nan_to_num(shared.value[x.shape[1]].whiten(x))
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    worst = 0.0
    for size, total in summed(distinct, products).items():
        if size in fits:
            fit, k = fits[size], fits[size].components.shape[1]
            mean, kept = total[:k] / fit.n, np.isfinite(fit.scales)
            error = total[k:].reshape(k, k) / fit.n - np.outer(mean, mean) - np.eye(k)
            worst = max(worst, float(np.abs(error[np.ix_(kept, kept)]).max(initial=0)))
    return worst


def exact_deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """sum((n * x - sums)^2) of each row, exact; None where it needs more than 64 bits."""
    d = deviations(x, n, sums)
    if d.dtype != object and d.shape[1] * max(1, int(d.max(initial=0)), -int(d.min(initial=0))) ** 2 < 1 << 63:
        return (d * d).sum(axis=1).tolist()
    return [total if total < 1 << 63 else None for total in (d.astype(object) ** 2).sum(axis=1)]


def whiten(vectors: DataFrame, k: int = 4, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", oversampling: int = 8, most_passes: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: k rows for each usable row.

    Components become floor(scale * c) first. The fit takes each distinct vector once; it reads all of
    them in every pass. A component's sign is arbitrary but one for all rows.

    Rows whose vector is null or empty or holds null or non-finite entries have no result. Repeated rows
    and equal vectors are returned as often as they occur and count once in the fit; a null id is
    returned as null. Vectors of different lengths are fitted apart, each with its own n; identity_error
    is the largest of all. Vectors shorter than k have as many components as entries. A component
    without variance (one distinct vector, constant entries) has whitened null and explained 0; a
    deviation beyond 64 bits is null. An empty table gives no rows. Extra columns are not read.
    """
    found = vectors.filter(usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col), scale).alias("v"))
    rows = cut(found)
    distinct = cut(rows.select("v").distinct())
    fits = fit_whitening(distinct, k, oversampling, most_passes)
    error = identity_error(distinct, fits)
    shared = vectors.sparkSession.sparkContext.broadcast(fits)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for at, x in by_length(batch.column(1)):
            fit = shared.value[x.shape[1]]
            width, white = fit.components.shape[1], fit.whiten(x)
            explained = np.where(np.isfinite(fit.scales), fit.eigenvalues / fit.trace if fit.trace else 0.0, 0.0)
            deviation = pa.array(exact_deviation(x, fit.n, fit.sums), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), width)))
            parts.append([
                batch.column(0).take(pa.array(np.repeat(at, width))), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * width, fit.n)), deviation,
                pa.array(white.ravel(), mask=np.isnan(white.ravel())), pa.array(np.tile(explained, len(x))),
            ])
        columns = [pa.concat_arrays(c) for c in zip(*parts)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(columns[0]), error))], [c.split()[0] for c in RESULT.split(", ")])

    return rows.mapInArrow(by_batch(run), RESULT)
