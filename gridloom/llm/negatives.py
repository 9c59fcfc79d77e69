"""Hard-negative mining with early discards on a rotated basis.

All rows are seen on the principal axes of the table, an orthogonal rotation that leaves inner products
as they are. Products of a block of anchors and a block of rows are added up axis by axis, the strongest
first; what is left cannot exceed the product of the residual norms, and with some slack for rounding
that bounds every score from both sides. Pairs whose bounds miss the windows of their anchor, or what it
has found already, are discarded before the rest of their axes is read; survivors are settled by integer products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .blocks import matrix, usable
from .common import cut
from .moments import summed
from .topk import quantised

LOW, HIGH = -(1 << 62), 1 << 62
BROADCAST_GROUPS = 200_000  # groups with two numbers each; how they are joined, not which
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def principal_axes(rows: DataFrame) -> dict[int, np.ndarray]:
    """Vector length -> orthogonal matrix whose columns are the axes of the second moment of all rows (v), strongest first."""
    moments = summed(rows, lambda x: (x.astype(np.float64).T @ x.astype(np.float64)).ravel())
    axes = {}
    for size, total in moments.items():
        total = total.reshape(size, size)
        axes[size] = np.linalg.eigh(total / max(1.0, float(np.abs(total).max(initial=0))))[1][:, ::-1]
    return axes


def stages(dimension: int) -> list[int]:
    """How many axes have been read at each look at the bounds: a quarter, a half, three quarters, seven eighths, all."""
    return sorted({max(1, dimension * part // 8) for part in (2, 4, 6, 7)} | {dimension})


class Rotated:
    """Rows on the axes, with the norm of what is left after each stage."""

    def __init__(self, rows: np.ndarray, axes: np.ndarray):
        self.values = rows.astype(np.float64) @ axes
        tail = np.sqrt(np.cumsum((self.values**2)[:, ::-1], axis=1)[:, ::-1])
        ends = stages(axes.shape[0])
        self.rest = [tail[:, e] if e < tail.shape[1] else np.zeros(len(rows)) for e in ends]
        self.norm = tail[:, 0] if tail.shape[1] else np.zeros(len(rows))


def rounding(axes: np.ndarray) -> float:
    """A share of the product of two norms that no rounding of a rotated product exceeds."""
    d = len(axes)
    return 16 * d * np.finfo(float).eps + d * float(np.abs(axes.T @ axes - np.eye(d)).max(initial=0))


def windowed_top(queries: np.ndarray, lows: np.ndarray, highs: np.ndarray, rows: np.ndarray, ids: np.ndarray, apart: np.ndarray, axes: np.ndarray, k: int, strip: int = 1024, counts: list | None = None):
    """(query, window, row, score): for each window of a query the k largest integer products with rows that it admits.

    lows, highs: the windows, inclusive, one column each; a window with low > high is none. apart: which
    pairs of a query and a row take no part. Ties go to smaller ids. counts collects (pairs, pairs left
    after the axes were read in part, integer products), for tests.
    """
    n, windows = lows.shape
    best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    needed = np.where(lows <= highs, lows, HIGH).astype(np.float64)
    most = np.where(lows <= highs, highs, LOW).max(axis=1, initial=LOW).astype(np.float64)
    q, slack, ends = Rotated(queries, axes), rounding(axes), stages(len(axes))
    wide = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1] >= 2**62
    for at in range(0, len(rows), strip):
        part, own = Rotated(rows[at : at + strip], axes), ids[at : at + strip]
        score = np.zeros((n, len(own)))
        alive = ~apart[:, at : at + strip]
        pairs, first = int(alive.sum()), 0
        least = needed.min(axis=1, initial=HIGH)
        for stage, end in enumerate(ends):
            if 8 * alive.sum() > alive.size:
                score += q.values[:, first:end] @ part.values[:, first:end].T
            else:
                a, b = np.nonzero(alive)
                for lo in range(0, len(a), 65_536):
                    i, j = a[lo : lo + 65_536], b[lo : lo + 65_536]
                    score[i, j] += np.einsum("ij,ij->i", q.values[i, first:end], part.values[j, first:end])
            bound = q.rest[stage][:, None] * part.rest[stage][None, :] + slack * q.norm[:, None] * part.norm[None, :] + 1e-9
            alive &= (score + bound >= least[:, None]) & (score - bound <= most[:, None])
            first = end
            if counts is not None and stage == len(ends) - 2:
                partly = int(alive.sum())
        products = 0
        for i in np.flatnonzero(alive.any(axis=1)):
            near = np.flatnonzero(alive[i])
            room = bound[i, near]
            keep = np.zeros(len(near), bool)
            for w in range(windows):
                if lows[i, w] <= highs[i, w]:
                    fits = (score[i, near] + room >= needed[i, w]) & (score[i, near] - room <= highs[i, w])
                    sure = fits & (score[i, near] - room >= lows[i, w]) & (score[i, near] + room <= highs[i, w])
                    if sure.sum() > k:  # k rows of this strip have a score of `floor` or more
                        floor = np.partition((score[i, near] - room)[sure], -k)[-k]
                        fits &= score[i, near] + room >= floor
                    keep |= fits
            near = near[keep]
            products += len(near)
            settled = (rows[at + near].astype(object) if wide else rows[at + near]) @ (queries[i].astype(object) if wide else queries[i])
            for w in range(windows):
                inside = (settled >= lows[i, w]) & (settled <= highs[i, w])
                if inside.any():
                    known, score_known = best.get((i, w), (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    rows_here, scores = np.concatenate([known, at + near[inside]]), np.concatenate([score_known, settled[inside]])
                    order = np.lexsort((ids[rows_here], -scores))[:k]
                    best[i, w] = rows_here[order], scores[order]
                    if len(order) == k:
                        needed[i, w] = max(needed[i, w], float(scores[order[-1]]))
        if counts is not None:
            counts.append((pairs, partly if len(ends) > 1 else pairs, products))
    found = [(i, w, r, s) for (i, w), (rr, ss) in best.items() for r, s in zip(rr.tolist(), ss.tolist())]
    return tuple(np.array(c, np.int64) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 4


def _blocks(rows: DataFrame, asked: DataFrame, key: list[str], data_rows: int, query_rows: int) -> tuple[DataFrame, DataFrame]:
    """rows and asked with `block` and `bin`: every row of a key meets every query of it in one pair of bounded blocks."""
    sizes = rows.groupBy(*key).agg(F.ceil(F.count("*") / data_rows).cast("int").alias("blocks"))
    plan = cut(asked.groupBy(*key).agg(F.ceil(F.count("*") / query_rows).cast("int").alias("bins")).join(sizes, key))
    plan = F.broadcast(plan) if plan.count() <= BROADCAST_GROUPS else plan
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n, *of: F.pmod(F.xxhash64(*of), F.col(n)).cast("int")
    left = rows.join(plan, key).withColumn("block", own("blocks", "vec_id", "v")).withColumn("bin", numbers("bins")).drop("bins", "blocks")
    right = asked.join(plan, key).withColumn("bin", own("bins", "vec_id", "v")).withColumn("block", numbers("blocks")).drop("bins", "blocks")
    return left, right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own, as both sides come from one table


def hard_negatives(vectors: DataFrame, anchors: Column, k: int = 10, positives: int = 5, least_percent: int = 30, most_percent: int = 90, scale: int = 256, id_col: str = "vec_id", label: Column | None = None, vector_col: str = "embedding", data_rows: int = 8192, query_rows: int = 512) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchors` says which rows are anchors; an anchor's positives are the `positives` other rows of its
    label with the largest integer products floor(scale * x), ties to smaller ids. For each of them the
    k rows of another label with the largest products between least_percent and most_percent per cent of the
    positive's are returned, ties to smaller ids.

    Positives are searched among the rows of one label, negatives among all; both are cut into blocks of
    about data_rows rows by a hash of id and vector, so a label may hold any share of the rows. The basis
    is that of all rows. Rows without a label, id or vector, with an empty one or a null or non-finite component
    take no part; vectors of different lengths are never compared. Repeated rows of one id, label and
    vector count once; different rows of one id are rows of their own, but never each other's positive.
    An anchor without positives, a positive without a negative in its window, an empty
    table: no rows. Extra columns are not read.
    """
    label = F.col("label") if label is None else label
    read = vectors.filter(usable(F.col(vector_col)) & label.isNotNull() & F.col(id_col).isNotNull())
    read = read.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), quantised(F.col(vector_col), scale).alias("v"), F.coalesce(anchors, F.lit(False)).alias("asked"))
    rows = cut(read.groupBy("vec_id", "label", "v").agg(F.max("asked").alias("asked")).withColumn("size", F.size("v")))
    axes = rows.sparkSession.sparkContext.broadcast(principal_axes(rows.select("v")))
    asked, data = rows.filter("asked").drop("asked"), rows.drop("asked")

    def same_label(left: pa.Table, right: pa.Table) -> pa.Table:
        qid, did, found = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy(), [np.zeros(0, np.int64)] * 4
        if len(qid) and len(did):
            q, d = (matrix(t.column("v"), np.int64) for t in (left, right))
            found = windowed_top(q, np.full((len(q), 1), LOW), np.full((len(q), 1), HIGH), d, did, qid[:, None] == did[None, :], axes.value[q.shape[1]], positives)
        places = left.column("place").to_numpy()
        return pa.table([places[found[0]], did[found[2]], found[3]], names=["place", "positive_id", "positive_score"])

    def other_label(left: pa.Table, right: pa.Table) -> pa.Table:
        own, did, found = left.column("label").to_numpy(), right.column("vec_id").to_numpy(), [np.zeros(0, np.int64)] * 4
        if len(own) and len(did):
            q, d = (matrix(t.column("v"), np.int64) for t in (left, right))
            lists = left.column("scores").to_pylist()
            lows, highs = (np.full((len(q), positives), x, np.int64) for x in (1, 0))
            for i, scores in enumerate(lists):
                for w, score in enumerate(scores):
                    lows[i, w], highs[i, w] = -(-least_percent * score // 100), most_percent * score // 100
            found = windowed_top(q, lows, highs, d, did, own[:, None] == right.column("label").to_numpy()[None, :], axes.value[q.shape[1]], k)
        places = left.column("place").to_numpy()
        return pa.table([places[found[0]], found[1], did[found[2]], found[3]], names=["place", "window", "negative_id", "negative_score"])

    asked = cut(asked.withColumn("place", F.monotonically_increasing_id()))  # names a row where ids repeat
    key = ["size", "label", "block", "bin"]
    left, right = _blocks(data, asked, ["size", "label"], data_rows, query_rows)
    near = right.groupBy(*key).cogroup(left.groupBy(*key)).applyInArrow(same_label, "place long, positive_id long, positive_score long")
    first = lambda by, score, other, n: near.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(F.desc(score), other))).filter(F.col("rank") <= n)
    pairs = first(["place"], "positive_score", "positive_id", positives)
    lists = pairs.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("pairs"))  # `positives` at most
    known = cut(asked.join(lists, "place").withColumn("scores", F.col("pairs.positive_score")))

    key = ["size", "block", "bin"]
    left, right = _blocks(data, known.drop("pairs"), ["size"], data_rows, query_rows)
    near = right.groupBy(*key).cogroup(left.groupBy(*key)).applyInArrow(other_label, "place long, window long, negative_id long, negative_score long")
    found = first(["place", "window"], "negative_score", "negative_id", k)
    pair = F.element_at("pairs", (F.col("window") + 1).cast("int"))
    named = found.join(known.select("place", F.col("vec_id").alias("anchor_id"), "pairs"), "place")
    return named.select("anchor_id", pair["positive_id"].alias("positive_id"), "rank", "negative_id", pair["positive_score"].alias("positive_score"), "negative_score")
