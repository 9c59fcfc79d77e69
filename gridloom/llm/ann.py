"""Approximate nearest neighbours in learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts by spectral bisection, a small
softmax network learns to predict the part from the vector, every row is indexed under its most
probable part, and a query searches the several parts that the network finds most probable. Large
tables have parts of parts, so that a part does not grow with the data.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import block_search, matrix, usable
from .common import by_batch, cut


def neighbour_graph(points: np.ndarray, k: int) -> np.ndarray:
    """Symmetric 0/1 matrix of the k largest inner products of each point."""
    scores = points @ points.T
    np.fill_diagonal(scores, -np.inf)
    near = np.argpartition(-scores, k, axis=1)[:, :k] if len(points) > k else np.argsort(-scores, axis=1)[:, : len(points) - 1]
    graph = np.zeros(scores.shape, np.float32)
    np.put_along_axis(graph, near, 1, axis=1)
    return np.maximum(graph, graph.T)


def balanced_parts(graph: np.ndarray, levels: int, rng: np.random.Generator) -> np.ndarray:
    """Parts of equal size (within one) by repeated bisection at the median of the second eigenvector."""
    label = np.zeros(len(graph), np.int64)
    for _ in range(levels):
        new = label * 2
        for part in np.unique(label):
            inside = np.flatnonzero(label == part)
            if len(inside) < 2:
                continue
            own = graph[np.ix_(inside, inside)]
            degree = np.maximum(own.sum(axis=1), 1e-9)
            x = rng.standard_normal(len(inside))
            for _ in range(60):
                x = 0.5 * (x + own @ x / degree)
                x -= (x * degree).sum() / degree.sum()
                x /= np.linalg.norm(x) + 1e-12
            new[inside[np.argsort(x, kind="stable")[len(inside) // 2 :]]] += 1
        label = new
    return label


@dataclass
class Router:
    """One hidden layer and a softmax over parts; with `inner` routers, one for each part, over parts of parts. `probes` parts are searched."""

    weights: list[np.ndarray]
    probes: int
    inner: list[list[np.ndarray]] = field(default_factory=list)

    @staticmethod
    def log_softmax(points: np.ndarray, weights: list[np.ndarray]) -> np.ndarray:
        a, b, c, d = weights
        z = np.maximum(points @ a + b, 0) @ c + d
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def home(self, points: np.ndarray) -> np.ndarray:
        """The part of each point: the most probable one, level by level."""
        part = self.log_softmax(points, self.weights).argmax(axis=1)
        if not self.inner:
            return part
        wide = self.inner[0][3].shape[0]
        out = np.zeros(len(points), np.int64)
        for p in np.unique(part):
            at = np.flatnonzero(part == p)
            out[at] = p * wide + self.log_softmax(points[at], self.inner[p]).argmax(axis=1)
        return out

    def ranked(self, points: np.ndarray, most: int | None = None) -> np.ndarray:
        """Parts of each point, most probable first, at most `most` of them."""
        out = []
        for lo in range(0, len(points), 256):  # parts of parts are many
            own = points[lo : lo + 256]
            score = self.log_softmax(own, self.weights)
            if self.inner:
                score = np.concatenate([score[:, [p]] + self.log_softmax(own, w) for p, w in enumerate(self.inner)], axis=1)
            out.append(np.argsort(-score, axis=1, kind="stable")[:, :most].astype(np.int32))
        return np.concatenate(out) if out else np.zeros((0, most or 1), np.int32)


def train_router(points: np.ndarray, label: np.ndarray, parts: int, rng: np.random.Generator, hidden: int = 128, steps: int = 250) -> list[np.ndarray]:
    """Cross-entropy by Adam over the whole sample."""
    dim, target = points.shape[1], np.eye(parts)[label]
    weights = [rng.standard_normal((dim, hidden)) * (2 / dim) ** 0.5, np.zeros(hidden), rng.standard_normal((hidden, parts)) * hidden**-0.5, np.zeros(parts)]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    for step in range(1, steps + 1):
        a, b, c, d = weights
        inner = np.maximum(points @ a + b, 0)
        z = inner @ c + d
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        out = (p - target) / len(points)
        back = (out @ c.T) * (inner > 0)
        for i, g in enumerate([points.T @ back, back.sum(axis=0), inner.T @ out, out.sum(axis=0)]):
            g = g + 1e-4 * weights[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            weights[i] = weights[i] - 0.01 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return weights


def fit_parts(points: np.ndarray, levels: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Weights of a network that tells apart 2**levels balanced parts of the points' neighbour graph."""
    scale = float(np.sqrt((points**2).sum(axis=1).mean())) if len(points) else 1.0
    scaled = points / (scale or 1.0)
    if not len(points):
        scaled = np.zeros((1, points.shape[1]))
    weights = train_router(scaled, balanced_parts(neighbour_graph(scaled, 10), levels, rng), 2**levels, rng)
    weights[0] = weights[0] / (scale or 1.0)
    return weights


def probes_needed(router: Router, parts: int, fit: np.ndarray, asked: np.ndarray, k: int, recall: float) -> int:
    """The smallest number of parts that holds `recall` of the k nearest of `fit` for the points asked."""
    if not len(fit) or not len(asked):
        return parts
    home, reached, total = router.home(fit), np.zeros(parts), 0
    for lo in range(0, len(asked), 256):
        own = asked[lo : lo + 256]
        score = own @ fit.T
        score[(own**2).sum(axis=1)[:, None] + (fit**2).sum(axis=1)[None, :] - 2 * score <= 1e-12] = -np.inf  # the point itself
        near = np.argsort(-score, axis=1)[:, :k]
        place = np.argsort(router.ranked(own), axis=1)  # how many parts down each part stands
        depth = np.take_along_axis(place, home[near], axis=1)
        reached += np.bincount(depth.ravel(), minlength=parts)
        total += depth.size
    return min(parts, int(np.searchsorted(np.cumsum(reached) / total, recall)) + 1)


def part_levels(rows: int, part_rows: int) -> int:
    """Bisections that leave about part_rows to twice as many rows in a part: 4 (16 parts) to 14."""
    return int(np.clip(np.floor(np.log2(max(1, rows) / part_rows)), 4, 14))


def search_block(query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, id, score) of each query's k largest inner products in a block, itself left out; `least` is not used.

    The matrix product only preselects; scores are summed row by row, so equal vectors have equal
    scores and ties go to smaller ids.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    slack = 1e-9 * (1 + np.abs(rows).max(initial=0) * np.abs(queries).max(initial=0) * rows.shape[1])
    for lo in range(0, len(queries), 64):
        rough = queries[lo : lo + 64] @ rows.T
        rough[query_ids[lo : lo + 64, None] == ids[None, :]] = -np.inf
        kth = np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k else np.full(len(rough), -np.inf)
        for i, row in enumerate(rough):
            take = np.flatnonzero((row >= kth[i] - slack) & (row > -np.inf))
            score = (rows[take] * queries[lo + i]).sum(axis=1)
            first = np.lexsort((ids[take], -score))[:k]
            out.append((np.full(len(first), lo + i), ids[take][first], score[first]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _samples(rows: DataFrame, key: str, sample_rows: int) -> DataFrame:
    """key, bucket, v: one vector of each of sample_rows hash buckets of ids and key."""
    bucket = F.pmod(F.xxhash64(F.lit(11), "vec_id"), F.lit(sample_rows))
    return rows.groupBy(key, bucket.alias("bucket")).agg(F.min_by("v", F.xxhash64(F.lit(12), "vec_id", "v")).alias("v"))


def _fit_inner(sample: DataFrame, levels: int, dim: int, seed: int) -> dict[int, list[np.ndarray]]:
    """Part -> weights of the network over its own parts, each fitted in a task on the part's sample."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        points = matrix(table.sort_by("bucket").column("v"), np.float64)
        weights = fit_parts(points, levels, np.random.default_rng([seed, key[0].as_py()]))
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([pickle.dumps([w.astype(np.float32) for w in weights])])], names=["part", "weights"])

    fitted = sample.groupBy("part").applyInArrow(run, "part int, weights binary").collect()  # a row per part
    return {r.part: [w.astype(np.float64) for w in pickle.loads(r.weights)] for r in fitted}


def _homes(rows: DataFrame, router: Router, name: str) -> DataFrame:
    model = rows.sparkSession.sparkContext.broadcast(router)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        home = model.value.home(matrix(batch.column(1), np.float64)).astype(np.int32)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], [*batch.schema.names, name])

    return rows.mapInArrow(by_batch(run), f"vec_id long, v array<double>, asked boolean, {name} int")


def fit_router(rows: DataFrame, dim: int, total: int, k: int, recall: float, part_rows: int, sample_rows: int, seed: int = 5) -> Router:
    """A router over about total / part_rows parts of the rows (vec_id, v, asked), all of length dim.

    Up to 64 parts come from one network, fitted on at most sample_rows vectors; more come from two levels, each
    part of the first having a sample of at most sample_rows vectors and a network of its own.
    """
    rng, levels = np.random.default_rng(seed), part_levels(total, part_rows)
    picked = _samples(rows.withColumn("part", F.lit(0)), "part", sample_rows).orderBy("bucket").collect()  # at most sample_rows vectors
    points = np.array([r.v for r in picked], np.float64).reshape(-1, dim)
    held = np.arange(len(points)) % 8 == 0 if len(points) >= 64 else np.zeros(len(points), bool)
    fit, asked = points[~held], points[held] if held.any() else points
    outer = levels if levels <= 6 else (levels + 1) // 2
    router = Router(fit_parts(fit, outer, rng), 2**outer)
    if outer < levels:
        wide = 2 ** (levels - outer)
        inner = _fit_inner(_samples(_homes(rows, router, "part"), "part", sample_rows), levels - outer, dim, seed)
        empty = [np.zeros((dim, 1)), np.zeros(1), np.zeros((1, wide)), np.zeros(wide)]
        router.inner = [inner.get(p, empty) for p in range(2**outer)]
    router.probes = probes_needed(router, 2**levels, fit, asked, k, recall)
    return router


def nearest_in_partitions(vectors: DataFrame, queries: Column, k: int = 20, part_rows: int = 16_384, sample_rows: int = 4096, recall: float = 0.94, id_col: str = "vec_id", vector_col: str = "embedding", data_rows: int | None = None, query_rows: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k largest inner products found.

    Parts grow in number with the rows (part_rows to twice as many rows each, 16 parts at least and
    16,384 at most). A part is searched in blocks of data_rows rows, by default as many as hold 2**20
    components (8 MB), so that most parts are one block. Networks are fitted on samples of at most sample_rows vectors (one of each hash
    bucket of ids); every row is indexed under its most probable part, and a query searches as many
    parts as hold `recall` of the neighbours of points left out of the fit. One router serves one
    length, the most frequent one; the rows of each further length are a part of their own and searched in full.
    Vectors that are null, empty or zero or hold null or non-finite components take no part, nor do
    rows without an id. Repeated rows of one id and vector count once. No rows: no result.
    """
    v = F.col(vector_col).cast("array<double>")
    kept = vectors.filter(usable(F.col(vector_col)) & F.exists(v, lambda x: x != 0) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"))
    rows = cut(kept.groupBy("vec_id", "v").agg(F.max("asked").alias("asked")))
    lengths = {r.size: r["count"] for r in rows.groupBy(F.size("v").alias("size")).count().collect()}  # one row per vector length
    dim = max(sorted(lengths), key=lengths.get) if lengths else 1
    usual = rows.filter(F.size("v") == dim)
    router = fit_router(usual, dim, lengths.get(dim, 0), k, recall, part_rows, sample_rows)
    model = vectors.sparkSession.sparkContext.broadcast(router)

    def probe(batch: pa.RecordBatch) -> pa.RecordBatch:
        ranked = model.value.ranked(matrix(batch.column(1), np.float64), model.value.probes)
        parts = pa.ListArray.from_arrays(pa.array(np.arange(len(ranked) + 1, dtype=np.int32) * ranked.shape[1]), pa.array(ranked.ravel()))
        return pa.RecordBatch.from_arrays([*batch.columns, parts], ["vec_id", "v", "home", "parts"])

    placed = cut(_homes(usual, router, "home").unionByName(rows.filter(F.size("v") != dim).withColumn("home", -F.size("v"))))
    data = placed.select("vec_id", "v", F.col("home").alias("part"))
    inquiring = placed.filter("asked").select("vec_id", "v", "home")
    routed = inquiring.filter("home >= 0").mapInArrow(by_batch(probe), "vec_id long, v array<double>, home int, parts array<int>")
    asked = cut(routed.unionByName(inquiring.filter("home < 0").withColumn("parts", F.array("home"))).withColumnRenamed("vec_id", "query_id").withColumn("least", F.lit(None).cast("double")))
    search = lambda qid, q, least, did, d: search_block(qid, q, least, did, d, k)
    return block_search(data, asked, search, k, "double", data_rows or max(256, 2**20 // dim), query_rows)
