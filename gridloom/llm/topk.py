"""Exact top-k inner products by dual-tree search over cover trees."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .blocks import block_search, matrix, usable
from .common import by_batch, cut

LEAF = 48
FANOUT = 24


def most_product(centres, norm_a, radius_a, norm_b, radius_b):
    """What no inner product between points of two balls exceeds, from the product of their centres; a little more, for rounding."""
    most = centres + radius_a * norm_b + radius_b * norm_a + radius_a * radius_b
    return most + 1e-9 * (np.abs(most) + norm_a * norm_b + 1)


@dataclass
class Node:
    """A ball over rows lo..hi of the tree's order: all of them lie within radius of the centre."""

    centre: np.ndarray
    norm: float
    radius: float
    lo: int
    hi: int
    children: list[Node] = field(default_factory=list)


class CoverTree:
    """A cover tree of the rows of a matrix.

    A node's points lie within its radius of its centre, itself a point; its children's centres
    cover them at half that radius. Where more than FANOUT centres would be needed, the points left
    over share one child with the true radius, which keeps the bounds right on data that has no
    clusters at all.
    """

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.order: list[int] = []
        self.root = self._build(np.arange(len(points)), 0) if len(points) else None
        self.rows = np.array(self.order, np.int64)

    def _distances(self, rows: np.ndarray, centre: int) -> np.ndarray:
        difference = self.points[rows] - self.points[centre]
        return np.sqrt(np.einsum("ij,ij->i", difference, difference))

    def _build(self, rows: np.ndarray, centre: int) -> Node:
        away = self._distances(rows, centre)
        radius, lo = float(away.max()), len(self.order)
        node = Node(self.points[centre], float(np.linalg.norm(self.points[centre])), radius, lo, lo + len(rows))
        if len(rows) <= LEAF or radius == 0:
            self.order += rows.tolist()
            return node
        left, own = rows, centre
        while len(left):
            d = self._distances(left, own)
            near = d <= radius / 2
            if len(node.children) >= FANOUT or near.sum() == len(left) == len(rows):
                self.order += left.tolist()
                node.children.append(Node(self.points[own], float(np.linalg.norm(self.points[own])), float(d.max()), len(self.order) - len(left), len(self.order)))
                break
            node.children.append(self._build(left[near], own))
            left = left[~near]
            if len(left):
                own = int(left[np.argmax(d[~near])])
        return node


def dual_tree_search(query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, id, score) of each query's k largest integer inner products of `least` or more, ties to smaller ids, itself left out.

    A pair of nodes is pruned when the bound of its balls is below the worst kth score of the query
    node. Scores are exact integers: products that could leave the exact range of doubles are taken
    in 64-bit integers.
    """
    qt, dt = CoverTree(queries), CoverTree(rows)
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1] < 2**52
    q, d = queries[qt.rows], rows[dt.rows]
    if exact:
        q, d = q.astype(np.float64), d.astype(np.float64)
    qid, did = query_ids[qt.rows], ids[dt.rows]
    low = -(1 << 62)
    best = np.full((len(q), k), low)
    best_id = np.full((len(q), k), np.iinfo(np.int64).max)
    needed = np.maximum(least[qt.rows], low)

    def compare(a: Node, b: Node) -> None:
        scores = (q[a.lo : a.hi] @ d[b.lo : b.hi].T).astype(np.int64)
        worst = np.maximum(best[a.lo : a.hi, -1], needed[a.lo : a.hi])
        same = qid[a.lo : a.hi, None] == did[None, b.lo : b.hi]
        for i in np.flatnonzero(((scores >= worst[:, None]) & ~same).any(axis=1)):
            take = np.flatnonzero((scores[i] >= worst[i]) & ~same[i])
            s = np.concatenate([best[a.lo + i], scores[i, take]])
            n = np.concatenate([best_id[a.lo + i], did[b.lo + take]])
            first = np.lexsort((n, -s.astype(np.float64) if exact else -s))[:k]
            best[a.lo + i], best_id[a.lo + i] = s[first], n[first]

    todo = [(qt.root, dt.root)] if qt.root and dt.root else []
    while todo:
        a, b = todo.pop()
        if most_product(a.centre @ b.centre, a.norm, a.radius, b.norm, b.radius) < np.maximum(best[a.lo : a.hi, -1], needed[a.lo : a.hi]).min():
            continue
        if not a.children and not b.children:
            compare(a, b)
        elif b.children and (not a.children or b.radius >= a.radius):
            todo += sorted(((a, child) for child in b.children), key=lambda p: float(p[0].centre @ p[1].centre))
        else:
            todo += [(child, b) for child in a.children]
    at, slot = np.nonzero(best > low)
    return qt.rows[at], best_id[at, slot], best[at, slot]


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as integers."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * scale).cast("long"))


def covering_centres(sample: np.ndarray, most: int) -> np.ndarray:
    """At most `most` points of the sample, each the farthest from those before: the top level of a cover tree."""
    points = sample.astype(np.float64)
    centres, away = [points[0]], np.full(len(points), np.inf)
    while len(centres) < most:
        away = np.minimum(away, np.sqrt(((points - centres[-1]) ** 2).sum(axis=1)))
        if not away.max() > 0:
            break
        centres.append(points[int(away.argmax())])
    return np.array(centres)


@dataclass
class Balls:
    """Centres by vector length; ball numbers run through all lengths. A length that the sample lacks has one ball around zero."""

    centres: dict[int, tuple[int, np.ndarray]]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ball and distance from its centre of each row of a matrix."""
        first, centres = self.centres[points.shape[1]]
        square = (points**2).sum(axis=1)[:, None] - 2 * (points @ centres.T) + (centres**2).sum(axis=1)[None, :]
        ball = square.argmin(axis=1)
        return first + ball, np.sqrt(((points - centres[ball]) ** 2).sum(axis=1))


def _place(rows: DataFrame, balls: Balls) -> DataFrame:
    """Rows (vec_id, v, asked) with their ball and the distance from its centre."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = batch.column(1)
        sizes = np.diff(v.offsets.to_numpy())
        ball, away = np.zeros(len(sizes), np.int32), np.zeros(len(sizes))
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            ball[at], away[at] = balls.nearest(matrix(v.take(pa.array(at)), np.float64))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(ball), pa.array(away)], ["vec_id", "v", "asked", "ball", "away"])

    return rows.mapInArrow(by_batch(run), "vec_id long, v array<long>, asked boolean, ball int, away double")


def surviving_balls(groups: list, data: list, centres: dict[int, np.ndarray], worst: dict[int, int]) -> dict[int, list[int]]:
    """Query group -> balls that may hold a row at or above the group's worst kth score.

    groups, data: rows of (ball, radius). Only balls of the same vector length are pairs.
    """
    kept = {}
    for size in {len(c) for c in centres.values()}:
        own = [r for r in data if len(centres[r.ball]) == size]
        if not own:
            continue
        middle, radius = np.array([centres[r.ball] for r in own]), np.array([r.radius for r in own])
        norm = np.linalg.norm(middle, axis=1)
        for g in groups:
            if len(c := centres[g.ball]) == size:
                most = most_product(middle @ c, float(np.linalg.norm(c)), g.radius, norm, radius)
                kept[g.ball] = [own[i].ball for i in np.flatnonzero(most >= worst.get(g.ball, -np.inf))]
    return kept


def _first_balls(ball: int, data: list, centres: dict[int, np.ndarray], least_rows: int) -> list[int]:
    """The balls whose centres have the largest products with that of `ball`, as many as hold least_rows rows."""
    own = sorted((r for r in data if len(centres[r.ball]) == len(centres[ball])), key=lambda r: -float(centres[ball] @ centres[r.ball]))
    taken, total = [], 0
    for r in own:
        taken.append(r.ball)
        total += r.n
        if total >= least_rows:
            break
    return taken


def exact_top_k(vectors: DataFrame, queries: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", data_rows: int = 2048, query_rows: int = 512, ball_rows: int = 2048, most_balls: int = 1024, sample_rows: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k largest integer inner products with all other rows.

    `queries` says which rows are queries. Queries and rows are indexed together: the top of a cover
    tree, one ball for about ball_rows rows and at most most_balls, has centres from a sample of at
    most sample_rows vectors; all rows are placed in their balls, and the radii are those of all
    rows. The queries of a ball are a group. A group first searches one block of rows of the ball
    that its centre meets best; its worst kth score then discards pairs of a group and a ball by
    their radii, in a table of balls, before any vector moves. What is left is searched with cover
    trees of blocks. Blocks bound every task, so a ball may hold any share of the rows.

    Vectors that are null or empty or hold null or non-finite components take no part, nor do rows
    without an id; vectors of different lengths are never compared. Repeated rows of one id and
    vector count once. No queries or no rows: no result.
    """
    usable_rows = vectors.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    rows = usable_rows.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col), scale).alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"))
    sizes = {r.size: r["count"] for r in rows.groupBy(F.size("v").alias("size")).count().collect()}  # one row per vector length
    bucket = F.pmod(F.xxhash64(F.lit(13), "vec_id"), F.lit(sample_rows))
    picked = rows.groupBy(bucket.alias("bucket")).agg(F.min_by("v", F.xxhash64(F.lit(14), "vec_id", "v")).alias("v")).orderBy("bucket").collect()  # at most sample_rows vectors
    by_size, first = {}, 0
    for size in sorted(sizes):
        sample = np.array([r.v for r in picked if len(r.v) == size], np.float64)
        centres = covering_centres(sample, min(most_balls, -(-sizes[size] // ball_rows))) if len(sample) else np.zeros((1, size))
        by_size[size] = first, centres
        first += len(centres)
    balls = Balls(by_size)
    centre_of = {start + i: c for start, centres in by_size.values() for i, c in enumerate(centres)}

    distinct = rows.groupBy("vec_id", "v").agg(F.max("asked").alias("asked"))
    placed = cut(_place(distinct, balls))
    radii = placed.groupBy("ball").agg(F.count("*").alias("n"), F.max("away").alias("radius"), F.max(F.when(F.col("asked"), F.col("away"))).alias("asked_radius")).collect()  # one row per ball
    data_balls = [Row(ball=r.ball, radius=r.radius, n=r.n) for r in radii]
    groups = [Row(ball=r.ball, radius=r.asked_radius) for r in radii if r.asked_radius is not None]
    search = lambda qid, q, least, did, d: dual_tree_search(qid, q, least, did, d, k)
    data = placed.select("vec_id", "v", F.col("ball").alias("part"))
    asked = placed.filter("asked").select(F.col("vec_id").alias("query_id"), "v", F.col("ball").alias("home"))
    spark = vectors.sparkSession
    nothing = F.lit(None).cast("double")

    best = [(g.ball, _first_balls(g.ball, data_balls, centre_of, k + 1)) for g in groups]
    blocks = F.broadcast(spark.createDataFrame([(r.ball, -(-r.n // data_rows)) for r in data_balls], "part int, blocks int"))
    slice_ = data.join(blocks, "part").filter(F.pmod(F.xxhash64("v", "vec_id"), F.col("blocks")) == 0).drop("blocks")
    to_balls = lambda pairs: F.broadcast(spark.createDataFrame(pairs, "home int, parts array<int>"))  # noqa: E731  at most most_balls squared numbers
    found = block_search(slice_, asked.join(to_balls(best), "home").withColumn("least", nothing), search, k, "long", data_rows, query_rows)
    least = cut(found.filter(F.col("rank") == k).select("query_id", (F.col("score").cast("double") - F.abs("score") * 1e-15).alias("least")))  # a double rounds
    bounded = cut(asked.join(least, "query_id", "left"))
    worst = {r.home: r.worst for r in bounded.groupBy("home").agg(F.min(F.coalesce("least", F.lit(float("-inf")))).alias("worst")).collect()}  # one row per ball
    kept = surviving_balls(groups, data_balls, centre_of, worst)
    return block_search(data, bounded.join(to_balls(list(kept.items())), "home"), search, k, "long", data_rows, query_rows)
