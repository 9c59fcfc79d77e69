"""Connected components of an edge table, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _with_minimum(edges: DataFrame) -> DataFrame:
    """u, v, m: every edge with the smallest of u and its neighbours.

    A node with a huge neighbourhood is pre-aggregated for its minimum, and since the minima are
    written down the join back has exchanges of its own, so that adaptive execution splits the rows
    of such a node over tasks.
    """
    least = cut(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return edges.join(least, "u")


def _edges(joined: DataFrame, u: str, v: str) -> DataFrame:
    return joined.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u <> v")


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(u, v) long pairs -> (node, root), root being the smallest node of the component.

    A round hangs the larger neighbours of every node on its smallest one (large star), then all
    smaller neighbours and the node itself (small star); edges run from larger to smaller nodes.
    Rounds go on until the edge set no longer changes. Every step is written to the checkpoint
    folder, so a lost executor costs one step at most. No edges: no rows.
    """
    pairs = cut(_edges(edges.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")), "a", "b").distinct())
    seen = None
    for _ in range(most_rounds):
        large = cut(_edges(_with_minimum(pairs.unionByName(_edges(pairs, "v", "u"))).filter("v > u"), "v", "m").distinct())
        small = _with_minimum(large)
        pairs = cut(_edges(small, "v", "m").unionByName(_edges(small, "u", "m")).distinct())
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return _named(pairs, "u").unionByName(_named(pairs, "v").distinct())


def _named(pairs: DataFrame, node: str) -> DataFrame:
    return pairs.select(F.col(node).alias("node"), F.col("v").alias("root"))
