"""Pairs of bounded blocks: a query set against all rows of a vector table."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

BROADCAST_PAIRS = 1_000_000  # pairs of a part and a query block, 4 bytes each; how they are joined, not which


def usable(vector: Column) -> Column:
    """Whether a vector is there, has components and none is null or not finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector.cast("array<double>"), finite) & (F.size(vector) > 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dtype: type) -> np.ndarray:
    """Rows of an array column of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def query_bins(queries: DataFrame, query_rows: int) -> DataFrame:
    """queries with `bin`: a block of about query_rows queries of one home part, or of several small ones."""
    places, at, room = [], -1, 0
    for home, n in sorted(tuple(r) for r in queries.groupBy("home").count().collect()):  # one row per part
        if n >= query_rows:
            chunks, room = -(-n // query_rows), 0
            places.append((home, at + 1, chunks))
            at += chunks
            continue
        if n > room:
            at, room = at + 1, query_rows
        places.append((home, at, 1))
        room -= n
    table = F.broadcast(queries.sparkSession.createDataFrame(places, "home int, first int, chunks int"))
    return queries.join(table, "home").withColumn("bin", F.col("first") + F.pmod(F.xxhash64("query_id", "v"), F.col("chunks")).cast("int")).drop("first", "chunks", "home")


def block_search(data: DataFrame, queries: DataFrame, search: Callable, k: int, score: str, data_rows: int = 2048, query_rows: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best rows.

    data: vec_id, v, part. queries: query_id, v, home (its own part), parts (the parts it searches),
    least (a score below which rows are of no use, or null). Rows of both must be distinct, or the
    copies of one would fill the k places of its block. Every part is cut into blocks of about
    data_rows rows by a hash of id and vector, the queries into blocks of about query_rows by their
    home; a row goes only to the query blocks that search its part.
    search(query ids, query matrix, least scores, ids, matrix) sees one pair of blocks and returns arrays (query
    index, id, score) of at most k rows a query. So no group grows with the data, whichever vector or part is common.
    """
    asked = query_bins(queries, query_rows).withColumn("part", F.explode("parts")).drop("parts")
    sizes = data.groupBy("part").agg(F.ceil(F.count("*") / data_rows).cast("int").alias("blocks"))
    plan = cut(asked.groupBy("part").agg(F.collect_set("bin").alias("bins")).join(sizes, "part"))
    pairs = plan.agg(F.sum(F.size("bins"))).first()[0] or 0
    small = F.broadcast if pairs <= BROADCAST_PAIRS else lambda df: df
    rows = data.join(small(plan), "part").withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int")).withColumn("bin", F.explode("bins")).drop("bins", "blocks")
    asked = asked.join(small(plan.select("part", "blocks")), "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])  # columns of its own, as both sides may come from one table
    key = ["part", "block", "bin"]
    kind = pa.int64() if score == "long" else pa.float64()

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        qid, did = left.column("query_id").to_numpy(), right.column("vec_id").to_numpy()
        found = [], [], []
        if len(qid) and len(did):
            q, d = (matrix(t.column("v"), np.float64 if score == "double" else np.int64) for t in (left, right))
            least = left.column("least").to_numpy()
            at, ids, scores = search(qid, q, np.where(np.isnan(least), -np.inf, least), did, d)
            found = qid[at], ids, scores
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], kind)], names=["query_id", "vec_id", "score"])

    near = asked.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(pair, f"query_id long, vec_id long, score {score}")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
