"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is mapped to the bit counts of its 2-bit segments. The Manhattan distance of
two such vectors never exceeds the Hamming distance of the fingerprints. The coordinates fall into
`radius + groups` blocks; within the radius at least `groups` blocks agree in full, so fingerprints
that share the grid cell of some choice of blocks are the only candidates. Inside a cell the
Manhattan bound is applied first and the Hamming distance settles the rest.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_batch, cut, text_bytes, unused
from .components import connected_components

ODD_BITS = 0x5555555555555555


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 (seed 42) of the word shingles, repeats included; a text of fewer words is one shingle, one without words none."""
    words = text.lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    shingles = [b" ".join(s) for s in zip(*(words[i:] for i in range(width)))] or [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, 42) for s in shingles), np.uint64, len(shingles))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; none: zero."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """doc_id, digest (of the text), fp (the fingerprint's bits as a long). Null texts count as empty; extra columns are not read."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([majority(shingle_hashes(t, width)) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values)], ["doc_id", "digest", "fp"])

    body = text_bytes(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(body).alias("digest"), body.alias("body"))
    return rows.mapInArrow(by_batch(run), "doc_id long, digest long, fp long")


def block_masks(radius: int, agreeing: int = 3) -> list[int]:
    """Bit masks of every choice of `agreeing` blocks out of radius + agreeing blocks of whole segments."""
    n = radius + agreeing
    edges = [2 * round(32 * i / n) for i in range(n + 1)]
    blocks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(choice)) for choice in combinations(blocks, agreeing)]


def embedding(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, each in unary (00, 01, 11) in its own two bits.

    In unary the Manhattan distance of two vectors is the bit count of their XOR.
    """
    shifted, odd = F.shiftrightunsigned(fp, 1), F.lit(ODD_BITS)
    at_least_one, two = fp.bitwiseOR(shifted).bitwiseAND(odd), fp.bitwiseAND(shifted).bitwiseAND(odd)
    return at_least_one.bitwiseOR(F.shiftleft(two, 1))


def _local_edges(fps: np.ndarray, radius: int, strip: int = 512) -> list[tuple[int, int]]:
    """Edges that span every component of the fingerprints of one cell; never all pairs."""
    fps = np.unique(fps)
    u, odd, one = fps.view(np.uint64), np.uint64(ODD_BITS), np.uint64(1)
    counts = ((u | (u >> one)) & odd) | ((u & (u >> one) & odd) << one)
    parent = list(range(len(u)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for at in range(0, len(u), strip):
        rows = u[at : at + strip]
        bound = np.bitwise_count(counts[at : at + strip, None] ^ counts[None, :])
        a, b = np.nonzero(bound <= radius)
        a, b = a[a + at < b], b[a + at < b]
        near = np.bitwise_count(rows[a] ^ u[b]) <= radius
        for x, y in zip((a[near] + at).tolist(), b[near].tolist()):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    return [(int(fps[x]), int(fps[r])) for x in range(len(u)) if (r := root(x)) != x]


def links(distinct_fps: DataFrame, radius: int = 3, cell_rows: int = 2048, agreeing: int = 3) -> DataFrame:
    """(u, v) edges of fingerprints whose components equal those of all pairs within the radius.

    `agreeing` says how many blocks of coordinates a cell fixes: more make more cells of fewer
    fingerprints, for tables of many documents; the links are the same.
    A cell of more than cell_rows fingerprints is cut into chunks, and each pair of chunks is one
    group of bounded size, so nothing is lost and no group grows with the data.
    """
    masks = block_masks(radius, agreeing)
    cells = F.array(*[F.struct(F.lit(i).alias("m"), F.col("emb").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    placed = distinct_fps.select("fp", embedding(F.col("fp")).alias("emb")).select("fp", F.explode(cells).alias("cell")).select("fp", "cell.*")
    shared = placed.groupBy("m", "key").agg(F.count("*").alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / cell_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    dealt = (
        placed.join(shared, ["m", "key"])
        .withColumn("k", chunks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .groupBy("m", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
        .agg(F.collect_list("fp").alias("fps"))
        .select("fps")
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        column = batch.column(0)
        flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        found = [e for lo, hi in zip(at, at[1:]) for e in _local_edges(flat[lo:hi], radius)]
        if not found:
            return None
        pairs = np.array(found, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    return dealt.mapInArrow(by_batch(run), "u long, v long").distinct()


def _parts(docs: DataFrame, id_col: str, text_col: str, width: int, radius: int, cell_rows: int, agreeing: int) -> DataFrame:
    """doc_id, digest, fp, root, component_id for every row of docs."""
    rows = cut(fingerprints(docs, id_col, text_col, width), batch_rows=1000)
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(links(distinct.select("fp"), radius, cell_rows, agreeing))
    joined = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = cut(joined.groupBy("root").agg(F.min("least").alias("component_id")))  # written down: see components
    of_fp = joined.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(of_fp, "fp").select("doc_id", "digest", "fp", "root", "component_id")


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3, cell_rows: int = 2048, agreeing: int = 3) -> DataFrame:
    """doc_id, fp, component_id for every row of docs.

    Fingerprints within `radius` bits link; component_id is the smallest doc_id that can be reached.
    Exact copies share a fingerprint and are folded into one before any join, so a group of copies
    costs one row. Null and empty texts have fingerprint zero and link like any other. Rows with a
    null id get the component of their fingerprint, or null when no row of it has an id. Repeated
    rows are returned as often as they occur; an empty table gives an empty result.
    """
    return _parts(docs, id_col, text_col, width, radius, cell_rows, agreeing).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """The documents without near-duplicates: of each component only the document with its smallest id stays.

    Rows without an id cannot be named by a component and all stay; of repeated rows one stays; of
    different texts under one id each stays that leads a component of its own.
    """
    named = docs.filter(F.col(id_col).isNotNull())
    return keep_smallest(docs, _parts(named, id_col, text_col, width, radius, 2048, 3), id_col, text_col)


BROADCAST_ROWS = 200_000  # of 16 bytes; how rows are dropped, not which


def keep_smallest(docs: DataFrame, parts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs less all rows but one of every root of parts (doc_id, digest, root): its smallest id, then digest, stays.

    Rows are named by their id and a digest of their text, so texts move only when the rows to drop
    are too many to broadcast; of repeated rows, which are looked at apart, one stays.
    """
    keys = parts.groupBy("root", "doc_id", "digest").agg(F.count("*").alias("n"))
    leads = cut(keys.groupBy("root").agg(F.min(F.struct("doc_id", "digest")).alias("lead")))
    own, digest, first = (unused(docs, name) for name in ("gone", "digest", "leads"))
    named = keys.join(leads, "root").select(F.col("doc_id").alias(own), F.col("digest").alias(digest), (F.struct("doc_id", "digest") == F.col("lead")).alias(first), "n")
    gone = cut(named.filter(~F.col(first) | (F.col("n") > 1)).drop("n"))
    small = F.broadcast if gone.count() <= BROADCAST_ROWS else lambda df: df
    same = (docs[id_col].cast("long") == gone[own]) & (F.xxhash64(text_bytes(docs[text_col])) == gone[digest])
    kept = docs.join(small(gone), same, "left_anti")
    repeated = docs.join(small(gone.filter(first)), same, "left_semi").withColumn(digest, F.xxhash64(text_bytes(F.col(text_col))))
    return kept.unionByName(repeated.dropDuplicates([id_col, digest]).drop(digest))
