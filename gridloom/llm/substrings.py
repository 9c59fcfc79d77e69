"""Substring dedup: content-defined chunks under a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, slices, text_bytes, unused

ONE_IN = 20  # a boundary after one in so many characters, before LEAST
WINDOW = 16  # characters that decide on a boundary
LEAST = 8  # characters between boundaries
MOST = 2048  # a longer stretch without a boundary is cut
BROADCAST_ENTRIES = 200_000  # of 16 bytes; how repeated chunks are joined, not which
BROADCAST_KEYS = 4_000_000  # of 8 bytes; whether other pairs are left out before the join or by it


def _gear(size: int = 1 << 16) -> np.ndarray:
    """Pseudo-random 32-bit values for characters, by rule."""
    with np.errstate(over="ignore"):
        x = np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((x ^ (x >> np.uint64(27))) >> np.uint64(16)).astype(np.uint32)


GEAR = _gear()


def chunk_bounds(points: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text given as code points, the first start included.

    The gear hash h = 2h + gear[c] is built for all places at once by doubling its window. The
    tested bits depend on the last WINDOW characters only, and a boundary counts if none stands in
    the LEAST characters before it, so boundaries move along with the text around them.
    """
    n = len(points)
    if not n:
        return np.zeros(1, np.int64)
    h, reach = GEAR[points & np.uint32(0xFFFF)], 1
    while reach < WINDOW:
        grown = h.copy()
        grown[reach:] += h[:-reach] << np.uint32(reach)
        h, reach = grown, reach * 2
    tested = (h >> np.uint32(WINDOW - 10)) & np.uint32(1023)  # ten bits, set by 7 to WINDOW characters
    at = np.flatnonzero(tested < 1024 // ONE_IN) + 1
    at = at[np.diff(at, prepend=-LEAST) >= LEAST]
    ends = np.concatenate([[0], at[at < n], [n]])
    if (wide := np.diff(ends)).max() > MOST:
        extra = [np.arange(s + MOST, s + w, MOST) for s, w in zip(ends[:-1], wide) if w > MOST]
        ends = np.unique(np.concatenate([ends, *extra]))
    return ends


def chunks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, chunk bounds and 64-bit chunk digests of a UTF-8 text."""
    raw = text.decode("utf-8", "replace").encode("utf-32-le")
    points = np.frombuffer(raw, np.uint32)
    bounds = chunk_bounds(points)
    digest, ends = xxhash.xxh3_64_intdigest, (bounds * 4).tolist()
    return points, bounds, np.array([digest(raw[a:b]) for a, b in zip(ends, ends[1:])], np.uint64).view(np.int64)


def pair_keys(digests: np.ndarray) -> np.ndarray:
    """64-bit digests of all pairs of neighbouring chunks."""
    d = digests.view(np.uint64)
    with np.errstate(over="ignore"):
        x = d[:-1] * np.uint64(0x9E3779B97F4A7C15) + (d[1:] ^ (d[1:] >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def pair_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", wanted: np.ndarray | None = None) -> DataFrame:
    """own (the document), row (a digest of id and text), key for every distinct pair of neighbouring chunks of a row; wanted: only these keys, sorted."""
    looked_for = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)

    def kept(keys: np.ndarray) -> np.ndarray:
        if looked_for is None or not len(keys):
            return keys
        known = looked_for.value
        return keys[known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys] if len(known) else keys[:0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                keys = [kept(np.unique(pair_keys(chunks(t)[2]))) for t in part.column(2).to_pylist()]
                sizes = [len(k) for k in keys]
                if not sum(sizes):
                    continue
                own, row = (np.repeat(part.column(i).to_numpy(zero_copy_only=False), sizes) for i in range(2))
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(row), pa.array(np.concatenate(keys))], ["own", "row", "key"])

    body = text_bytes(F.col(text_col))
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("own"), row_digest(docs, id_col, text_col).alias("row"), body.alias("body"))
    return rows.mapInArrow(run, "own long, row long, key long")


def row_digest(docs: DataFrame, id_col: str, text_col: str) -> Column:
    return F.xxhash64(docs[id_col].cast("long"), text_bytes(docs[text_col]))


def repeated_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, found (array of key, first) of the rows whose pairs stand in a document with a smaller id.

    The aggregate keeps two ids for a key and combines on the map side, so a passage that all
    documents share costs a row per task. The repeated keys are written down; where they are few enough
    to be sent to every task, pairs that no other document has are left out before they move. They are
    then joined: few by broadcast, many by exchanges of both sides, whose hot keys adaptive execution splits. `found`
    is bounded by the row's own text, and equal rows fold into one.
    """
    table = pair_table(docs, id_col, text_col)
    spread = cut(table.groupBy("key").agg(F.min("own").alias("first"), F.max("own").alias("_last")).filter("first < _last").drop("_last"))
    n = spread.count()
    small = F.broadcast if n <= BROADCAST_ENTRIES else lambda df: df
    if n <= BROADCAST_KEYS:
        table = pair_table(docs, id_col, text_col, np.sort(spread.select("key").toArrow().column("key").to_numpy()))
    return cut(table.join(small(spread), "key").filter("own > first").groupBy("row").agg(F.collect_set(F.struct("key", "first")).alias("found")))


def _runs(points: np.ndarray, bounds: np.ndarray, repeated: np.ndarray, min_words: int) -> list[tuple[int, int, int, int]]:
    """Runs of repeated pairs of chunks that hold min_words whole words: pair range and character span, cut at white space."""
    edge = np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]]))
    found = []
    white = np.isin(points, BLANKS)
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
        start, end = int(bounds[a]), int(bounds[b + 1])
        if start and not white[start - 1] and not white[start]:  # inside a word: begin behind it
            inside = np.flatnonzero(white[start:end])
            start = start + int(inside[0]) if len(inside) else end
        if end < len(points) and not white[end] and not white[end - 1]:
            inside = np.flatnonzero(white[start:end])
            end = start + int(inside[-1]) if len(inside) else start
        solid = ~white[start:end]
        words = int(solid[:1].sum() + (solid[1:] & ~solid[:-1]).sum())
        if words >= min_words:
            found.append((int(a), int(b), start, end))
    return found


BLANKS = np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)
RESULT = pa.struct([("text", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("firsts", pa.list_(pa.int64()))])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 24, spans_col: str = "removed_spans", firsts_col: str = "first_doc_ids") -> DataFrame:
    """docs with passages removed that documents with smaller ids hold too.

    Added columns: spans_col (start, end in characters of the old text) and firsts_col (the
    first documents that hold what was removed); columns of docs with these names are replaced. A run of
    repeated pairs of neighbouring chunks goes when it holds min_words whole words. Each pair stands
    as it is in one document with a smaller id; a longer run may be made of overlapping pairs of
    several documents. Chunk borders cost a passage some words at both ends, so passages of
    fifty words and more are found while lines of fewer than min_words words never are.
    A key has 64 bits; a run needs several equal keys in a row, so one collision removes
    nothing. Passages repeated inside one document stay. Null texts stay null and empty texts empty;
    rows without an id stay whole, as do rows that share an id with the keeper of the passage, so
    repeated rows are never emptied against each other. All other columns and all rows are kept.
    """
    docs = docs.drop(spans_col, firsts_col)
    flags = repeated_pairs(docs, id_col, text_col)
    entries = flags.agg(F.sum(F.size("found"))).first()[0] or 0
    row, found, done = (unused(docs, name) for name in ("row", "found", "done"))
    flags = flags.toDF(row, found)

    @F.arrow_udf("struct<text string, spans array<struct<start int, end int>>, firsts array<long>>")
    def cut_out(bodies: pa.Array, found_lists: pa.Array) -> pa.Array:
        out = []
        for body, found in zip(bodies.to_pylist(), found_lists):
            if body is None or not found.is_valid:
                out.append(None)
                continue
            points, bounds, digests = chunks(body)
            keys = pair_keys(digests)
            known, first_of = (found.values.field(k).to_numpy(zero_copy_only=False) for k in ("key", "first"))
            order = np.argsort(known)
            at = np.minimum(np.searchsorted(known[order], keys), len(known) - 1)
            repeated, first = known[order][at] == keys, first_of[order][at]
            runs = _runs(points, bounds, repeated, min_words)
            if not runs:
                out.append(None)
                continue
            keep = np.ones(len(points), bool)
            for _, _, s, e in runs:
                keep[s:e] = False
            out.append({"text": points[keep].tobytes().decode("utf-32-le"), "spans": [{"start": s, "end": e} for _, _, s, e in runs], "firsts": sorted({int(f) for a, b, _, _ in runs for f in first[a:b]})})
        return pa.array(out, RESULT)

    side = F.broadcast(flags) if entries <= BROADCAST_ENTRIES else flags
    joined = docs.join(side, F.when(docs[id_col].isNotNull(), row_digest(docs, id_col, text_col)) == flags[row], "left")
    cleaned = joined.withColumn(done, F.when(F.col(found).isNotNull(), cut_out(F.col(text_col).cast("binary"), found)))
    return cleaned.select(
        *[F.coalesce(f"{done}.text", F.col(c)).alias(c) if c == text_col else F.col(c) for c in docs.columns],
        F.coalesce(f"{done}.spans", F.array().cast("array<struct<start:int,end:int>>")).alias(spans_col),
        F.coalesce(f"{done}.firsts", F.array().cast("array<bigint>")).alias(firsts_col),
    )
