"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import by_batch, cut, text_bytes

ROUNDS = 6  # even, so that unequal halves end where they began


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser with good avalanche, applied to a half block under a round key."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(key)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _round_keys(seed: int) -> list[int]:
    """Fixed by the seed and the mixing rule alone, so a shuffle can be repeated anywhere."""
    return [int(k) for k in _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64), (seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & ((1 << 64) - 1))]


def _feistel(x: np.ndarray, bits: int, keys: list[int], inverse: bool) -> np.ndarray:
    low, high = bits - bits // 2, bits // 2
    right, left = x & np.uint64((1 << low) - 1), x >> np.uint64(low)
    widths = [(high, low) if r % 2 == 0 else (low, high) for r in range(ROUNDS)]
    if inverse:
        for r in reversed(range(ROUNDS)):
            wide = np.uint64((1 << widths[r][0]) - 1)
            left, right = right ^ (_mix(left, keys[r]) & wide), left
    else:
        for r in range(ROUNDS):
            wide = np.uint64((1 << widths[r][0]) - 1)
            left, right = right, left ^ (_mix(right, keys[r]) & wide)
    return (left << np.uint64(low)) | right


def permute(rows: np.ndarray, n: int, seed: int = 0, inverse: bool = False) -> np.ndarray:
    """The place of each row number in a pseudo-random permutation of 0..n-1.

    The network permutes the smallest power of two that holds n; values outside 0..n-1 walk along
    their cycle until they are inside, under two steps on average.
    """
    bits, keys = max(2, int(n - 1).bit_length()), _round_keys(seed)
    out = _feistel(rows.astype(np.uint64), bits, keys, inverse)
    while (outside := out >= np.uint64(n)).any():
        out[outside] = _feistel(out[outside], bits, keys, inverse)
    return out.astype(np.int64)


def locate(row: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of one global row number, without any data."""
    place = int(permute(np.array([row]), n, seed)[0])
    return place % shards, place // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The global row number that stands at a slot of a shard."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def number_rows(rows: DataFrame, *order: str) -> DataFrame:
    """Adds row_no (0, 1, ... in the given order) and n_rows.

    The rows are range-partitioned and sorted once; a row's number is its place in its partition
    plus the sizes of the partitions before, so no task sees more than its own range. Rows that are
    equal in the whole order are interchangeable: a last key taken from their place in the input
    spreads them over partitions.
    """
    spread = rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    placed = cut(spread.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    part, inside = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))  # one row per partition
    before = sizes.select(
        "_part",
        (F.sum("_size").over(W.orderBy("_part")) - F.col("_size")).alias("_before"),
        F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("n_rows"),
    )
    numbered = placed.withColumn("_part", part).join(F.broadcast(before), "_part")
    return numbered.withColumn("row_no", F.col("_before") + inside).drop("_part", "_at", "_before")


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, row_no, shard, slot for every row.

    size is the text's UTF-8 bytes plus 1 (a null text has none). The rows are numbered by doc_id
    (nulls first), then by text; place p of the shuffled numbering goes to shard p mod shards, slot
    p div shards, so shard counts differ by one at most and slots have no gaps. Documents of equal
    text are spread over the shards like any others. Equal rows may change places with each other
    only. Null ids are kept, an empty table gives no rows, extra columns are not read. Texts
    themselves are not shuffled.
    """
    body = text_bytes(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias("_digest"))
    numbered = number_rows(rows, "doc_id", "_digest")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, n = batch.column(3), batch.column(4)[0].as_py()
        place = permute(row.to_numpy(zero_copy_only=False), n, seed)
        arrays = [*batch.columns[:4], pa.array((place % shards).astype(np.int32)), pa.array(place // shards)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "size", "text_crc32", "row_no", "shard", "slot"])

    kept = numbered.select("doc_id", "size", "text_crc32", "row_no", "n_rows")
    return kept.mapInArrow(by_batch(run), "doc_id long, size long, text_crc32 long, row_no long, shard int, slot long")
