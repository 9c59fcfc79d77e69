"""Sums over all rows of a vector table, one small matrix for each vector length."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import matrix

ELEMENTS = 1 << 20  # of a slice of rows that is multiplied at once
PIECE = 1 << 16  # numbers of a sum that travel together
SLOTS = 32  # tasks that add up the arrays of a piece before the last one does


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer matrix) of each vector length in an Arrow column of lists, in slices of about ELEMENTS components."""
    sizes = np.diff(column.offsets.to_numpy())
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        step = max(1, ELEMENTS // max(1, int(size)))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            yield some, matrix(column.take(pa.array(some)), np.int64)


def summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], exact: bool = False) -> dict[int, np.ndarray]:
    """Vector length -> the sum of of(matrix of rows) over all rows of that length; rows has the one column v.

    Every task adds up its own rows and hands on one array for each length, in pieces of PIECE numbers;
    the arrays of a piece are added by SLOTS tasks and then by one, so neither the driver nor a task
    gets more than the result has. exact: integers of up to 38 digits, as an array of Python integers; else doubles.
    """
    kind = pa.decimal128(38, 0) if exact else pa.float64()
    schema = f"size int, piece int, value array<{'decimal(38,0)' if exact else 'double'}>"

    def written(totals: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
        for (size, piece), total in totals.items():
            value = [Decimal(int(t)) for t in total] if exact else total
            yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([piece], pa.int32()), pa.array([value], pa.list_(kind))], ["size", "piece", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in by_length(batch.column(0)):
                part = of(x)
                totals[x.shape[1]] = totals[x.shape[1]] + part if x.shape[1] in totals else part
        yield from written({(size, at // PIECE): total[at : at + PIECE] for size, total in totals.items() for at in range(0, len(total), PIECE)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                key = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                value = batch.column(2)[row].values
                part = np.array([int(v) for v in value.to_pylist()], object) if exact else value.to_numpy(zero_copy_only=False)
                totals[key] = totals[key] + part if key in totals else part
        yield from written(totals)

    parts = rows.mapInArrow(run, schema).withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(SLOTS)))
    parts = parts.repartition("size", "piece", "slot").select("size", "piece", "value").mapInArrow(add, schema)
    found: dict[int, list] = {}
    for r in parts.repartition("size", "piece").mapInArrow(add, schema).orderBy("size", "piece").collect():  # as many numbers as the result has
        found.setdefault(r.size, []).extend(map(int, r.value) if exact else r.value)
    return {size: np.array(values, object if exact else np.float64) for size, values in found.items()}


def count_and_sums(x: np.ndarray) -> np.ndarray:
    """The number of rows, then the sum of each column, as Python integers."""
    safe = len(x) * max(1, int(x.max(initial=0)), -int(x.min(initial=0))) < 1 << 62
    return np.array([len(x), *(x if safe else x.astype(object)).sum(axis=0).tolist()], object)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exact: 64-bit integers where they suffice, else Python integers."""
    most = n * max(1, int(x.max(initial=0)), -int(x.min(initial=0))) + max(abs(int(s)) for s in sums)
    return n * x - sums.astype(np.int64) if most < 1 << 62 else n * x.astype(object) - sums[None, :]


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x less the mean; the difference is taken in integers and rounded once."""
    return deviations(x, n, sums).astype(np.float64) / n
