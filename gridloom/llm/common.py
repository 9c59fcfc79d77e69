"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all hosts share, as spark.checkpoint.dir names it.

    Where it is unset, a local master (tests) gets a folder of its own; a cluster has none to fall back on.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all hosts share")
    return tempfile.mkdtemp(prefix="gridloom-checkpoint-")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def use_checkpoints(spark: SparkSession) -> None:
    """Make checkpoint() usable."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def arrow_rows(spark: SparkSession, most: int | None) -> Iterator[None]:
    """Arrow batches of at most `most` rows while an action runs."""
    before = spark.conf.get(BATCH)
    if most is not None:
        spark.conf.set(BATCH, str(most))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def cut(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there.

    batch_rows bounds the Arrow batches of Python steps in df while they run.
    """
    use_checkpoints(df.sparkSession)
    with arrow_rows(df.sparkSession, batch_rows):
        return df.checkpoint(eager=True)


class Kept:
    """Tables written to a folder of their own under the shared one, each deleted when it is no longer read.

    As Parquet they are smaller than checkpoints and read by column, and their space is free again as
    soon as drop() or close() says so.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"
        self.tables: list[tuple[DataFrame, str]] = []

    def keep(self, df: DataFrame, batch_rows: int | None = None) -> DataFrame:
        path = f"{self.root}/{len(self.tables)}"
        with arrow_rows(self.spark, batch_rows):
            df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((kept, path))
        return kept

    def drop(self, *dfs: DataFrame) -> None:
        for kept, path in self.tables:
            if any(kept is df for df in dfs):
                delete_folder(self.spark, path)

    def close(self) -> None:
        delete_folder(self.spark, self.root)


def unused(df: DataFrame, name: str) -> str:
    """name, with as many underscores before it as make it none of df's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; a null text counts as empty."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that turns each batch into one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield out

    return run


def slices(batch: pa.RecordBatch, column: int, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about most_bytes of a binary column, or one row if that is longer."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for row, size in enumerate(sizes):
        if total and total + size > most_bytes:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)
