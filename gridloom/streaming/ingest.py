"""Incremental runs of the batch operators over a folder of arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.curated import keep_first
from ..operators.upsert import upsert
from ..plans.tables import BUCKET, write_partitions
from ..settle import settled


def upsert_stream(spark: SparkSession, source: str, schema: StructType, target: str, keys: list[str], newest: str, checkpoint: str, buckets: int = 64) -> None:
    """Merge files that arrived since the last run into a table and stop.

    Of several rows of a key in a batch the one with the largest `newest` counts. The table is
    partitioned by a hash of the keys into `buckets`; a batch reads and rewrites only the buckets
    that its keys fall into. A batch that is run again after a failure gives the same table, since
    an upsert by key is idempotent.
    """
    wide = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def merge(batch: DataFrame, _: int) -> None:
        rows = keep_first(batch, keys, batch[newest].desc(), *[batch[c].asc() for c in batch.columns if c not in (*keys, newest)]).withColumn(BUCKET, bucket)
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # at most `buckets`
        if not touched:
            return
        try:
            old = spark.read.schema(wide).parquet(target).filter(F.col(BUCKET).isin(touched))
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = spark.createDataFrame([], wide)
        write_partitions(settled(upsert(old, rows, keys, check=False)), target, [BUCKET])  # settled: it reads what it replaces

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
