"""Compute a shared intermediate once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def settled(df: DataFrame) -> DataFrame:
    """df written to the checkpoint folder that the session names, or df itself where none is named.

    Plans that read an intermediate several times would otherwise compute it as often. The written
    rows keep their partitioning, so an exchange on a key is not repeated either.
    """
    context, shared = df.sparkSession.sparkContext, df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if shared is None:
            return df
        context.setCheckpointDir(shared)
    return df.checkpoint()


def settled_columns(df: DataFrame) -> DataFrame:
    """As settled, but written as Parquet: a small part of the bytes of rows whose columns repeat values.

    The partitioning is not kept, so this suits intermediates that are read by aggregates only.
    """
    shared = df.sparkSession.conf.get("spark.checkpoint.dir", None) or df.sparkSession.sparkContext.getCheckpointDir()
    if shared is None:
        return df
    path = f"{shared}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buckets_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt_by(df: DataFrame, key: str) -> DataFrame:
    """df dealt by the key as settled_by writes it, so that it need not be dealt again there.

    The number of partitions is held: small rows may become many large ones before they are written.
    """
    return df.repartition(buckets_of(df.sparkSession), key)


def settled_by(df: DataFrame, key: str) -> DataFrame:
    """As settled, but written as Parquet in one bucket of the key for each shuffle partition.

    Groups, windows and joins on the key need no exchange of the rows read back, as after settled, and the
    written rows are as small as those of settled_columns. The table is known to the catalog only while it is written.
    Joins on the key and more columns need no exchange either: for that the session is told, from here on, that rows
    which are dealt by a part of a join's keys need not be dealt by all of them.
    """
    spark = df.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        return df
    name = f"settled_{uuid.uuid4().hex}"
    dealt_by(df, key).write.bucketBy(buckets_of(spark), key).option("path", f"{shared}/{name}").format("parquet").saveAsTable(name)
    rows = spark.table(name)
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external
    return rows
