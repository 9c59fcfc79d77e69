"""Tables on storage: schemas, swapped writes, views and statement scripts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import align
from ..settle import settled

BUCKET = "key_bucket"  # partition column of tables that are merged by bucket

#: Columns of the observation table; everything that writes one aligns to this.
OBSERVATION = T.StructType([
    T.StructField(name, kind)
    for kind, names in (
        (T.StringType(), "sheet_report_id indicator_observation_id report_id attachment_id table_id period_type sub_category indicator_domain indicator_subdomain indicator_name_raw indicator_name_normalized geography_raw sector_raw product_raw unit_raw metric_name_raw metric_type value_text currency scale extraction_method source_filename source_sheet_name"),
        (T.IntegerType(), "source_row_index source_column_index report_year report_month report_quarter"),
        (T.DateType(), "period_start_date period_end_date"),
        (T.DoubleType(), "value_numeric extraction_confidence"),
        (T.BooleanType(), "needs_review"),
        (T.TimestampType(), "extracted_timestamp"),
    )
    for name in names.split()
])


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and a function that names paths on it."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return name(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), name


def exists(spark: SparkSession, path: str) -> bool:
    files, name = _files(spark, path)
    return files.exists(name(path))


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI, as Spark's readers write it."""
    files, name = _files(spark, path)
    return files.makeQualified(name(path)).toString()


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; a rename that the file system refuses is an error."""
    files, name = _files(spark, source)
    if not files.rename(name(source), name(target)):
        raise OSError(f"could not rename {source} to {target}")


class NullsRefused(ValueError):
    """Rows with nulls in required columns; `counts` has how many by column, `path` the table that stays as it was."""

    def __init__(self, path: str, counts: dict[str, int]):
        self.path, self.counts = path, {k: n for k, n in counts.items() if n}
        super().__init__(f"{path} refused: nulls in " + ", ".join(f"{k} ({n} rows)" for k, n in self.counts.items()))


def _nulls(required: tuple[str, ...]) -> list[Column]:
    return [F.count_if(F.col(k).isNull()).alias(k) for k in required]


def write_swapped(df: DataFrame, path: str, partition_by: list[str] | None = None, required: tuple[str, ...] = ()) -> None:
    """Replace the table at path: write the whole new one beside it, then swap folders.

    The write itself counts the nulls of the required columns; if there are any the new rows are deleted,
    the old table stays and NullsRefused is raised.

    df may read the table that it replaces. Until the new rows are complete the old table is not
    touched; if they cannot be put in its place it is put back, and it is deleted last of all. Between the two
    renames there is no table for a moment, so readers that must not see that need a catalog.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    fresh, old = f"{path}.{mark}.new", f"{path}.{mark}.old"
    seen = Observation()
    writer = (df.observe(seen, *_nulls(required)) if required else df).write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(fresh)
    files, name = _files(spark, path)
    if required and any(seen.get.values()):
        files.delete(name(fresh), True)
        raise NullsRefused(path, seen.get)
    had = files.exists(name(path))
    if had:
        rename(spark, path, old)
    try:
        rename(spark, fresh, path)
    except Exception:
        if had:
            rename(spark, old, path)
        raise
    if had:
        files.delete(name(old), True)


def write_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions that df has rows of; all others stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def merge_buckets(fresh: DataFrame, path: str, bucket_by: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64, required: tuple[str, ...] = ()) -> None:
    """Merge rows into a table that is partitioned by a hash of bucket_by; only buckets that they fall into are read and rewritten.

    merge(old, fresh) gives the new rows of those buckets and keeps some of the fresh ones, so that no
    bucket is left empty. A run that is repeated after a failure gives the same table if merge is idempotent.
    Fresh rows with nulls in required columns raise NullsRefused before anything is written. Columns that
    only the old or only the fresh rows have are null in the others.
    """
    spark = fresh.sparkSession
    rows = settled(fresh.withColumn(BUCKET, F.pmod(F.xxhash64(*bucket_by), F.lit(buckets)).cast("int")))
    found = rows.groupBy(BUCKET).agg(F.count("*").alias("_rows"), *_nulls(required)).collect()  # at most `buckets` rows
    touched = [r[BUCKET] for r in found]
    counts = {k: sum(r[k] for r in found) for k in required}
    if any(counts.values()):
        raise NullsRefused(path, counts)
    if not touched:
        return
    if not exists(spark, path):
        write_partitions(rows, path, [BUCKET])
        return
    old = spark.read.option("mergeSchema", "true").parquet(path).filter(F.col(BUCKET).isin(touched))  # buckets of older runs may lack columns
    every = T.StructType([*(f for f in rows.schema if f.name != BUCKET), *(f for f in old.schema if f.name != BUCKET and f.name not in rows.columns), rows.schema[BUCKET]])
    write_partitions(settled(merge(align(old, every), align(rows, every))), path, [BUCKET])  # settled: it reads what it replaces


def write_observations(df: DataFrame, path: str, required: tuple[str, ...] = ()) -> None:
    """Observations by domain: one table that serves all topic views by partition pruning.

    Rows are dealt by domain and year where adaptive execution may split a large share, so no
    domain-year is one task or one file.
    """
    dealt = align(df, OBSERVATION).hint("rebalance", F.col("indicator_domain"), F.col("report_year"))
    write_swapped(dealt, path, ["indicator_domain"], required)


def topic_views(spark: SparkSession, path: str, domains: list[str]) -> None:
    """A temporary view per domain over the one table."""
    facts = spark.read.parquet(path)
    for domain in domains:
        facts.filter(facts.indicator_domain == domain).createOrReplaceTempView(f"{domain}_report")


def run_script(spark: SparkSession, text: str) -> list[DataFrame]:
    """Run the statements of an SQL script: comment lines and USE statements are left out."""
    kept = "\n".join(line for line in text.splitlines() if not line.strip().startswith("--"))
    statements = [s.strip() for s in kept.split(";")]
    return [spark.sql(s) for s in statements if s and not s.upper().startswith("USE ")]


def to_json_rows(df: DataFrame) -> DataFrame:
    """One JSON text per row."""
    return df.selectExpr("to_json(struct(*)) AS value")
