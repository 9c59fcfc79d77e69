"""MERGE, UPDATE and DELETE as deterministic DataFrame operations.

Every operator gives a new DataFrame; write_swapped() puts one in a table's place. Keys compare
null-safely. A source with two rows of one key is an error where rows could match twice.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "_matched"


def check_unique(source: DataFrame, keys: list[str]) -> None:
    """Raise if a key occurs twice in source."""
    again = source.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if again:
        raise ValueError(f"source has several rows for one key: {again[0].asDict()}")


def _same(t: str, s: str, keys: list[str]) -> Column:
    return functools.reduce(lambda a, b: a & b, (F.col(f"{t}.{k}").eqNullSafe(F.col(f"{s}.{k}")) for k in keys))


def align(df: DataFrame, schema) -> DataFrame:
    """df with exactly the columns of schema: missing ones null, types cast, others dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def missing_columns(df: DataFrame, schema) -> list[str]:
    return [f.name for f in schema.fields if f.name not in df.columns]


def upsert(target: DataFrame, source: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Matched rows take all source values, new rows are added."""
    if check:
        check_unique(source, keys)
    kept = target.alias("t").join(source.select(*keys).alias("s"), _same("t", "s", keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of source whose key the target lacks are added; the target's rows stay as they are."""
    new = source.select(*target.columns).alias("s").join(target.select(*keys).alias("t"), _same("s", "t", keys), "left_anti")
    return target.unionByName(new)


def update_matched(target: DataFrame, source: DataFrame, keys: list[str], columns: dict[str, Column | str], when: Column | None = None, check: bool = True) -> DataFrame:
    """Matched rows get the given columns, as source column names or expressions over s.* and t.*."""
    if check:
        check_unique(source, keys)
    joined = target.alias("t").join(source.withColumn(MARK, F.lit(True)).alias("s"), _same("t", "s", keys), "left")
    hit = F.coalesce(F.col(f"s.{MARK}"), F.lit(False))
    hit = hit & F.coalesce(when, F.lit(False)) if when is not None else hit
    value = lambda c: F.col(f"s.{columns[c]}") if isinstance(columns[c], str) else columns[c]
    return joined.select(*[F.when(hit, value(c)).otherwise(F.col(f"t.{c}")).alias(c) if c in columns else F.col(f"t.{c}").alias(c) for c in target.columns])


def upsert_gated(target: DataFrame, source: DataFrame, keys: list[str], hash_col: str, gated: list[str], check: bool = True) -> DataFrame:
    """Full upsert in which the gated columns change only if the content hash did (a null hash is '')."""
    if check:
        check_unique(source, keys)
    joined = target.withColumn("_t", F.lit(True)).alias("t").join(source.withColumn("_s", F.lit(True)).alias("s"), _same("t", "s", keys), "full_outer")
    changed = F.coalesce(F.col(f"t.{hash_col}"), F.lit("")) != F.coalesce(F.col(f"s.{hash_col}"), F.lit(""))
    fresh = F.col("t._t").isNull()

    def column(c: str) -> Column:
        take = fresh | (F.col("s._s").isNotNull() & changed) if c in gated else F.col("s._s").isNotNull()
        return F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    return joined.select(*[column(c) for c in target.columns])


def backfill_null(target: DataFrame, source: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Fill a column where it is null, from the source row with the same key."""
    return update_matched(target, source, keys, {column: column}, F.col(f"t.{column}").isNull())


def update_where(df: DataFrame, where: Column, columns: dict[str, Column]) -> DataFrame:
    """UPDATE: all expressions see the old values; rows whose condition is null stay."""
    return df.withColumns({c: F.when(where, v).otherwise(F.col(c)) for c, v in columns.items()})


def update_in(df: DataFrame, key: str, keys: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """UPDATE ... WHERE key IN (keys); a null key is in nothing."""
    wanted = keys.select(F.col(keys.columns[0]).alias("_key")).filter("_key is not null").distinct()
    flagged = df.join(wanted, F.col(key) == F.col("_key"), "left")
    return update_where(flagged, F.col("_key").isNotNull(), columns).drop("_key")


def delete_where(df: DataFrame, where: Column) -> DataFrame:
    """DELETE: rows whose condition is null stay."""
    return df.filter(~F.coalesce(where, F.lit(False)))


def sweep_stale(df: DataFrame, key: str, processed: DataFrame, stamp: str, run_ts: Column) -> DataFrame:
    """Drop rows of processed keys that this run did not write again."""
    done = processed.select(F.col(processed.columns[0]).alias("_key")).filter("_key is not null").distinct()
    flagged = df.join(done, F.col(key) == F.col("_key"), "left")
    return delete_where(flagged, F.col("_key").isNotNull() & (F.col(stamp) < run_ts)).drop("_key")


def move_rows(source: DataFrame, target: DataFrame, where: Column, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(source without the rows, target with those that it lacks)."""
    return delete_where(source, where), insert_only(target, source.filter(where), keys)


def reconcile_counts(log: DataFrame, facts: DataFrame, key: str, count_col: str, status_col: str) -> DataFrame:
    """Set a log's row count and status from what the facts hold: `success` with rows, else `empty`."""
    counted = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    joined = log.join(counted, key, "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    return joined.withColumns({count_col: F.col("_n"), status_col: F.when(F.col("_n") > 0, "success").otherwise("empty")}).select(*log.columns)
