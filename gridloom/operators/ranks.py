"""Exact ranks without holding a group, or the whole table, in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLED = 1280  # keys that settle the bounds of the ranges; how rows are dealt, not how they are numbered


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median", accuracy: int = 10_000) -> DataFrame:
    """keys, name: the median of a column's non-null values by group, the middle of the two middle ones where they are even.

    Three passes: a mergeable sketch of bounded size gives two values with the median's rank surely
    between them; the rows below the bracket are counted and those inside are counted by value, both
    combined on the map side; running counts over the values of the bracket, about 4 / accuracy of a group,
    reach the middle ranks. Should a bracket miss a middle rank, its group is counted by value in full. Null keys are groups.
    NaN is larger than any number, as in ordering. Groups without values have no row.
    """
    typed = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    own = [f"_key{i}" for i in range(len(keys))]
    step = 2.0 / accuracy
    rough = typed.groupBy(*[F.col(k).alias(o) for k, o in zip(keys, own)]).agg(F.count("*").alias("_n"), F.percentile_approx("_v", [0.5 - step, 0.5 + step], accuracy).alias("_around"))
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own)]
    condition = same[0] if same else F.lit(True)
    for c in same[1:]:
        condition = condition & c

    def middles(brackets: DataFrame) -> DataFrame:
        """keys, _n, the middle values found and how many were looked for, from rows with _low and _high of their group."""
        joined = typed.join(brackets, condition).select(*keys, "_v", "_n", "_low", "_high")
        place = F.when(F.col("_v") < F.col("_low"), 0).when(F.col("_v") <= F.col("_high"), 1).otherwise(2)
        counted = joined.groupBy(*keys, place.alias("_place"), F.when(place == 1, F.col("_v")).alias("_v")).agg(F.count("*").alias("_rows"), F.first("_n").alias("_n"))
        upto = F.sum("_rows").over(W.partitionBy(*keys).orderBy("_place", "_v").rowsBetween(W.unboundedPreceding, W.currentRow))
        first, last = F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2)  # ranks, from 1
        holds = lambda rank: F.when((F.col("_place") == 1) & (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_rows") < rank), F.col("_v"))
        return counted.withColumn("_upto", upto).groupBy(*keys).agg(F.max(holds(first)).alias("_a"), F.max(holds(last)).alias("_b"))

    bracket = rough.select(*own, "_n", F.col("_around")[0].alias("_low"), F.col("_around")[1].alias("_high"))
    found = middles(bracket)
    missed = found.filter("_a is null or _b is null").select(*[F.col(k).alias(o) for k, o in zip(keys, own)], F.lit(None).cast("long").alias("_none")).drop("_none")
    again = bracket.alias("b").join(missed.alias("m"), _all(F.col(f"b.{o}").eqNullSafe(F.col(f"m.{o}")) for o in own), "left_semi")
    whole = middles(again.withColumn("_low", F.lit(float("-inf"))).withColumn("_high", F.lit(float("nan"))))
    both = found.filter("_a is not null and _b is not null").unionByName(whole)
    return both.select(*keys, F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.col("_a") * 0.5 + F.col("_b") * 0.5).alias(name))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def numbered(df: DataFrame, order: list[Column], name: str = "rn", rows_per_range: int = 100_000) -> DataFrame:
    """df with a number from 1 for each row, in ascending order of the keys, nulls first.

    The keys must name a row. A sample of SAMPLED keys at most gives the bounds of about one range for
    rows_per_range rows; rows are numbered inside their range, and a range's numbers go on from the
    rows counted in the ranges before it, so no window sees all rows. Bounds depend on the rows
    alone: a task that runs again puts a row into the same range.
    """
    key = F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)])
    n = df.count()
    ranges = min(SAMPLED, -(-n // rows_per_range))
    keyed = df.withColumn("_key", key)
    if ranges > 1:
        sample = keyed.select("_key").orderBy(F.xxhash64("_key"), "_key").limit(SAMPLED).agg(F.array_sort(F.collect_list("_key")).alias("s"))
        bounds = F.broadcast(sample.select(F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.element_at("s", F.greatest(F.lit(1), (i * F.size("s") / ranges).cast("int")))).alias("_bounds")))
        keyed = keyed.crossJoin(bounds).withColumn("_range", F.size(F.filter("_bounds", lambda b: F.col("_key") >= b))).drop("_bounds")  # one row of bounds
    else:
        keyed = keyed.withColumn("_range", F.lit(0))
    before, start = {}, 0
    for r in keyed.groupBy("_range").count().orderBy("_range").collect():  # one row for each range, SAMPLED at most
        before[r["_range"]], start = start, start + r["count"]
    first = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col("_range")) if before else F.lit(0)
    within = F.row_number().over(W.partitionBy("_range").orderBy("_key"))
    return keyed.withColumn(name, (first + within).cast("long")).drop("_key", "_range")
