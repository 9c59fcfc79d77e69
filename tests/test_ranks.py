"""Exact medians and numbers against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.operators import ranks


@pytest.mark.parametrize("accuracy", [10_000, 20, 5])
def test_medians_equal_percentile(spark, accuracy):
    rng = random.Random(accuracy)
    rows = [(g, h, x) for g, h, n in (("one", 1, 1), ("two", 1, 2), ("odd", None, 7), (None, None, 8), ("ties", 2, 200), ("many", 2, 3001)) for x in ([rng.choice([1.5, 2.5, 2.5, 9.0]) for _ in range(n)] if g == "ties" else [rng.gauss(0, 1e6) for _ in range(n)])]
    rows += [("none", 1, None), ("one", 1, None), ("nan", 1, float("nan")), ("nan", 1, 3.0), ("nan", 1, 4.0)]
    df = spark.createDataFrame(rows, "g string, h int, x double").repartition(5)
    want = {(r.g, r.h): r.m for r in df.filter("x is not null").groupBy("g", "h").agg(F.percentile("x", F.lit(0.5)).alias("m")).collect()}
    got = {(r.g, r.h): r.m for r in ranks.exact_median(df, ["g", "h"], "x", "m", accuracy).collect()}
    assert got == want and len(got) == 7


def test_a_large_group_is_bracketed(spark):
    df = spark.range(2_000_000).selectExpr("1 AS g", "CAST(pmod(xxhash64(id), 1000003) AS double) AS x")
    want = df.groupBy("g").agg(F.percentile("x", F.lit(0.5)).alias("m")).first().m
    found = ranks.exact_median(df, ["g"], "x", "m")
    assert found.first().m == want
    assert "ObjectHashAggregate" in found._jdf.queryExecution().executedPlan().toString()  # the sketch; no percentile over all values


def test_numbers_run_through_ranges(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(5), rng.choice([None, "a", "b", "é"]), i) for i in range(700)]
    df = spark.createDataFrame(rows, "n long, s string, i long").repartition(6)
    for size in (100_000, 50, 3):
        got = ranks.numbered(df, [-F.col("n"), F.col("s"), F.col("i")], "rn", rows_per_range=size)
        want = sorted(rows, key=lambda r: (-r[0], r[1] is not None, (r[1] or "").encode(), r[2]))
        assert [(r.n, r.s, r.i) for r in sorted(got.collect(), key=lambda r: r.rn)] == want
        assert sorted(r.rn for r in got.collect()) == list(range(1, 701))
    assert ranks.numbered(df.limit(0), [F.col("i")]).count() == 0
