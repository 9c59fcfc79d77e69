"""Hard negatives against all pairs."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import negatives
from gridloom.llm.queries import oracle_sql, queries

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, anchor, k=10, positives=5):
    """rows: (vec_id, vector, label), usable and distinct."""
    x = [(i, [math.floor(256 * c) for c in v], label) for i, v, label in rows]
    out = []
    for i, v, label in x:
        if anchor(i):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in x if j != i and len(w) == len(v))
            for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
                fits = [(j, -s) for s, j, other in scored if other != label and 30 * -ps <= 100 * -s <= 90 * -ps][:k]
                out += [(i, p, r + 1, j, -ps, s) for r, (j, s) in enumerate(fits)]
    return sorted(out)


def rows_of(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def clustered(seed, n, d, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, d))
    return [(i, (centres[rng.integers(6)] + 0.4 * rng.standard_normal(d)).round(1 + i % 2).tolist(), int(rng.integers(labels)) if i % 3 else 0) for i in range(n)]


@pytest.mark.parametrize("d, data_rows, query_rows", [(9, 40, 7), (1, 8192, 512), (16, 8192, 3)])
def test_equal_all_pairs(spark, d, data_rows, query_rows):
    rows = clustered(d, 300, d)
    rows += [(1000 + i, rows[3][1], i % 3) for i in range(20)]  # ties
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = negatives.hard_negatives(table, F.col("vec_id") % 10 == 0, data_rows=data_rows, query_rows=query_rows)
    assert rows_of(got) == plain(rows, lambda i: i % 10 == 0)


def test_unusable_rows_repeats_and_extra_columns(spark):
    rows = clustered(2, 120, 5) + clustered(3, 30, 3)[:0] + [(500 + i, [float(i), 1.0, 2.0], i % 2) for i in range(12)]
    bad = [(700, None, 1), (710, [], 1), (720, [1.0, None, 1.0, 1.0, 1.0], 1), (730, [float("nan")] * 5, 0), (740, [float("inf")] * 5, 0), (750, [1.0] * 5, None), (None, [9.0] * 5, 0)]
    table = spark.createDataFrame(rows + bad + rows[:30] * 7, SCHEMA).selectExpr("*", "1 AS v", "2 AS size", "3 AS rank", "4 AS asked", "5 AS place")
    got = negatives.hard_negatives(table, F.col("vec_id") % 10 == 0)
    assert rows_of(got) == plain(rows, lambda i: i % 10 == 0)
    assert negatives.hard_negatives(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 1.0], 3), (1, [1.0, 1.0], 4)], SCHEMA)
    assert negatives.hard_negatives(alone, F.col("vec_id") % 10 == 0).count() == 0


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    embeddings = duckdb.sql(f"SELECT * FROM '{folder}/embeddings.parquet'")  # noqa: F841  read by the SQL
    want = duckdb.sql(oracle_sql()["op13_rotated_hard_negatives"]).fetchall()
    got = rows_of(queries()["op13_rotated_hard_negatives"](spark, folder))
    assert got == sorted(want) and len(got) > 100


def test_bounds_discard_early_and_lose_nothing():
    rng = np.random.default_rng(4)
    d = 32
    spread = np.array([40.0 * 0.7**i + 0.5 for i in range(d)])
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    rows = np.floor(rng.standard_normal((4000, d)) * spread @ turn * 8).astype(np.int64)
    axes = np.linalg.eigh(rows.T.astype(float) @ rows)[1][:, ::-1]
    q, counts = rows[:20], []
    exact = q @ rows.T
    top = np.sort(exact, axis=1)[:, -40]
    lows, highs = (top * 30 // 100)[:, None], (top * 90 // 100)[:, None]
    found = negatives.windowed_top(q, lows, highs, rows, np.arange(4000), np.zeros((20, 4000), bool), axes, 10, counts=counts)
    for i in range(20):
        want = sorted((-s, j) for j, s in enumerate(exact[i].tolist()) if lows[i, 0] <= s <= highs[i, 0])[:10]
        assert sorted((-s, r) for a, _, r, s in zip(*(c.tolist() for c in found)) if a == i) == want
    pairs, partly, products = (sum(c) for c in zip(*counts))
    assert partly < 0.3 * pairs and products < 0.05 * pairs


def test_integer_products_beyond_doubles():
    random.seed(1)
    big = 1 << 27
    q = np.array([[big, 1, 0]], np.int64)
    rows = np.array([[big, i, 7] for i in range(50)], np.int64)
    found = negatives.windowed_top(q, np.full((1, 1), negatives.LOW), np.full((1, 1), negatives.HIGH), rows, np.arange(50), np.zeros((1, 50), bool), np.eye(3), 3)
    assert found[2].tolist() == [49, 48, 47] and found[3].tolist() == [big * big + i for i in (49, 48, 47)]
