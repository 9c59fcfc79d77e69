"""Whitening against the eigenvectors of the plain covariance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import whitening
from gridloom.llm.queries import queries

DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=4):
    """(vec_id, component) -> (n, deviation, whitened, explained): integers and a dense eigenproblem."""
    x = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in rows}
    fit = [list(t) for t in {tuple(v) for v in x.values()}]
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    c = np.array([[n * a - b for a, b in zip(v, s)] for v in fit], float) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, v in x.items():
        d = [n * a - b for a, b in zip(v, s)]
        for j in range(min(k, len(s))):
            out[i, j + 1] = (n, sum(a * a for a in d), float(np.dot(np.array(d) / n, vectors[:, j]) / math.sqrt(values[j])) if values[j] > 1e-9 else None, values[j] / values.sum() if values.sum() else 0.0)
    return out


def check(got, want, tolerance=1e-9):
    assert sorted((r.vec_id, r.component) for r in got) == sorted(want)
    sign = {}
    for r in got:
        n, deviation, white, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and r.identity_error <= 1e-4
        assert abs(r.explained - explained) <= 1e-4 * explained
        if white is None:
            assert r.whitened is None
        elif abs(white) > 1e-6:
            sign.setdefault(r.component, np.sign(white) * np.sign(r.whitened))
            assert abs(r.whitened * sign[r.component] - white) <= tolerance * max(1, abs(white))
    return sign


def test_table_without_clusters_is_expanded(spark):
    table = spark.read.parquet(f"{DIR}/embeddings.parquet")
    check(queries()["op11_randomised_whitening"](spark, DIR).collect(), plain([(r.vec_id, r.embedding) for r in table.collect()]))
    x = table.select(whitening.quantised(F.col("embedding")).alias("v")).distinct()
    (fit,) = whitening.fit_whitening(x).values()
    assert fit.expanded and fit.passes <= 5


def test_decaying_spectrum_stays_thin(spark):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((400, 40)) * np.array([9.0, 6, 4, 2.5, *[0.05] * 36]) @ np.linalg.qr(rng.standard_normal((40, 40)))[0]
    rows = [(i, [float(c) for c in r]) for i, r in enumerate(v)]
    table = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(5)
    x = table.select(whitening.quantised(F.col("embedding")).alias("v")).distinct()
    (fit,) = whitening.fit_whitening(x).values()
    assert not fit.expanded and 2 <= fit.passes <= 8
    check(whitening.whiten(table).collect(), plain(rows))


@pytest.mark.parametrize("rows", [[(1, [0.5, 0.25]), (2, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, [0.0, -0.0, 1.0])], [(1, [0.5, 0.1]), (2, [0.1, 0.5])]])
def test_no_variance_and_few_components(spark, rows):
    got = whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    want = plain(rows)
    assert len(got) == len(rows) * len(rows[0][1])
    for r in got:
        n, deviation, white, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and (r.whitened is None) == (white is None) and math.isclose(r.explained, explained, abs_tol=1e-9)


def test_nulls_repeats_lengths_and_extra_columns(spark):
    rng = np.random.default_rng(6)
    good = [(i, rng.standard_normal(6).tolist()) for i in range(40)]
    other = [(100 + i, rng.standard_normal(3).tolist()) for i in range(9)]
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (203, [float("nan")] * 6), (204, [float("inf")] * 6)]
    rows = [(*r, None) for r in good + other + bad + good[:5]] + [(None, good[0][1], 3)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS v", "2 AS size", "3 AS component", "4 AS n")
    got = whitening.whiten(table).collect()
    named = [r for r in got if r.vec_id is not None]
    assert len(got) - len(named) == 4 and {r.vec_id for r in got if r.n == 40} == {None, *range(40)}
    assert sum(r.vec_id == 2 for r in got) == 8
    check([r for r in {(r.vec_id, r.component): r for r in named if r.n == 40}.values()], plain(good))
    check([r for r in named if r.n == 9], plain(other))
    empty = whitening.whiten(table.limit(0))
    assert empty.columns == [c.split()[0] for c in whitening.RESULT.split(", ")] and empty.count() == 0


def test_large_entries(spark):
    rows = [(1, [1e13, 0.0]), (2, [-1e13, 1.0]), (3, [2.0, 3.0])]
    want = {1: None, 2: None}
    x = [[math.floor(256 * float(np.float32(c))) for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    want[3] = sum((3 * a - b) ** 2 for a, b in zip(x[2], s))
    got = whitening.whiten(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    assert {r.vec_id: r.deviation for r in got} == {k: v if v is None or v < 1 << 63 else None for k, v in want.items()}
