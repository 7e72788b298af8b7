"""Whitening against exact integer arithmetic and a plain eigen solver."""

import math
from fractions import Fraction

import numpy as np
import pytest

from corpusmill.llm import whiten
from corpusmill.llm.queries import QUERIES


def integers(vector):
    return [math.floor(1024 * float(c)) + 100000 for c in vector]


def check_by_brute_force(rows, got, components=8):
    """``rows``: (id, vector) that remain; ``got``: rows of the query in any order."""
    x = [integers(v) for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(c) for c in zip(*x)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(r, sums)] for r in x])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    want = centred @ axes[:, :components] / np.sqrt(values[:components])
    kept = min(components, d)
    by = {(r.vec_id, r.component): r for r in got}
    assert len(by) == len(got) == n * kept
    sign = [math.copysign(1, sum(by[i, c + 1].whitened * want[k, c] for k, (i, _) in enumerate(rows))) for c in range(kept)]
    for k, (i, _) in enumerate(rows):
        deviation = sum((n * a - s) ** 2 for a, s in zip(x[k], sums))
        for c in range(kept):
            r = by[i, c + 1]
            assert (r.n, r.deviation) == (n, deviation)
            assert abs(r.whitened - sign[c] * want[k, c]) < 1e-9 and abs(r.explained - values[c] / cov.trace()) < 1e-12 and r.identity_error < 1e-10


def test_query_by_brute_force(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check_by_brute_force(rows, QUERIES["op11_whitening"](spark, sf_dir).collect())


def test_rows_that_do_not_count(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    nan, inf = float("nan"), float("inf")
    bad = [(90, None), (91, [1.0, None, 0.0, 0.0, 0.0]), (92, [nan] * 5), (93, [inf, 0.0, 0.0, 0.0, 0.0]), (94, []), (95, [1.0]), (96, [1e30] * 5)]
    table = spark.createDataFrame(good + bad, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as id", "'x' as n", "0 as whitened").repartition(4)
    check_by_brute_force(good, whiten.components_of(whiten.whiten(table)).withColumnRenamed("id", "vec_id").collect())


def test_degenerate_tables(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert whiten.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whiten.whiten(spark.createDataFrame([(1, None), (2, [None])], schema)).collect() == []
    same = whiten.whiten(spark.createDataFrame([(None, [0.5, 0.25]), (None, [0.5, 0.25])], schema)).collect()
    assert [(r.id, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(None, 2, 0, [None, None], [None, None], None)] * 2
    line = whiten.whiten(spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0])], schema)).collect()
    assert all(r.whitened[1] is None and abs(r.explained[0] - 1) < 1e-12 and r.identity_error < 1e-12 for r in line)
    assert sorted(round(abs(r.whitened[0]), 6) for r in line) == [0.707107, 0.707107, 1.414214]


def test_sums_that_leave_long_and_double(spark):
    rng = np.random.default_rng(4)
    wide = [(i, (rng.normal(size=3) * 2.0 ** 27).tolist()) for i in range(50)]
    got = whiten.whiten(spark.createDataFrame(wide, "vec_id bigint, embedding array<double>").repartition(3)).collect()
    x = [integers(v) for _, v in wide]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((50 * a - s) ** 2 for a, s in zip(r, sums)) for (i, _), r in zip(wide, x)}
    assert {r.id: r.deviation for r in got} == {i: v if v < 1 << 63 else None for i, v in want.items()}
    assert all(r.identity_error < 1e-12 for r in got)
    y = rng.integers(-(1 << 40), 1 << 40, (600, 3))
    assert (whiten._gram(y) == y.astype(object).T @ y.astype(object)).all()
    y = rng.integers(-(1 << 25), 1 << 25, (600, 3))
    assert (whiten._gram(y) == y.astype(object).T @ y.astype(object)).all()


@pytest.mark.parametrize("values", ["spread", "cluster", "equal", "graded", "singular"])
def test_refinement_reaches_double_precision(values):
    rng, n = np.random.default_rng(5), 48
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    d = {"spread": np.linspace(2, 1, n), "cluster": np.r_[1 + 1e-9 * np.arange(n // 2)[::-1], np.linspace(.9, .5, n - n // 2)],
         "equal": np.r_[np.ones(n // 2), np.linspace(.9, .5, n - n // 2)], "graded": 10.0 ** -np.linspace(0, 12, n),
         "singular": np.r_[np.linspace(2, 1, n // 2), np.zeros(n - n // 2)]}[values]
    v = (q * d) @ q.T
    v = (v + v.T) / 2
    found, x = whiten.refined_eigenvectors(v, np.zeros_like(v))
    wide = np.longdouble
    off = x.astype(wide).T @ (v.astype(wide) @ x.astype(wide))
    off -= np.diag(np.diag(off))
    assert np.abs(off).max() < 3e-16 and np.abs(x.T @ x - np.eye(n)).max() < 2e-15 and (np.diff(found) <= 0).all()
    start = np.linalg.eigh(v.astype(np.float32))[1].astype(wide)
    assert np.abs(start.T @ start - np.eye(n)).max() > 1e-9       # what the refinement began with


def test_products_keep_more_than_double_precision():
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=(20, 30)) * 10.0 ** rng.integers(-3, 3, (20, 30)), rng.normal(size=(30, 10))
    high, low = whiten.product(a, b)
    for i in range(0, 20, 5):
        for j in range(10):
            exact = sum(Fraction(x) * Fraction(y) for x, y in zip(a[i].tolist(), b[:, j].tolist()))
            assert abs(float(exact - Fraction(high[i, j]) - Fraction(low[i, j]))) < 1e-18 * np.abs(a[i]).max()
