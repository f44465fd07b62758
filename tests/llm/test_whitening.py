"""Whitening against a dense symmetric solver and exact integers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratastar.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def taken(rows):
    return [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def check(spark, rows, k=8):
    """Every returned value against whole numbers and numpy's dense solver."""
    df = frame(spark, rows).withColumn("component", F.lit("clash")).withColumn("vector", F.lit(1)).repartition(5)
    got = whitening.whitened(df, k).collect()
    used = taken(rows)
    n, width = len(used), max((len(v) for _, v in used), default=0)
    if not n or not width:
        assert got == []
        return None
    x = [[math.floor(1024 * c) + 100_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in used]
    total = [sum(column) for column in zip(*x, strict=True)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, total, strict=True)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, total, strict=True)] for row in x])
    _, sizes, vectors = np.linalg.svd(centred)
    values, vectors = np.append(sizes**2 / n, np.zeros(width - len(sizes))), vectors.T
    assert len(got) == n * min(k, width) and {r.n for r in got} == {n}
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() <= 1e-10
    by_component = {}
    for r in got:
        by_component.setdefault(r.component, []).append(r)
    assert sorted(by_component) == list(range(1, min(k, width) + 1))
    key = lambda i, d: (i is None, i or 0, d is None, d or 0)
    for number, mine in by_component.items():
        expected = sorted(((i, d if d < 2**63 else None) for (i, _), d in zip(used, deviations, strict=True)), key=lambda p: key(*p))
        assert sorted(((r.vec_id, r.deviation) for r in mine), key=lambda p: key(*p)) == expected
        e = values[number - 1]
        if e <= values[0] * 1e-24 or values[0] <= 0:
            assert all(r.whitened is None and r.explained == 0 for r in mine)
            continue
        assert all(abs(r.explained * values.sum() / e - 1) < 1e-8 for r in mine)
        alone = all(abs(v - e) > 1e-6 * e for j, v in enumerate(values) if j != number - 1)
        if alone:
            y = centred @ vectors[:, number - 1] / np.sqrt(e)
            have = sorted(r.whitened for r in mine)
            assert min(np.abs(np.sort(sign * y) - have).max() for sign in (1, -1)) < 1e-7
    return by_component


def test_against_a_dense_solver(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 40)
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(1)
    turn = rng.normal(size=(12, 12))
    rows = [(i, (rng.normal(size=12) @ turn).tolist()) for i in range(300)]
    rows += [(2000, None), (2001, [1.0] * 11 + [float("nan")]), (2002, [float("inf")] * 12), (2003, [None] * 12), (None, rows[3][1]), (7, rows[7][1]), (7, rows[8][1])]
    rows += [(3000, []), (3001, [1.0, 2.0]), (3002, [0.0] * 12)]
    check(spark, rows)
    check(spark, rows, k=20)


def test_large_components_and_few_rows(spark):
    rng = np.random.default_rng(2)
    check(spark, [(i, (rng.normal(size=5) * 1e7).tolist()) for i in range(60)])
    check(spark, [(i, rng.normal(size=9).tolist()) for i in range(4)])
    check(spark, [(i, [1.0, 2.0]) for i in range(5)])
    check(spark, [(1, [0.5])])
    check(spark, [(1, []), (2, None)])
    check(spark, [])
    assert whitening.whitened(frame(spark, [(1, [1e300]), (2, [-1e300])])).count() == 2


MATRICES = {
    "random": np.random.default_rng(3).normal(size=(50, 50)),
    "alike": 3 * np.eye(30),
    "groups": np.diag([5.0] * 4 + [5 * (1 - 1e-9)] * 3 + [1.0] * 20),
    "graded": np.diag(10.0 ** -np.arange(40)),
    "rank one": np.outer(np.ones(12), np.arange(12.0)),
    "ones": np.triu(np.ones((40, 40))),
    "zero": np.zeros((6, 6)),
    "pairs": np.linalg.cholesky(np.diag(np.abs(np.arange(-10.0, 11)) + 20) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)).T,
}


@pytest.mark.parametrize("turned", [False, True])
@pytest.mark.parametrize("name", MATRICES)
def test_solver(name, turned):
    r = MATRICES[name]
    d = len(r)
    if turned:
        r = r @ np.linalg.qr(np.random.default_rng(4).normal(size=(d, d)))[0]
    true = np.linalg.svd(r)[1] ** 2
    diagonal, above, right = whitening.bidiagonalised(r)
    assert np.abs(right.T @ right - np.eye(d)).max() < 1e-13
    assert np.abs(whitening.squared_singular_values(diagonal, above) - true).max() <= 1e-13 * max(true[0], 1e-300)
    values, vectors = whitening.directions(r, 8)
    assert len(values) == min(8, int((true > true[0] * (64 * 2.3e-16 * d) ** 2).sum()) if true[0] else 0)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-12
    assert np.abs(r.T @ (r @ vectors) - vectors * values).max(initial=0) < 1e-12 * max(true[0], 1e-300)


def test_small_singular_values_keep_their_digits():
    """A graded bidiagonal matrix: every value has full relative accuracy, which R'R would lose."""
    diagonal, above = 10.0 ** -np.arange(12.0), 10.0 ** -np.arange(12.0)[:-1] / 3
    found = np.sqrt(whitening.squared_singular_values(diagonal, above))
    assert abs(np.prod(found / diagonal) - 1) < 1e-12
    assert found[-1] < 1e-11
