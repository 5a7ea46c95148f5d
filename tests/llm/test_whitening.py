"""Whitening against exact fractions and numpy."""

from __future__ import annotations

import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from hearth.llm import whitening
from hearth.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(rows, components=16):
    """(x of each usable row, n, sums, covariance, eigenvalues and -vectors) directly."""
    xs = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = [[n * a - s for a, s in zip(x, sums, strict=True)] for x in fit]
    dims = len(sums)
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n ** 3)) for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(cov)
    return xs, n, sums, cov, values[::-1][:components], vectors[:, ::-1][:, :components]


def check(got, rows, components=16):
    xs, n, sums, cov, values, vectors = plain(rows, components)
    mean = [Fraction(s, n) for s in sums]
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    ids = [i for i, _ in xs]
    assert sorted(by, key=str) == sorted(set(ids), key=str)
    signs = {}
    for i, x in xs:
        z = np.array([float(a - m) for a, m in zip(x, mean, strict=True)])
        for k in range(len(values)):
            found = by[i][k + 1]
            assert len(found) == ids.count(i)
            r = found[0]
            want = z @ vectors[:, k] / math.sqrt(values[k])
            if abs(want) > 1e-3:
                assert signs.setdefault(k, r.whitened * want > 0) == (r.whitened * want > 0)
            assert abs(abs(r.whitened) - abs(want)) < 1e-6 and r.n == n
            assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
            assert abs(r.explained - values[k] / np.trace(cov)) < 1e-9 and r.identity_error < 1e-6


def test_query(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    got = QUERIES["op13_whitening"](spark, SF).collect()
    assert len(got) == 16 * len(rows) and len({r.identity_error for r in got}) == 1
    check(got, rows)


def test_edges(spark):
    r = np.random.default_rng(4)
    rows = [(i, (r.normal(size=4) * [8, 4, 2, 1]).tolist()) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(200)] + [(7, rows[7][1])] * 3 + [(None, rows[9][1])]
    bad = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan")] * 4), (204, [1.0, 2.0, float("inf"), 0.0]),
           (205, [1.0, 2.0]), (206, [0.0] * 5)]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>").selectExpr(
        "*", "1 AS x", "2 AS n", "3 AS component", "4 AS size", "5 AS i", "'w' AS whitened").repartition(5)
    check(whitening.whiten_embeddings(df).collect(), rows)
    carried = whitening.whiten_embeddings(df, carry=["vec_id", "x", "n", "whitened"])
    assert carried.columns[:4] == ["vec_id", "x", "n", "whitened"] and "_whitened" in carried.columns and "_n" in carried.columns
    assert {(q.x, q.n, q.whitened) for q in carried.collect()} == {(1, 2, "w")}


def test_nothing_to_whiten(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert whitening.whiten_embeddings(make([])).collect() == []
    assert whitening.whiten_embeddings(make([(1, None)])).collect() == []
    assert whitening.whiten_embeddings(make([(1, [1.0, 2.0])] * 4)).collect() == []
    # two distinct vectors: one component
    got = whitening.whiten_embeddings(make([(1, [1.0, 2.0]), (2, [2.0, 2.0]), (3, [2.0, 2.0])])).collect()
    assert {(r.vec_id, r.component) for r in got} == {(1, 1), (2, 1), (3, 1)}
    assert sorted(abs(r.whitened) for r in got) == pytest.approx([1, 1, 1]) and {r.n for r in got} == {2}


def test_huge_entries_stay_exact(spark):
    rows = [(1, [1e300, 3e9]), (2, [-1e300, 5.0]), (3, [0.0, -7e9]), (4, [12345.678, 9.0])]
    got = whitening.whiten_embeddings(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    top = 1 << 40
    xs = {1: (top, 192_000_000_000), 2: (-top, 320), 3: (0, -448_000_000_000), 4: (math.floor(12345.678 * 64), 576)}
    sums = [sum(x[k] for x in xs.values()) for k in (0, 1)]
    for r in got:
        assert int(r.deviation) == sum((4 * a - s) ** 2 for a, s in zip(xs[r.vec_id], sums, strict=True))
    assert {r.component for r in got} == {1, 2} and all(r.identity_error < 1e-9 for r in got)


def test_polarisation_is_exact():
    r = np.random.default_rng(1)
    z = r.integers(-(1 << 33), 1 << 33, (50, 3)).tolist()
    n, sums = len(z), [sum(c) for c in zip(*z, strict=True)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    own = np.array([[a - c for a, c in zip(row, centre, strict=True)] for row in z], object)
    squares = {(i, j): whitening._square_sums(np.array([[row[i] + (row[j] if i != j else 0)] for row in own], np.int64))[0]
               for i in range(3) for j in range(i, 3)}
    got = whitening.covariance(n, sums, centre, squares)
    for i in range(3):
        for j in range(3):
            assert got[i][j] == sum((row[i] - Fraction(sums[i], n)) * (row[j] - Fraction(sums[j], n)) for row in z) / n
