"""Whitening against numpy's eigenvectors of the covariance, and exact integers."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from lakeops.llm import whitening
from lakeops.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, n string, component string"


def _plain(vectors, scale=256):
    """Rows, sums, covariance's eigenvalues and vectors, falling."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in kept), default=0)
    kept = [(i, v + [0] * (dim - len(v))) for i, v in kept]
    fit = [list(v) for v in {tuple(v) for _, v in kept}]
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * x - s) / n for x, s in zip(v, sums)] for v in fit]).reshape(n, dim)
    values, turned = np.linalg.eigh(centred.T @ centred / n) if n else (np.zeros(0), np.zeros((0, 0)))
    return kept, n, sums, values[::-1], turned[:, ::-1]


def _check(rows, vectors, tolerance=1e-9, components=4):
    kept, n, sums, values, turned = _plain(vectors)
    dim = len(sums)
    own: dict = {}
    for i, v in kept:
        own.setdefault(i, []).append(v)
    assert len(rows) == len(kept) * min(components, dim)
    varies = [k for k in range(min(components, dim)) if values[k] > 1e-12 * max(values[0], 1e-300) and values[0] > 0]
    for k in range(min(components, dim)):
        part = [r for r in rows if r["component"] == k + 1]
        assert all(r["n"] == n and r["identity_error"] <= 1e-9 for r in part)
        if k not in varies:
            assert all(r["whitened"] is None and r["explained"] == 0 for r in part)
            continue
        assert all(r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9) for r in part)
        got = {}
        for r in part:
            got.setdefault(r["vec_id"], []).append((r["deviation"], r["whitened"]))
        sign = 0
        for i, found in got.items():
            want = sorted((sum((n * x - s) ** 2 for x, s in zip(v, sums)), float(sum((x - s / n) * c for x, s, c in zip(v, sums, turned[:, k])) / math.sqrt(values[k]))) for v in own[i])
            assert sorted(d for d, _ in found) == [d if d < 1 << 63 else None for d, _ in want]
            if len(want) == 1:
                a, b = found[0][1], want[0][1]
                if not sign and abs(b) > 0.1:
                    sign = math.copysign(1, a * b)
                assert a == pytest.approx((sign or 1) * b, abs=tolerance)


def _run(spark, vectors, **how):
    return whitening.whitened(spark.createDataFrame([(i, v, "x", "y") for i, v in vectors], SCHEMA), **how).collect()


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 300)
    monkeypatch.setattr(whitening, "BATCH_ROWS", 7)
    rng = np.random.default_rng(1)
    spread = np.array([9, 6, 4, 2.5, 1, 0.5, 0.1])
    vectors = [(k, [float(x) for x in rng.standard_normal(7) * spread]) for k in range(300)]
    vectors += [(1000 + k, vectors[3][1]) for k in range(200)]
    vectors += [(2000, None), (2001, [None] * 7), (2002, [float("nan")] * 7), (2003, [1.0, float("inf")]), (2004, [0.5, 0.25]), (None, vectors[5][1]), (7, vectors[9][1])]
    _check(_run(spark, vectors), vectors)
    _check(_run(spark, vectors, components=7), vectors, components=7)


def test_few_directions(spark):
    """Rank below the number of components, repeated values, a single vector, fewer dimensions than components."""
    rng = np.random.default_rng(2)
    flat = [(k, [float(a), float(b), float(a + b), 0.0, 1.0]) for k, (a, b) in enumerate(rng.integers(-5, 6, (80, 2)) * [4, 1])]
    _check(_run(spark, flat), flat)
    _check(_run(spark, [(1, [1.0, 2.0, 3.0])] * 3), [(1, [1.0, 2.0, 3.0])] * 3)
    thin = [(k, [float(k % 7), float(k % 3)]) for k in range(21)]
    _check(_run(spark, thin), thin)


def test_no_vectors(spark):
    assert _run(spark, []) == [] and _run(spark, [(1, None), (2, [])]) == []


def test_sums_beyond_a_long(spark):
    vectors = [(k, [float(x) * 2.0**40 for x in v]) for k, v in enumerate(np.random.default_rng(3).standard_normal((50, 4)) * [8, 4, 2, 1])]
    _check(_run(spark, vectors), vectors)


def test_the_query_over_its_whole_table(spark):
    path = "/root/testdata/sf0.01"
    vectors = duckdb.sql(f"select vec_id, embedding::double[] from '{path}/embeddings.parquet'").fetchall()
    _check(QUERIES["op11_whitening"](spark, path).collect(), vectors)
