from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.llm.embedding_whitening import Factors, Slices, op13_embedding_whitening

SMALL = "/root/testdata/sf0.001"


def symmetric(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values, float)) @ q.T


@given(st.integers(1, 30), st.integers(0, 10**6))
@settings(max_examples=200, deadline=None)
def test_counts_and_solutions_of_factors(n, seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((n, n)) * 10 ** rng.uniform(-3, 3)
    a = a + a.T
    if seed % 3 == 0:
        a[np.diag_indices(n)] = 0
    found = Factors(a, 1e-300)
    values = np.linalg.eigvalsh(a)
    if np.abs(values).min() > 1e-9 * np.abs(values).max():
        assert found.positive == (values > 0).sum()
        b = rng.standard_normal(n)
        assert np.allclose(a @ found.solve(b), b, atol=1e-6 * max(1, np.abs(values).max() / np.abs(values).min()))


SPECTRA = {
    "spread": [100 / 2**k for k in range(24)],
    "close": [5 + 1e-7 * k for k in range(20)],
    "equal": [3.0] * 5 + [1.0] * 7 + [0.5] * 8,
    "deficient": [9, 4, 1] + [0] * 17,
    "pairs": [7, 7, 6, 6, 5, 5, 4, 4, 3, 3, 2, 2, 1, 1, 0.9, 0.9, 0.8, 0.8],
    "flat": [1.0] * 30,
    "one": [2.0],
    "steep": [1e12, 1e6, 1, 1e-1],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading_pairs(name):
    values = sorted(SPECTRA[name], reverse=True)
    v = symmetric(values, 5)
    found, vectors = Slices(v).leading(16)
    some = sum(x > 1e-9 * values[0] for x in values[:16])
    norm = values[0]
    assert len(found) == some or name == "steep"
    assert np.allclose(found, values[: len(found)], atol=1e-12 * norm * len(values))
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-12)
    assert np.linalg.norm(v @ vectors - vectors * found, axis=0).max() <= 1e-12 * norm * len(values)


def test_zero_matrix():
    found, vectors = Slices(np.zeros((4, 4))).leading(16)
    assert len(found) == 0 and vectors.shape == (4, 0)


def expected(rows, dimension):
    """(n, deviation by row, whitened, explained) with numpy's own eigenvectors."""
    kept = []
    for key, v in rows:
        if v is not None and len(v) == dimension and all(c is not None and math.isfinite(c) for c in v):
            kept.append((key, [math.floor(64 * c) + 1_000_000 for c in v]))
    distinct = sorted({tuple(x) for _, x in kept})
    n, s = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    y = np.array([[c - t / n for c, t in zip(x, s, strict=True)] for x in distinct])
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for key, x in kept:
        deviation = sum((n * c - t) ** 2 for c, t in zip(x, s, strict=True))
        z = np.array([c - t / n for c, t in zip(x, s, strict=True)])
        out[key] = (deviation, z @ vectors[:, :16] / np.sqrt(np.maximum(values[:16], 1e-300)))
    return n, out, values[:16] / np.trace(v)


def compare(got, n, want, explained, components):
    rows = defaultdict(dict)
    for r in got:
        assert r.n == n and r.identity_error <= 1e-9
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        rows[r.vec_id][r.component] = r
    assert rows.keys() == want.keys()
    signs = np.zeros(components)
    for key, (deviation, white) in want.items():
        mine = [rows[key][k + 1] for k in range(components)]
        assert len(rows[key]) == components and {r.deviation for r in mine} == {deviation}
        w = np.array([r.whitened for r in mine])
        signs = np.where((signs == 0) & (np.abs(white[:components]) > 1e-3), np.sign(w * white[:components]), signs)
        assert np.allclose(w, np.where(signs == 0, 1, signs) * white[:components], atol=1e-6)


def test_query(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    compare(op13_embedding_whitening(table).collect(), *expected(rows, 64), 16)


KIND = "vec_id long, embedding array<double>, key string, x binary, whitened long, dimension string"


def odd_table(spark, rows):
    return spark.createDataFrame([(i, v, "k", b"x", 1, "d") for i, v in rows], KIND)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(k, (rng.standard_normal(5) * [9, 5, 3, 2, 1]).tolist()) for k in range(60)]
    rows += [(100 + k, rows[k % 3][1]) for k in range(40)]
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [1.0, float("nan"), 0.0, 0.0, 0.0])]
    rows += [(204, [float("inf")] + [0.0] * 4), (205, [1.0, 2.0]), (206, [1e300] + [0.0] * 4)]
    want = [r for r in rows if r[0] not in (205, 206)]
    got = op13_embedding_whitening(odd_table(spark, rows).repartition(7)).collect()
    compare(got, *expected(want, 5), 5)


def test_tables_without_variance(spark):
    assert op13_embedding_whitening(odd_table(spark, [])).count() == 0
    assert op13_embedding_whitening(odd_table(spark, [(1, None), (2, [])])).count() == 0
    assert op13_embedding_whitening(odd_table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_repeated_ids_and_dimensions_that_do_not_vary(spark):
    rows = [(1, [float(k), 5.0, -2.0 * k, 1.0]) for k in range(30)]
    got = op13_embedding_whitening(odd_table(spark, rows)).collect()
    assert len(got) == 30 and {r.component for r in got} == {1}
    assert got[0].explained == pytest.approx(1)
    assert np.mean([r.whitened**2 for r in got]) == pytest.approx(1)


def test_deviation_of_large_entries(spark):
    rows = [(k, [float(k) * 2.0**34, 1.0]) for k in range(4)] + [(9, [0.25, 3.0])]
    n, want, _ = expected(rows, 2)
    got = {r.vec_id: r.deviation for r in op13_embedding_whitening(odd_table(spark, rows)).collect()}
    assert got == {k: d if d < 1 << 63 else None for k, (d, _) in want.items()}
    rows = [(k, [float(k) * 2.0**20, 1.0]) for k in range(4)] + [(9, [0.25, 3.0])]
    n, want, _ = expected(rows, 2)
    got = {r.vec_id: r.deviation for r in op13_embedding_whitening(odd_table(spark, rows)).collect()}
    assert got == {k: d for k, (d, _) in want.items()} and max(got.values()) < 1 << 63
