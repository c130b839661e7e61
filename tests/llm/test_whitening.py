from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from orderloom.llm.queries import QUERIES
from orderloom.llm.whitening import exact_products, on_grid, one_sided_jacobi, packed, pivoted_cholesky, unpacked, whitened

SCHEMA = "vec_id long, embedding array<float>"


def brute_force(rows: list[tuple], components: int = 16) -> dict:
    """vec_id, component -> n, deviation, |whitened|, explained; every vector of one length."""
    kept = [(i, v) for i, v in rows if v is not None and all(e is not None and math.isfinite(e) for e in v)]
    x = [(i, tuple(math.floor(64 * np.float64(np.float32(e))) + 1_000_000 for e in v)) for i, v in kept]
    fit = sorted({v for _, v in x})
    n, d = len(fit), len(fit[0])
    sums = [sum(v[k] for v in fit) for k in range(d)]
    mean = [Fraction(s, n) for s in sums]
    centred = np.array([[float(e - m) for e, m in zip(v, mean)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    out = {}
    for i, v in x:
        deviation = sum((n * e - s) ** 2 for e, s in zip(v, sums))
        place = np.array([float(e - m) for e, m in zip(v, mean)])
        for c in range(1, min(components, d) + 1):
            value, axis = values[-c], vectors[:, -c]
            if value > 1e-9 * values[-1]:
                out.setdefault((i, c), []).append((n, deviation, abs(place @ axis) / math.sqrt(value), value / values.sum()))
    return out


def compared(got, expected):
    found = {}
    for r in got:
        found.setdefault((r.vec_id, r.component), []).append(r)
    assert found.keys() == expected.keys()
    for key, rows in found.items():
        assert len(rows) == len(expected[key])
        ours = sorted((r.n, r.deviation, abs(r.whitened), r.explained) for r in rows)
        for (n, deviation, value, explained), e in zip(ours, sorted(expected[key])):
            assert (n, deviation) == e[:2]
            assert value == pytest.approx(e[2], abs=1e-8) and explained == pytest.approx(e[3], rel=1e-9)
    assert all(r.identity_error < 1e-9 for rows in found.values() for r in rows)


def test_the_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compared(QUERIES["op11_whitening"](spark, folder).collect(), brute_force(rows))


def test_edges(spark):
    rng = np.random.default_rng(5)
    base = [[float(e) for e in v] for v in rng.normal(0, [1, 2, 0.5, 3, 0.1], (40, 5))]
    rows = [(k, v) for k, v in enumerate(base)] + [(100 + k, base[0]) for k in range(200)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0]), (302, [math.nan] * 5), (303, [math.inf, 0.0, 0.0, 0.0, 0.0]), (None, base[1]), (7, base[2])]
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], SCHEMA + ", n int, WHITENED double").repartition(5)
    got = whitened(df).withColumnRenamed("id", "vec_id")
    compared(got.collect(), brute_force(rows))
    signs = {(r.component, r.whitened) for r in got.collect() if r.vec_id in (0, 100, 299)}
    assert len(signs) == 5  # rows that repeat get the same


def test_no_variance_and_no_rows(spark):
    assert whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, []), (4, None)], SCHEMA)
    assert whitened(same).collect() == []
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 5.0]) for k in range(6)], SCHEMA)
    rows = whitened(line).collect()
    assert {r.component for r in rows} == {1} and all(r.explained == pytest.approx(1) for r in rows)
    assert sum(r.whitened**2 for r in rows) / 6 == pytest.approx(1)


def test_lengths_are_spaces_of_their_own(spark):
    rows = [(k, [float(k % 4), float(k % 3)]) for k in range(12)] + [(20 + k, [float(k), 1.0 - k * k, 0.5 * k]) for k in range(5)]
    got = whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(len(dict(rows)[r.id]), r.n) for r in got} == {(2, 12), (3, 5)}


def test_huge_entries_stay_exact(spark):
    rows = [(k, [1e30 * (-1) ** k, float(k)]) for k in range(4)]
    got = whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [r.component for r in got] == [1] * 4  # beside 2^62 the second direction is rounding
    assert all(r.deviation is None and abs(r.whitened) == pytest.approx(1) for r in got)


def test_packed_rows_are_canonical():
    x = np.array([[1, -2], [1, -2], [70_000, 0], [1 << 40, -1]])
    rows = packed(x)
    assert rows[0] == rows[1] and [r[0] for r in rows] == [2, 2, 4, 8]
    assert np.array_equal(np.sort(unpacked(rows)[2], 0), np.sort(x, 0))
    assert on_grid(np.array([-0.001, 1e300])).tolist() == [-1, 1 << 62]


def test_products_are_exact_at_any_size():
    for scale in (10, 1 << 24, 1 << 30, 1 << 62):
        x = np.random.default_rng(1).integers(-scale, scale, (50, 3))
        assert (exact_products(x) == x.astype(object).T @ x.astype(object)).all()


def test_factor_and_rotation():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(30, 9)) @ np.diag([1, 1, 5, 10, 0.01, 3, 3, 2, 1]) @ rng.normal(size=(9, 12))
    v = a.T @ a
    factor = pivoted_cholesky(v)
    assert factor.shape == (12, 9) and np.allclose(factor @ factor.T, v, rtol=1e-12, atol=1e-9)
    turned = one_sided_jacobi(factor)
    gram = turned.T @ turned
    assert np.abs(gram - np.diag(gram.diagonal())).max() < 1e-12 * gram.max()
    assert np.allclose(np.sort(gram.diagonal()), np.linalg.eigvalsh(v)[3:], rtol=1e-10)
