import math

import numpy as np
import pytest

from tessera.llm import op12_whitening as op


def brute(rows):
    able = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(able), len(able[0][1])
    s = [sum(x[j] for _, x in able) for j in range(d)]
    z = [(i, [n * x[j] - s[j] for j in range(d)]) for i, x in able]
    cov = np.array([[sum(v[a] * v[b] for _, v in z) / n**3 for b in range(d)] for a in range(d)])
    return n, z, cov


def check(got, rows, k):
    n, z, cov = brute(rows)
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    assert len(got) == n * k
    by = {(r.vec_id, r.component): r for r in got}
    sign = {}
    for i, v in z:
        for c in range(1, k + 1):
            r = by[i, c]
            assert r.n == n and int(r.deviation_exact) == sum(t * t for t in v)
            assert r.deviation == (int(r.deviation_exact) if int(r.deviation_exact) < 1 << 63 else None)
            assert r.explained == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-8) and r.identity_error < 1e-8
            want = np.array(v, float) / n @ basis[:, c - 1] / math.sqrt(values[c - 1])
            if abs(want) > 1e-3:
                sign.setdefault(c, math.copysign(1, want * r.whitened))
            assert r.whitened == pytest.approx(sign.get(c, 1) * want, abs=1e-6)


def vectors(seed, n, d, scale):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=d) * scale + 5).astype(np.float32).tolist()) for i in range(n)]


def test_against_exact_brute_force(spark):
    rows = vectors(1, 300, 7, np.array([9.0, 5, 3, 2, 1, 0.5, 0.1]))
    bad = [(900, None), (901, [None] * 7), (902, [float("nan")] * 7), (903, [float("inf")] * 7), (904, []), (905, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").selectExpr("*", "1 as n", "2 as component", "3 as v").repartition(6)
    got = op.whiten(df).collect()
    assert {r.component for r in got} == set(range(1, 8))
    check(got, rows, 7)


def test_components_are_cut_and_values_may_be_huge(spark):
    rows = vectors(2, 50, 5, np.array([1e12, 5e11, 3e9, 2e6, 1e3]))
    rows = [(i, [float(c) for c in v]) for i, v in rows]
    got = op.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 2).collect()
    assert any(r.deviation is None for r in got)
    check(got, rows, 2)


def test_dependent_entries_have_no_component(spark):
    rows = [(i, [a, b, a]) for i, (_, (a, b)) in enumerate(vectors(3, 80, 2, np.array([4.0, 1.0])))]
    got = op.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    check(got, rows, 2)


def test_repeated_ids_equal_rows_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    rows = vectors(4, 40, 3, 2.0)
    twice = op.whiten(spark.createDataFrame([(None, v) for _, v in rows] * 2, schema))
    assert twice.count() == 80 * 3 and twice.first().n == 80
    assert op.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 5, schema)).count() == 0
    assert op.whiten(spark.createDataFrame([], schema)).count() == 0
    assert op.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0


def test_jacobi_keeps_small_eigenvalues_accurate():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    values = 10.0 ** -np.linspace(0, 9, 40)
    a = (q * values) @ q.T
    factor = op.pivoted_cholesky(a)
    assert np.allclose(factor @ factor.T, a, atol=1e-15)
    got, basis = op.one_sided_jacobi(factor)
    assert np.allclose(got, values, rtol=1e-5) and np.allclose(basis.T @ basis, np.eye(40), atol=1e-12)
    assert sorted((min(p, q), max(p, q)) for r in op.rounds(7) for p, q in zip(*r)) == [(i, j) for i in range(7) for j in range(i + 1, 7)]


@pytest.mark.parametrize("size", [1 << 20, 1 << 38, 1 << 61])
def test_products_are_exact(size):
    y = np.random.default_rng(6).integers(-size, size, (50, 4))
    want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(4)] for i in range(4)]
    assert op.exact_products(y).tolist() == want
    flat = np.array(want, object).ravel()
    assert [sum(int(p[i]) << 40 * k for k, p in enumerate(op.parts(flat))) for i in range(16)] == flat.tolist()
