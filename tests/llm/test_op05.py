from fractions import Fraction
from math import floor

import numpy as np
import pytest

from tessera.llm import op05_topk as op


def brute(rows, k, every):
    able = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for i, q in able:
        if i % every == 0:
            best = sorted((-int(q @ v), j) for j, v in able if j != i and len(v) == len(q))[:k]
            yield from ((i, r + 1, j, -s) for r, (s, j) in enumerate(best))


@pytest.mark.parametrize("blocks", [(2048, 1024), (37, 5)])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(op, "CANDIDATE_BLOCK", blocks[0])
    monkeypatch.setattr(op, "QUERY_BLOCK", blocks[1])
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=16) * (1 + i % 3)]) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(60)]  # one common vector
    rows += [(-20, [0.0] * 16), (500, None), (501, [None] * 16), (520, [float("nan")] * 16), (540, [1.0, 2.0]), (541, [3.0, 4.0]), (560, []), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as rank", "2 as score")
    assert sorted(map(tuple, op.top_k(df).collect())) == sorted(brute(rows, 20, 20))


def test_stops_early_and_stays_exact():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-20, 20, (3000, 32)), rng.integers(60, 90, (40, 32))])
    block = op.Block(np.arange(3040), x / 64)
    q = rng.integers(-5, 50, (30, 32))
    own = np.arange(30)
    want = [(i, j, q[i] @ x[j]) for i in range(30) for _, j in sorted((-(x[j] @ q[i]), j) for j in range(3040) if j != i)[:20]]
    got = lambda: sorted(zip(*map(list, block.best(own, q / 64, 20))))
    assert got() == sorted(want)
    block.kinds[np.float64][:3000] = 0  # the far candidates are not read again: the lists have settled them
    assert got() == sorted(want)


@pytest.mark.parametrize("kind", ["normal", "skewed", "clustered"])
def test_few_candidates_are_resolved(kind):
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(4000, 64)) * 8)
    if kind == "skewed":
        x = np.floor(rng.exponential(9, (4000, 64)) ** 1.5)
    if kind == "clustered":
        x += rng.integers(0, 40, (10, 64))[rng.integers(0, 10, 4000)]
    block = op.Block(np.arange(4000), x / 64)
    own = np.arange(0, 4000, 40)
    i, rows, score = block.best(own, x[own] / 64, 20)
    want = x[own] @ x.T
    want[np.arange(100), own] = -np.inf
    assert np.array_equal(np.array(score).reshape(100, 20), -np.sort(-want, 1)[:, :20])
    assert block.resolved < 100 * 4000 * op.FEW and block.read < 0.95 * 100 * 4000 * 64


@pytest.mark.parametrize("size", [1e3, 2.0**22, 1e9, 1e30, 1e308])
def test_large_components(spark, size):
    rng = np.random.default_rng(int(np.log2(size)))
    rows = [(i, (rng.uniform(-1, 1, 6) * (size if i % 3 else 1)).tolist()) for i in range(150)]
    found = op.search(op.integers(spark.createDataFrame([r for r in rows if r[0] % 20 == 0], "vec_id long, embedding array<double>")),
                      op.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score if r.beyond is None else int.from_bytes(r.beyond, "big") - op.OFFSET) for r in found.collect())
    whole = {i: [floor(Fraction(c) * 64) for c in v] for i, v in rows}
    want = []
    for i in range(0, 150, 20):
        best = sorted((-sum(a * b for a, b in zip(whole[i], whole[j])), j) for j in whole if j != i)[:20]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert got == want
    assert any(r.beyond is not None for r in found.collect()) == (size > 1e8)


def test_empty_and_large(spark):
    assert op.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    rows = op.top_k(spark.createDataFrame([(0, [1e9]), (1, [2.0]), (20, [-1e9])], "vec_id long, embedding array<float>")).collect()
    assert [tuple(r) for r in rows if r.query_id == 0] == [(0, 1, 1, 8192 * 10**9), (0, 2, 20, None)]  # a score beyond 64 bits keeps its rank
