from fractions import Fraction

import pytest

from tessera.llm import op07_mixing as op


def simulate(slots):
    """Earliest deadline first, one slot at a time."""
    c, done, out = sum(slots), [0] * len(slots), []
    for t in range(c):
        ready = [(-(-(done[i] + 1) * c // w), i) for i, w in enumerate(slots) if done[i] * c // w <= t]
        _, i = min(ready)
        done[i] += 1
        out.append(i)
    return out


@pytest.mark.parametrize("weights", [[1], [1, 1], [5, 3, 2], [700, 1, 1, 298], [333, 333, 334], [7, 11, 13, 17, 19, 2]])
def test_cycle_is_the_simulated_one(spark, weights):
    df = spark.createDataFrame([(f"s{i:02}", w) for i, w in enumerate(weights)], "source string, weight long")
    rows = sorted(op.cycle(df, 200).collect())
    got = {t: i for i, r in enumerate(rows) for t in r.plan}
    want = simulate([r.slots for r in rows])
    assert [got[t] for t in range(len(want))] == want
    c = rows[0].cycle
    for i, r in enumerate(rows):
        n = 0
        for t in range(c):
            n += want[t] == i
            assert abs(n - Fraction(r.slots * (t + 1), c)) < 1


def test_whole_mixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source", "text")
    got = op.mix(docs).select("doc_id", "source", "mix_slot", "mix_release", "mix_deadline", "mix_position", "text").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.collect())
    assert len({r.mix_position for r in got}) == len(got)
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in got)
    assert len({(r.mix_slot, r.source) for r in got}) == len({r.mix_slot for r in got})


def test_edges(spark):
    rows = [(1, None), (2, None), (3, "a"), (3, "a"), (None, "a"), (4, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, source string").selectExpr("*", "'x' as slots", "1 as weight", "2 as cycle")
    got = op.mix(docs).collect()
    assert len(got) == 6 and len({r.mix_position for r in got}) == 6 and {r.weight for r in got} == {1}
    assert op.mix(docs.limit(0)).count() == 0
    weights = spark.createDataFrame([("a", 3), ("c", 9), ("d", 0)], "source string, weight long")
    left = op.mix(docs, weights).collect()
    assert len(left) == 6 and sum(r.mix_position is None for r in left) == 3


def test_many_small_sources_keep_their_weights(spark):
    n = 2100
    weights = spark.createDataFrame([("big", n)] + [(f"s{i:04}", 1) for i in range(n)], "source string, weight long")
    rows = [(i, "big") for i in range(16 * n // 10)] + [(i, f"s{i % n:04}") for i in range(2 * n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = op.mix(docs, weights, block=1).collect()
    assert len(got) == len(rows) and len({r.mix_position for r in got}) == len(rows)
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in got)
    big = sorted(r.mix_slot for r in got if r.source == "big")
    assert all(abs(k + 1 - Fraction(t + 1, 2)) < 2 for k, t in enumerate(big))  # half of the slots, not a third
    small = {}
    for r in got:
        if r.source != "big":
            small.setdefault(r.source, []).append(r.mix_slot)
    assert all(0 <= a < 2 * n <= b < 4 * n for a, b in map(sorted, small.values()))


def test_columns_of_the_same_names(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(50)], "doc_id long, source string")
    want = {r.doc_id: r.mix_position for r in op.mix(docs).collect()}
    clash = docs.selectExpr("*", "'x' as mix_slots", "7 as MIX__n", "8 as by__before", "9 as held__0", "1 as mix_position")
    got = op.mix(clash).collect()
    assert {r.doc_id: r.mix_position for r in got} == want
    assert {(r.MIX__n, r.by__before, r.held__0, r.mix_slots) for r in got} == {(7, 8, 9, got[0].mix_slots)} and got[0].mix_slots != "x"
