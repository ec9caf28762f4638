import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import op11_collocations as op


def counts(rows):
    f = {}
    for lang, text in rows:
        c = f.setdefault(lang or "und", Counter())
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            c.update(tuple(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    return f


def brute(rows, least, top):
    for lang, f in counts(rows).items():
        n = sum(a for p, a in f.items() if len(p) == 1)
        able = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        out = []
        for p, a in able.items():
            if not any(len(q) > len(p) and b >= a and inside(p, q) for q, b in able.items()):
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                out.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], n))
        yield from ((lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r, n) in enumerate(sorted(out)[:top]))


def texts(seed, docs, words, lang=None):
    rng = np.random.default_rng(seed)
    vocabulary = ["a", "B", "c,", "d", "é", "É", "x\ty", "new york", "New York city.", "\x0b", "q!", "一", "zz\xa0top", "\x1c"]
    return [(lang or [None, "en", "de", "und"][i % 4], " ".join(rng.choice(vocabulary, words))) for i in range(docs)]


@pytest.mark.parametrize("shard_words", [64, 100, op.SHARD_WORDS])
def test_against_brute_force(spark, shard_words):
    rows = texts(1, 40, 90) + [("en", None), ("en", ""), (None, " \t. "), ("fr", "Only once"), *[("en", "again and Again and AGAIN")] * 30, ("en", "no cut at all " * 300), ("es", "one" + " one" * 700)]
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as number", "2 as shard", "3 as n").repartition(5)
    got = sorted(map(tuple, op.collocations(df, 7, 25, shard_words).collect()))
    assert got == sorted(brute(rows, 7, 25))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("op11_")]


@pytest.mark.parametrize("cells", [3, op.CELLS])
def test_all_counts_and_extensions(spark, monkeypatch, cells):
    monkeypatch.setattr(op, "CELLS", cells)  # with few cells, rare phrases pass them and the exact sums drop them
    rows = texts(2, 30, 60, "en")
    f = counts(rows)["en"]
    got = {tuple(r.phrase.split(" ")): r for r in op.phrases(spark.createDataFrame(rows, "lang string, text string"), 3, 64).collect()}
    assert {p: r["count"] for p, r in got.items()} == {p: a for p, a in f.items() if a >= 3}
    for p, r in got.items():
        assert r.firsts == [f[p[:k]] for k in range(1, len(p) + 1)] and r.lasts == [f[p[-k:]] for k in range(1, len(p) + 1)]
        more = [a for q, a in f.items() if len(q) == len(p) + 1 and a >= 3 and p in (q[1:], q[:-1])]
        assert r.longest == max(more, default=None)


def test_steps_give_the_intervals_of_both_orders():
    rng = np.random.default_rng(3)
    text = np.concatenate([[0], rng.integers(0, 4, 500), [0]])
    before, order = op.transform(text)
    size = np.bincount(text, minlength=4)
    lo = (np.cumsum(size) - size)[1:]
    owner, near, far, count = op.step(before, lo, lo, size[1:])
    back = op.suffix_order(text[::-1])
    for o, i, j, c in zip(owner, near, far, count):
        words = text[order[i] : order[i] + 2]
        assert words[1] == o + 1 and c == np.sum((text[:-1] == words[0]) & (text[1:] == words[1]))
        assert all((text[order[r] : order[r] + 2] == words).all() for r in range(i, i + c))
        assert all((text[::-1][back[r] : back[r] + 2] == words[::-1]).all() for r in range(j, j + c))


def test_steps_go_by_slices(monkeypatch):
    rng = np.random.default_rng(4)
    text = np.concatenate([[0], rng.zipf(1.3, 200_000) % 5000, [0]])
    before, _ = op.transform(text)
    size = np.bincount(text)[1:]
    lo = np.cumsum(size) + np.count_nonzero(text == 0) - size
    size, lo = size[size > 1], lo[size > 1]
    whole = [x.tolist() for x in op.step(before.astype("<u2"), lo, lo, size)]
    tracemalloc.start()
    peaks = []
    for words in (1 << 30, 1 << 10):
        monkeypatch.setattr(op, "STEP_WORDS", words)
        tracemalloc.reset_peak()
        held = tracemalloc.get_traced_memory()[0]
        n = sum(len(found[0]) for found in op.steps(before, lo, lo, size))
        peaks.append(tracemalloc.get_traced_memory()[1] - held)
        assert n == len(whole[0]) and [x.tolist() for x in op.step(before, lo, lo, size)] == whole
    tracemalloc.stop()
    assert peaks[1] < 0.7 * peaks[0]
    assert [len(x) for x in op.step(before, lo[:0], lo[:0], size[:0])] == [0] * 4


def test_shards_reach_python_a_few_at_a_time(spark, monkeypatch, tmp_path):
    most = op.BATCH_BYTES
    monkeypatch.setattr(op, "BATCH_BYTES", 100)
    build = op._build

    def counted(batches):
        for batch in batches:
            (tmp_path / f"{batch.num_rows}").touch()
            yield from build(iter([batch]))

    monkeypatch.setattr(op, "_build", counted)
    before = spark.conf.get(op.BATCH_KEY)
    df = spark.createDataFrame(texts(5, 30, 60, "en"), "lang string, text string").coalesce(1)
    assert op.phrases(df, 3, 64).count()
    assert [p.name for p in tmp_path.iterdir()] == ["1"] and spark.conf.get(op.BATCH_KEY) == before and most <= 1 << 22


def test_a_shard_fits_into_a_batch(monkeypatch):
    monkeypatch.setattr(op, "TaskContext", type("Task", (), {"get": classmethod(lambda cls: cls), "partitionId": classmethod(lambda cls: 2)}))
    text = pa.array([b"a b c d " * 300_000], pa.binary())
    rows = list(op._gather(iter([pa.RecordBatch.from_arrays([pa.array(["en"]), text], ["lang", "text"])]), op.SHARD_WORDS))
    codes = [c.as_py() for r in rows for c in r.column("codes") if c.as_py()]
    assert len(codes) == 2 and max(map(len, codes)) <= op.BATCH_BYTES
    words = [w for r in rows for w in r.select(["word", "n"]).to_pylist() if w["word"]]  # one table of words for both
    assert words == [{"word": w, "n": 300_000} for w in (b"a", b"b", b"c", b"d")]


@pytest.mark.parametrize("most", [5, 1 << 16, 1 << 22])
def test_suffix_order_is_stable_and_small(most):
    text = np.random.default_rng(6).integers(0, most, 100_000).astype(np.int32)
    some = text[:500].tolist()
    assert op.suffix_order(text[:500]).tolist() == sorted(range(500), key=lambda i: (some + some)[i : i + op.DEPTH])
    tracemalloc.start()
    order = op.suffix_order(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak <= 23 * len(order)


def test_large_products_are_exact(spark):
    big = 3_000_000_000_007
    row = [("en", "a b", 2, big, 7 * big, [2 * big, big], [3 * big, big], None)]
    found = spark.createDataFrame(row, "lang string, phrase string, words int, count long, n long, firsts array<long>, lasts array<long>, longest long")
    assert op.scored(found).first().score == 1000 * big * 7 * big // (6 * big * big)


def test_empty(spark):
    assert op.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    with pytest.raises(ValueError):
        op.phrases(spark.createDataFrame([], "lang string, text string"), 0)
