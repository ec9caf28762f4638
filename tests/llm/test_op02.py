import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import op02_substrings as op


def brute(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (d, _), r in zip(rows, raws):
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((d, len(r), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, length=op.LENGTH, gram=op.GRAM):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as n", "3 as removed").repartition(5)
    got = sorted([tuple(r)[:5] for r in op.remove_repeated(df, length, gram).collect()], key=str)
    want = brute(rows, length)
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    assert not bad and len(got) == len(want), bad[:3]


def made(rng, alphabet, n_docs, length):
    word = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    passages = [word(rng.choice([length - 1, length, length + 1, length + 90, 3 * length])) for _ in range(12)]
    rows = []
    for i in range(n_docs):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(passages)
            a = rng.randrange(0, 200) if rng.random() < 0.5 else 0
            parts += [word(rng.randrange(0, 300)), p[a:] if rng.random() < 0.5 else p[: len(p) - a]]
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("alphabet", ["abcdefgh é", "ab"])
def test_planted_passages(spark, alphabet):
    rng = random.Random(len(alphabet))
    rows = made(rng, alphabet, 120, 400)
    rows += [(rng.randrange(50), rows[k][1]) for k in range(10)] + [(None, rows[0][1][50:]), (None, None), (7, "")]
    check(spark, rows)


def test_periodic_and_long_texts(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(1, "a" * 3000), (2, "ab" * 900), (3, "abc" * 140), (4, "x" * 399), (5, "y" * 400), (6, "z" * 401), (7, "ü" * 700)]
    rows += [(8, "".join(rng.choice("abc") for _ in range(20_000)))]
    rows += [(9, rows[-1][1][5000:9000] + "q" * 300 + rows[-1][1][100:499] + rows[-1][1][700:1100])]
    check(spark, rows)
    monkeypatch.setattr(op, "PIECE", 1500)
    monkeypatch.setattr(op, "BUFFER", 4000)
    for pieces in op._pieces([r[0] for r in rows], [r[1].encode() for r in rows], 400):
        got = op.runs(pieces, 400, 160)
        assert (got["n"] > 0).all()


def test_a_hot_passage_in_parts(spark, monkeypatch):
    monkeypatch.setattr(op, "PART_RUNS", 3)
    rng = random.Random(21)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    hot = word(520)
    check(spark, [(i, word(rng.randrange(400)) + hot[rng.randrange(150) :] + word(rng.randrange(400))) for i in range(90)])


def test_pieces_do_not_change_the_result(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdef") for _ in range(30_000))
    rows = [(1, text), (2, text[3000:12_000] + "-" + text[15_000:15_500])]
    raws = [r[1].encode() for r in rows]
    op.PIECE, kept = 2500, op.PIECE
    try:
        names = set()
        for pieces in op._pieces([1], [raws[0]], 400):
            got = op.runs(pieces, 400, 160)
            names |= {int(p) + k for p, n, c in zip(got["p"], got["n"], got["c"]) if c for k in range(n)}
        assert names == set(range(len(raws[0]) - 399))
    finally:
        op.PIECE = kept
    check(spark, rows)


def test_many_repeated_runs_with_rows_out_of_order():
    rng = np.random.default_rng(4)
    copy = rng.integers(0, 256, 200_000, np.uint8).tobytes()
    own = [rng.integers(0, 256, n, np.uint8).tobytes() for n in (900, 5000)]
    pieces = [(7, 0, own[0] + copy), (3, 0, copy + own[1]), (5, 0, own[1])]
    got = op.runs(pieces, 400, 160)
    assert (got["c"] * (got["c"] > 1)).sum() > 2000
    # runs at a seam are not equal; all else of a copy is covered in its own row, and nothing outside it
    inside = {r: [(int(p), int(p + n)) for q, p, n, c in zip(*(got[f] for f in ("row", "p", "n", "c"))) if c == 0 and q == r] for r in (3, 5, 7)}
    (a, b), (c, d), (e, f), (g, h) = *inside[7], *inside[3], *inside[5]
    for start, end, low, high in ((a, b, 900, 200_900), (c, d, 0, 200_000), (e, f, 200_000, 205_000), (g, h, 0, 5000)):
        assert low <= start < low + 1000 and high - 1000 < end <= high


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check(spark, [(r.doc_id, r.text) for r in docs.collect()])


def test_other_lengths_and_empty(spark):
    check(spark, made(random.Random(1), "abcdefg", 40, 250), 250, 100)
    assert op.remove_repeated(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        op.remove_repeated(spark.createDataFrame([], "doc_id long, text string"), 100)


def test_no_more_buckets_than_allowed(spark, monkeypatch):
    monkeypatch.setattr(op, "BUCKET_BYTES", 100)
    shared = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(700))
    docs = spark.createDataFrame([(i, f"{i} " * i + (shared if i % 3 else "") + f" {i * i}" * 90) for i in range(60)], "doc_id long, text string")
    want = sorted(op.remove_repeated(docs).collect())
    key = "spark.sql.sources.bucketing.maxBuckets"
    before = spark.conf.get(key)
    spark.conf.set(key, "5")
    try:
        assert sorted(op.remove_repeated(docs).collect()) == want
    finally:
        spark.conf.set(key, before)
    assert sum(r.n_removed for r in want) >= 40 * 700
