import hashlib
import re

from tessera.llm import op06_spotsigs as op

STOP = set(op.ANCHORS)


def spots(text):
    w = [x for x in re.findall(r"[^\W_]+", text.lower())]
    places = [i for i, x in enumerate(w) if x not in STOP]
    out = {(w[i - 1], w[i], w[j]) for i, j in zip(places, places[1:]) if i and w[i - 1] in STOP}
    return out or ({("word", x) for x in w} if w else ({text} if text else set()))


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def brute(rows):
    rows = sorted([(i, t or "") for i, t in rows], key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        c = len(t) // 3
        edited = t[: len(t) - c] + nxt[:c]
        yield i, len(t), hashlib.sha256(edited.encode()).hexdigest(), jaccard(spots(t), spots(edited)), jaccard(spots(t), spots(nxt))


def check(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = op.fingerprints(df).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    a = sorted([(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got], key=key)
    b = sorted([(i, n, s, round(x, 9), round(y, 9)) for i, n, s, x, y in brute(rows)], key=key)
    assert a == b
    return got


def test_against_brute_force(spark):
    got = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").withColumn("sigs", op.F.lit(1)))
    by = {}
    for r in got:
        assert r.near_edited == 1.0 or r.fingerprint != r.edited_fingerprint
    assert sum(r.near_next > 0.5 for r in got) < 20


def test_many_ranges_and_edges(spark, monkeypatch):
    monkeypatch.setattr(op, "BUCKET_ROWS", 7)
    rows = [(i * 3 % 101, f"the cat {i} of dogs and birds {i % 7} on trees " * (i % 5)) for i in range(100)]
    rows += [(5, "same the same"), (5, None), (5, ""), (None, "of none"), (None, "x"), (200, "!!! ..."), (201, "the of and"), (202, "word " * 50_000)]
    check(spark.createDataFrame(rows, "doc_id long, text string"))
    check(spark.createDataFrame(rows[3:4], "doc_id long, text string"))
    assert op.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pruned_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    base = [i for i in rows if len(rows[i]) > 600][:40]
    for k, i in enumerate(base):
        rows[10_000 + i] = rows[i][: int(len(rows[i]) * (0.75 + k / 200))]
        rows[20_000 + i] = rows[i]
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    pairs, members = op.near_pairs(df)
    cls = {r.doc_id: r["class"] for r in members.collect()}
    got = {(r.a, r.b) for r in pairs.collect()}
    sets = {i: spots(t) for i, t in rows.items()}
    reps = sorted({min(j for j in rows if sets[j] == sets[i]) for i in rows if sets[i]})
    want = {(a, b) for x, a in enumerate(reps) for b in reps[x + 1 :] if jaccard(sets[a], sets[b]) >= 0.75}
    assert got == want and len(want) > 10
    assert all(cls[i] == min(j for j in rows if sets[j] == sets[i]) for i in base)
