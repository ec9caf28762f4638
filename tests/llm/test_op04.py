import hashlib
import random
import re

import numpy as np

from tessera.llm import op04_pii as op


def brute(text):
    """The patterns as they are stated, read by a backtracking engine."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        total = sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


def test_patterns_match_brute_force():
    rng = random.Random(5)
    for _ in range(20000):
        text = "".join(rng.choice(["1", "2", "25", "255", ".", "@", "a", "b.c", "-", "+", " ", "(", ")", "é", "4539578763621486", "a@b.c"]) for _ in range(rng.randrange(14)))
        assert op.base_spans(text) == brute(text), text
    assert op.base_spans("4539 5787 6362 1486")[0][1] == 2


def test_long_texts_are_linear():
    for t in ("1" * 300_000, "a" * 1_000_000, "a@" * 200_000, "1." * 200_000, "+1" * 200_000, "a@b" * 100_000):
        op.base_spans(t), op.tokens(t)


def test_message_passing_is_exact_on_a_tree():
    g = op.Graph()
    g.given, g.rows, g.cols, g.chain, g.skip = [-1, -1, -1, 2], [0, 1, 2, 3], [0, 1, 2, 3], [(0, 1)], [(1, 2), (1, 3)]
    rng = np.random.default_rng(3)
    u, c, s = rng.normal(size=(5, 4)), rng.normal(size=(5, 5)), rng.normal(size=(5, 5))
    joint = np.zeros((5,) * 4)
    for y in np.ndindex(*joint.shape):
        joint[y] = sum(u[y[i], i] for i in range(4)) + c[y[0], y[1]] + s[y[1], y[2]] + s[y[1], y[3]] + op.CLAMP * (y[3] == 2)
    p = np.exp(joint - joint.max())
    p /= p.sum()
    want = [p.sum(axis=tuple(a for a in range(4) if a != i)) for i in range(4)]
    op.ROUNDS, kept = 60, op.ROUNDS
    try:
        assert np.allclose(op.marginals(g, u, c, s), want, atol=1e-6)
    finally:
        op.ROUNDS = kept


def test_query_on_table_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = [(None, "mail x.y@example.com"), (-1, None), (-2, ""), (-3, "1" * 100_000), (-3, "1" * 100_000), (-4, "no data here")]
    docs = docs.union(spark.createDataFrame(odd, "doc_id long, text string"))
    got = op.find(docs.withColumn("spans", docs.doc_id)).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        base = brute(texts[r.doc_id]) if r.doc_id != -3 else []
        say = [f"{op.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(say).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, k, _ in base) for x in range(4)]
        assert set(say) <= set(filter(None, r.spans.split(",")))
        assert len(list(filter(None, r.spans.split(",")))) == len(say) + r.n_added
    assert sum(r.n_added > 0 for r in got) <= 0.05 * len(got)
    assert op.find(docs.limit(0)).count() == 0


def test_a_repeated_mention_takes_the_label(spark):
    rng = random.Random(1)
    pad = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "x12", "2024", "17"]) for _ in range(12))
    rows = []
    for i in range(300):
        mail, ip = f"pf.{i}@mail{i % 9}.example.com", f"10.{i % 250}.3.{i % 99}"
        rows.append((i, f"{pad()} {mail} {pad()} {mail} {pad()} {ip} {pad()} +1 (017) 555-{1000 + i} {pad()}"))
    rows.append((1000, f"{pad()} joan.k77@mail1.example.com {pad()} joan.k77@mail1 {pad()}"))
    got = {r.doc_id: r for r in op.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1000].n_email == 1 and got[1000].spans.count("email:") == 2


def test_evidence_reaches_every_mention():
    g = op.Graph()
    g.given, g.rows, g.cols, g.chain = [4] + [-1] * 40, list(range(41)), [0] * 41, [(i, i + 1) for i in range(40)]
    p = op.marginals(g, np.zeros((5, 1)), 10 * np.eye(5), np.zeros((5, 5)))
    assert np.allclose(p[11, 4], 0.998, atol=1e-3) and p[40, 4] > 0.98
    text = "call +491701234567 or x12 or " + "01701234567 or 2024 or " * 3000
    g = op.Graph()
    g.add(0, text, op.base_spans(text))
    unary = np.zeros((5, op.N_SHAPES))
    unary[0, 0] = 1  # every token alone is rather nothing
    p = op.marginals(g, unary, np.zeros((5, 5)), 6 * np.eye(5))
    mentions = [i for i, (_, a, b) in enumerate(g.where) if text[a:b] == "01701234567"]
    assert len(mentions) == 3000 and p[mentions, 4].min() > 0.9
    assert p[[i for i, (_, a, b) in enumerate(g.where) if text[a:b] == "2024"], 0].min() > 0.4


def test_long_graphs_settle():
    rng = np.random.default_rng(6)
    g = op.Graph()
    for d in range(3):
        text = " ".join(rng.choice(["123456789", "987654321", "2024", "x17y22", "+491701234567"], 5000))
        g.add(d, text, op.base_spans(text)[:1])
    u, c, s = rng.normal(size=(5, op.N_SHAPES)), rng.normal(size=(5, 5)) * 2, rng.normal(size=(5, 5)) * 2
    p = op.marginals(g, u, (c + c.T) / 2, (s + s.T) / 2)
    assert p.shape == (len(g.given), 5) and np.isfinite(p).all() and np.allclose(p.sum(1), 1)


def test_sample_does_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(op, "DOC_TOKENS", 5)
    monkeypatch.setattr(op, "SAMPLE_TOKENS", 60)
    rows = [(1, " ".join(f"id{i}x" for i in range(3000)))] + [(i, f"call +4917012345{i:02} or 10.0.0.{i} and a{i}@b.org") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first = op._sample(docs.repartition(7))
    assert len(first) == 60 and first == op._sample(docs.orderBy("doc_id").coalesce(1))
    assert sum(r.label > 0 for r in first) > 30  # one long document does not fill the sample


def test_shape_of_the_whole_token():
    assert op.shape("x" * 300 + "1" * 25) == op.shape("x" * 200 + "1" * 125)
    assert 15 in op.shape("1" * 300 + "x") and 15 not in op.shape("1" * 300)
