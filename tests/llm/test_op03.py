import random
import re

import numpy as np
import pytest

from tessera.llm import op03_minhash as op
from tessera.llm import components as linked
from tessera.llm.components import connected


def brute_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and min(len(a), len(b)) * 100 >= 75 * max(len(a), len(b)):
                if 100 * len(a & b) >= 75 * len(a | b):
                    root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        c = None if d is None else min(rows[j][0] for j in range(len(rows)) if rows[j][0] is not None and find(j) == find(i))
        out.append((d, len(sets[i]), c, d is None or d == c))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted([tuple(r) for r in op.components(docs.withColumn("set", op.F.lit(1))).collect()], key=str) == brute(rows)
    return docs


def test_edges_and_chains(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefghijklmnop") + str(rng.randrange(1000))
    base = [word() for _ in range(120)]
    rows, doc = [], 0
    for _ in range(60):  # a chain: neighbours are near, the ends are not
        base = base[rng.randrange(4) :] + [word() for _ in range(rng.randrange(4))]
        rows.append((doc := doc + 1, " ".join(base)))
    for k in range(120):  # groups with several edits each
        if k % 8 == 0:
            base = [word() for _ in range(rng.randrange(3, 300))]
        edited = list(base)
        for _ in range(rng.randrange(0, max(2, len(base) // 30))):
            edited[rng.randrange(len(edited))] = word()
        rows.append((doc := doc + 1, " ".join(edited)))
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "one two"), (904, "ONE  two"), (905, "one"), (906, "É é a b c"), (907, "é é a b c"), (None, "one two"), (None, None)]
    rows += [(908, "one two"), (908, "one two"), (908, "other words"), (909, "w " * 70_000), (910, "w w w w w w"), (911, "w w w w"), (3, "x y z")]
    docs = check(spark, rows)
    kept = op.deduplicate(docs.withColumn("set", op.F.lit(1)))
    assert kept.columns == ["doc_id", "text", "set"]
    ids = [r.doc_id for r in kept.collect()]
    assert len([i for i in ids if i is not None]) == len(set(ids) - {None}) and ids.count(None) == 2


def test_hot_group_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 7)
    rng = random.Random(11)
    base = ["w" + str(rng.randrange(10**6)) for _ in range(90)]
    rows = []
    for i in range(260):
        edited = list(base)
        for _ in range(rng.choice([0, 1, 2, 2, 3, 3, 4, 5])):
            edited[rng.randrange(90)] = "x" + str(rng.randrange(10**6))
        rows.append((1000 - i, " ".join(edited)))
    check(spark, rows)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    check(spark, [(r.doc_id, r.text) for r in docs.collect()])


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op.components(docs).count() == 0 and op.deduplicate(docs).count() == 0


def test_min_and_max_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 64, 1000, np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 64, 200, np.uint64)])
    assert abs((op.signature(np.unique(a)) == op.signature(np.unique(b))).mean() - 800 / 1200) < 0.1


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    root = {}
    find = lambda i: i if root.setdefault(i, i) == i else find(root[i])
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    alone = {a for a, b in links if a == b}
    assert got == {i: find(i) for i in root if find(i) != i or any(find(j) == i and j != i for j in root)} or alone


@pytest.mark.parametrize("most", [15, 1000])
def test_components_of_several_partitions_and_of_one(spark, monkeypatch, most):
    monkeypatch.setattr(linked, "LINKS", most)  # 15: partitions that join some of their nodes at a time, then rounds
    rng = random.Random(8)
    links = [(b"%03d" % i, b"%03d" % (i + 1)) for i in range(100, 180)] + [(b"x", b"%03d" % rng.randrange(500, 600)) for _ in range(50)] + [(None, b"y"), (b"y", None), (b"y", b"y"), (b"z", b"zz"), (b"zz", b"z"), (b"z", b"zz")]
    rng.shuffle(links)
    got = [(bytes(r.node), bytes(r.root)) for r in connected(spark.createDataFrame(links, "a binary, b binary").repartition(7)).collect()]
    hub = {y for x, y in links if x == b"x"}
    least = min(hub)
    assert sorted(got) == sorted([(b"%03d" % i, b"100") for i in range(100, 181)] + [(x, least) for x in hub | {b"x"}] + [(b"z", b"z"), (b"zz", b"z")])


def test_few_links_take_no_round(spark, monkeypatch):
    monkeypatch.setattr(linked, "_state", lambda links: pytest.fail("a round of stars, each with its exchanges, for one partition of links"))
    path = connected(spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long"))
    assert {(r.node, r.root) for r in path.collect()} == {(i, 0) for i in range(301)}


def test_blocks_of_text_and_of_hits_change_nothing(monkeypatch):
    rng = np.random.default_rng(9)
    text = " ".join(rng.choice(["a", "Bc", "déf", "g" * 40], 800))
    whole = op.shingles(text)
    sets = [op.shingles(" ".join(rng.permutation(text.split())[:300])) for _ in range(5)] + [whole, whole[:-3]]
    names = [bytes([i]) for i in range(7)]
    links = list(op._Members(names, sets, False).links(b"x", whole, 75))
    monkeypatch.setattr(op, "BLOCK_BYTES", 50)
    monkeypatch.setattr(op, "HITS", 7)
    assert (op.shingles(text) == whole).all() and list(op._Members(names, sets, False).links(b"x", whole, 75)) == links and len(links) == 2
    assert (op.shingles("x" * 500) == op.shingles("X" * 500)).all() and len(op.shingles("x" * 500 + " y")) == 1 and not len(op.shingles(" " * 200))


def test_deduplicate_with_clashing_columns(spark):
    text = " ".join(map(str, range(40)))
    rows = [(1, text, 7, 8, 9), (2, text, 7, 8, 9), (None, text, 7, 8, 9), (3, "other words", 1, 2, 3), (3, "other words", 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone__id int, first__ int, row int").withColumnRenamed("row", "first")
    got = op.deduplicate(df)
    assert got.columns == df.columns and sorted((r.doc_id or 0, r.gone__id, r.first__, r["first"]) for r in got.collect()) == [(0, 7, 8, 9), (1, 7, 8, 9), (3, 1, 2, 3)]
