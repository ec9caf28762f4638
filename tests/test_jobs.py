"""Golden rows of the batch jobs."""

import random

from pyspark.sql import functions as F

from tessera.operators import clicks, orders, ranking, ratings, relational, rerank, similar
from tessera.sources import files, sinks


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


PAIRS = [(3, 2), (4, 6), (3, 7), (5, 34), (3, 4), (5, 9), (4, 7), (4, 5), (5, 6)]


def test_clicks(spark):
    good = "\t".join(["10.0.0.1", "2018-09-20 01:02:03", "GET /class/130.html http/1.1", "200", "https://cn.bing.com/search?q=x"])
    bad = [
        "", "\t\t\t\t", "a\tb\tc", good.replace("130.html", "x.html"), good.replace("130.html", "130"), good.replace("/class/130.html", "/class"),
        good.replace("GET /class/130.html http/1.1", "GET"), good.replace("2018-09-20 ", "2018/09/20 "), good.replace("200", "2x0"), good.rpartition("\t")[0] + "\t",
    ]
    zero = [good.replace("130.html", "0.html"), good.replace("/class/130.html", "/learn/130.html")]
    classics = good.replace("/class/130.html", "/classics/7.html").replace("https://cn.bing.com/search?q=x", "-")
    df = lines(spark, good, *bad, *zero, classics)
    assert rows(clicks.per_day(clicks.clean(df))) == [("20180920_130", 1), ("20180920_7", 1)]
    assert rows(clicks.per_day_and_host(clicks.clean(df))) == [("20180920_cn.bing.com_130", 1)]
    reasons = [r.reason for r in clicks.rejects(df).collect()]
    assert sorted(reasons) == sorted(["fields"] * 4 + ["course"] * 3 + ["request", "time", "status"])


def test_clicks_of_any_path(spark):
    good = "\t".join(["10.0.0.1", "2018-09-20 01:02:03", "GET /class/130.html http/1.1", "404", "http://cn.bing.com/search?q=x"])
    same = [good.replace("/class/130", "/learn/130"), good.replace("130", "0"), good.replace("/class/130.html", "/a/130.tar.gz/b")]
    df = lines(spark, good, *same, good.replace("/class/130.html", "/learn"), good.replace("130.html", "130"))
    assert rows(clicks.per_day(clicks.clean(df, any_path=True))) == [("20180920_0", 1), ("20180920_130", 2)]
    assert [r.reason for r in clicks.rejects(df, any_path=True).collect()] == ["course"] * 3
    assert rows(clicks.per_day(clicks.clean(df))) == [("20180920_130", 1)]  # the stricter one counts the same lines by its own rule


def test_top_addresses(spark):
    #: A host's addresses with their counts.
    learn = {"video": 521, "course": 521, "teacher": 512, "note": 511}
    urls = [f"http://net.learn.com/net/{page}.shtml" for page, n in learn.items() for _ in range(n)]
    urls += ["http://PHP.learn.com:80/a", "ftp://me@php.learn.com", "http://x?y#z", "/net/x.shtml", "http://", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    top = clicks.top_addresses(df)
    assert [tuple(r) for r in top.filter("host = 'net.learn.com'").orderBy("rank").collect()] == [
        ("net.learn.com", i + 1, f"http://net.learn.com/net/{page}.shtml", learn[page]) for i, page in enumerate(["course", "video", "teacher"])
    ]
    assert rows(top.filter("host <> 'net.learn.com'"), "host", "rank", "visits") == [("php.learn.com", 1, 1), ("php.learn.com", 2, 1), ("x", 1, 1)]
    assert clicks.without_host(df).count() == 4
    lists = {r.host: [tuple(a) for a in r.addresses] for r in clicks.address_lists(top).collect()}
    assert lists["php.learn.com"] == [("ftp://me@php.learn.com", 1), ("http://PHP.learn.com:80/a", 1)] and len(lists["net.learn.com"]) == 3
    assert clicks.top_addresses(df.limit(0)).isEmpty()


def test_word_count(spark):
    df = spark.createDataFrame([("a b  a\n\nb ",), ("",), (None,)], "text string")
    assert rows(relational.word_count(df)) == [("", 3), ("a", 2), ("b", 2)]


def test_sorts_and_tops(spark):
    df = spark.createDataFrame(PAIRS, "k int, v int")
    assert [tuple(r) for r in relational.secondary_sort(df, "k", "v").collect()] == sorted(PAIRS)
    assert rows(relational.top_n_per_group(df, "k", "v", 2), "k", "v") == [(3, 4), (3, 7), (4, 6), (4, 7), (5, 9), (5, 34)]
    twice = df.union(df)
    assert rows(relational.top_n_per_group(twice, "k", "v", 2), "k", "v") == [(3, 7), (3, 7), (4, 7), (4, 7), (5, 34), (5, 34)]
    keys = spark.createDataFrame([("a", 20), ("b", 30), ("a", 21), ("b", 9), ("c", 24), ("d", 39)], "k string, v int")
    assert [tuple(r) for r in relational.top_n_keys(keys, "k", "v", 2).collect()] == [("a", 41), ("b", 39)]
    assert rows(relational.top_n_keys(keys, "k", "v", 2, with_ties=True)) == [("a", 41), ("b", 39), ("d", 39)]
    got = relational.sorted_within_key(df, "k", "v", partitions=2).withColumn("p", F.spark_partition_id()).collect()
    assert len({(r.k, r.p) for r in got}) == 3
    for p in {r.p for r in got}:
        own = [(r.k, r.v) for r in got if r.p == p]
        assert own == sorted(own)


def test_value_map(spark):
    good, bad = files.delimited(lines(spark, "x,2,9", "y,3,1", "x,1,3", "x,3,6", "z,1,4", "z,2,8", "y,1,7", "x,1,9", "y,2", "q,a,1"), ",", [("name", "string"), ("time", "int"), ("value", "int")])
    assert rows(bad) == [("q,a,1", "number"), ("y,2", "fields")]
    maps = relational.value_map(good, "name", "value", "time")
    got = {r.name: list(zip(r.k, r.v)) for r in maps.select("name", F.map_keys("times").alias("k"), F.map_values("times").alias("v")).collect()}
    assert got == {"x": [(3, 1), (6, 3), (9, 3)], "y": [(1, 3), (7, 1)], "z": [(4, 1), (8, 2)]}


def test_json_and_lookup(spark, tmp_path):
    good, bad = files.json_rows(lines(spark, '{"name":"Mia"}', '{"name":"Ann","age":30}', "{", '{"age":3}'), "name string, age bigint", ["name"])
    assert rows(good.filter("age > 21")) == [("Ann", 30)] and bad.count() == 2
    (tmp_path / "p.json").write_text('{"name":"Ann","age":30}\n{"name":"Bo"}\n')
    assert rows(files.json_table(spark, str(tmp_path / "p.json"), "name string, age bigint").filter("age > 21")) == [("Ann", 30)]
    keys, counts = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a", 3)], "k string, n bigint")
    assert rows(relational.lookup(keys, counts, "k", "n")) == [("a", 3), ("b", 0)]


def test_blocked(spark):
    df = spark.createDataFrame([("tom",), ("mary",), ("zed",), ("kim",)], "name string")
    listed = spark.createDataFrame([("tom", True), ("zed", False), ("kim", False), ("kim", True), ("tom", True)], "name string, flag boolean")
    assert rows(relational.blocked_by_join(df, listed, "name")) == rows(relational.blocked_by_anti_join(df, listed, "name")) == [("mary",), ("zed",)]


def test_labels_statistics_and_split(spark):
    df = spark.createDataFrame([("A|B||",), ("B",), ("",), (None,)], "g string")
    assert rows(relational.distinct_labels(df, "g")) == [("A", 1), ("B", 2)]
    got = {r.column: r for r in relational.statistics(spark.createDataFrame([(1, 2), (3, None)], "a int, b int"), "a", "b").collect()}
    assert (got["a"].n, got["a"].mean, got["a"].stdev, got["a"].largest, got["b"].n) == (2, 2.0, 1.0, 3.0, 1)
    numbers = spark.range(3000).withColumn("part", relational.hash_split(F.col("id"), [9, 1]))
    assert 200 < numbers.filter("part = 1").count() < 400
    assert rows(numbers) == rows(numbers.repartition(7))


def test_ratings_and_movies(spark):
    df = lines(spark, "1,2,3.0,10", "1,2,3.0,16", "1,2,3.0,18", "1,2,3.0,19", "0,2,3.0,1", "1,2,3.0", "x,2,3.0,1", "", "1,2,3.0,1,9")
    got = ratings.parse_ratings(df)
    assert rows(got.filter("reason is null"), "digit", "split") == [(0, "train"), (1, "train"), (6, "validation"), (8, "test"), (9, "test")]
    assert sorted(r.reason for r in got.filter("reason is not null").collect()) == ["fields", "fields", "number", "user"]
    df = lines(spark, '11,"American President, The (1995)",Comedy|Drama', "12,Heat (1995),Action", "13,No year,Drama", "14,a, b (x),C|", "movieId,title,genres", "15 no commas", "16,one comma")
    got = ratings.movies(df)
    assert rows(got.filter("reason is null").select("id", "title", "year", F.array_join("genres", "|"))) == [
        (11, "American President, The", 1995, "Comedy|Drama"), (12, "Heat", 1995, "Action"), (13, "No year", 0, "Drama"), (14, "a, b (x)", 0, "C")
    ]
    assert rows(got.filter("reason is not null"), "reason") == [("fields",), ("fields",), ("id",)]


def test_play_counts(spark):
    assert rows(ratings.artists(lines(spark, "1\t A \tB ", "2 no tab", "x\tbad", "3\t"))) == [(1, "A \tB"), (3, "")]
    alias = ratings.aliases(lines(spark, "5\t1", "\t7", "6\t2", "6\t3", "z\t1"))
    assert rows(alias) == [(5, 1), (6, 3)]
    plays = spark.createDataFrame([(1, 5, 10), (1, 1, 2), (2, 9, 4)], "user int, item int, plays bigint")
    assert rows(ratings.resolve(plays, alias)) == [(1, 1, 2), (1, 1, 10), (2, 9, 4)]
    assert rows(ratings.resolve(plays, alias, aggregate=True)) == [(1, 1, 12), (2, 9, 4)]


def test_orders(spark):
    df = spark.createDataFrame([(0, 1, 12), (0, 1, 34), (0, 2, 5), (1, 1, 3)], "batch_id int, id bigint, price bigint")
    batches = orders.per_batch(df, "batch_id")
    assert rows(orders.running(batches), "id", "total", "last", "n") == [(1, 49, 3, 3), (2, 5, 5, 1)]
    assert rows(orders.grand_total(batches)) == [(4, 54)]


def test_tuple_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2, 3.0, 4), (5, 6, 0.5, 7)], "user int, item int, rating double, digit int")
    sinks.save_lines(sinks.as_tuples(df), str(tmp_path / "a/part"))
    good, bad = files.tuples(files.lines(spark, str(tmp_path / "*/part")), [("user", "int"), ("item", "int"), ("rating", "double"), ("digit", "int")])
    assert rows(good) == rows(df) and bad.isEmpty()


def test_tuples(spark):
    good, bad = files.tuples(lines(spark, "(186,302,3.0,2)", "(1,2,x,3)", "1,2,3.0,4"), [("user", "int"), ("item", "int"), ("rating", "double"), ("digit", "int")])
    assert rows(good) == [(186, 302, 3.0, 2)] and bad.count() == 2


def test_mean_auc(spark):
    pos = spark.createDataFrame([(1, 3.0), (1, 1.0), (2, 1.0)], "user int, score double")
    neg = spark.createDataFrame([(1, 2.0), (1, 1.0), (3, 1.0)], "user int, score double")
    assert rows(ranking.mean_auc(pos, neg)) == [(1, 0.5)]
    rng = random.Random(6)
    make = lambda: [(rng.randrange(4), float(rng.randrange(30))) for _ in range(400)]
    p, n = make(), make()
    got = {r.user: r.auc for r in ranking.auc_per_user(spark.createDataFrame(p, "user int, score double"), spark.createDataFrame(n, "user int, score double")).collect()}
    for u in range(4):
        pairs = [(a, b) for x, a in p if x == u for y, b in n if y == u]
        assert abs(got[u] - sum(a > b for a, b in pairs) / len(pairs)) < 1e-12


def test_negatives(spark):
    items = [(i * 3 + (5000 if i > 20 else 0),) for i in range(40)]
    pos = [(1, items[k][0]) for k in (0, 1, 5, 39)] + [(2, i) for (i,) in items] + [(3, i) for (i,) in items[:39]]
    df = spark.createDataFrame(pos + pos, "user int, item int")
    got = ranking.sample_negatives(df, spark.createDataFrame(items, "item int")).collect()
    by = {u: [r.item for r in got if r.user == u] for u in (1, 2, 3)}
    assert len(by[1]) == 4 and not by[2] and by[3] == [items[39][0]] * 39
    assert not {i for u, i in pos if u == 1} & set(by[1])
    many = spark.range(3000).selectExpr("int(id) user", "explode(array(0, 3, 9)) item")
    seen = [r["count"] for r in ranking.sample_negatives(many, spark.createDataFrame(items, "item int")).groupBy("item").count().collect()]
    assert len(seen) == 37 and min(seen) > 160 and max(seen) < 330


def test_rerank(spark):
    a, b, c, d, e = 1, 2, 3, 4, 5
    past = spark.createDataFrame([(7, a, 4.0, 2), (7, b, 2.0, 1), (8, a, 1.0, 1)], "user int, item int, rating double, ts int")
    sims = spark.createDataFrame([(e, c, 0.9), (e, d, 0.9), (c, a, 0.9), (c, b, 0.4), (d, a, 0.7), (d, b, 0.8)], "item1 int, item2 int, similarity double")
    event = spark.createDataFrame([("x", 7, e)], "event_id string, user int, item int")
    got = {r.item: round(r.score, 4) for r in rerank.rerank(event, past, sims, include_self=False).collect()}
    assert got == {c: 1.2, d: 1.4667}
    per = {r.item: round(r.score, 4) for r in rerank.rerank(event, past, sims, include_self=False, normalize="candidate").collect()}
    assert per == {c: 3.6, d: 2.2}
    own = {r.item: r.score for r in rerank.rerank(event.withColumn("item", F.lit(c)), past, sims.union(spark.createDataFrame([(a, a, 0.1)], sims.schema))).collect()}
    assert set(own) == {a, b, c}


def test_rerank_by_user_and_item(spark):
    """Items of a user are compared once whatever the number of events; repeated entries, several items or users of an event and null items count as if each pair were a row."""
    from collections import defaultdict
    from itertools import product
    from math import log2

    past = [(u, i, float(1 + (u * 3 + i) % 5), i % 4) for u in range(4) for i in range(7)] + [(1, None, 4.0, 9), (2, 3, None, 9), (None, 1, 5.0, 1)]
    sims = [(i, (i * 2 + k) % 8, 0.35 + 0.1 * ((i + k) % 6)) for i in range(8) for k in (1, 1, 3, 4)] + [(2, 5, None), (3, None, 0.9), (None, 2, 0.9), (1, 5, 0.99)]
    events = [(e, e % 5, e % 9) for e in range(40)] * 2 + [(3, 3, 7), (3, 1, 2), (4, 4 % 5, 1), (5, 0, None), (6, None, 2), (None, 1, 2), (7, 2, 1)]
    frames = [spark.createDataFrame(r, s) for r, s in ((events, "event_id int, user int, item int"), (past, "user int, item int, rating double, ts int"), (sims, "item1 int, item2 int, similarity double"))]
    seen, largest = set(events), defaultdict(lambda: None)
    for a, b, s in sims:
        if None not in (a, b, s):
            largest[a, b] = max(s, largest[a, b] or 0)
    latest = {u: sorted((r for r in past if r[0] == u), key=lambda r: (-r[3], r[1] is not None, r[1] or 0))[:5] for u in range(5)}
    for own, per_event in product((True, False), (True, False)):
        groups, by = defaultdict(list), defaultdict(int)
        for e, u in {(e, u) for e, u, _ in seen if e is not None and u is not None}:
            froms = [i for x, _, i in seen if x == e]
            cand = [b for i in froms for a, b, _ in sims if a == i and i is not None] + [i for i in froms if own and i is not None and any(a == i for a, _, _ in sims)]
            for item, r in product(cand, [r for x in seen if x[:2] == (e, u) for r in latest[u]]):
                s = 1.0 if own and item is not None and item == r[1] else largest[item, r[1]] or 0.6
                if s > 0.5:
                    groups[e, u, item].append((s, r[2]))
                    by[e] += 1
        want = {}
        for (e, u, item), pairs in groups.items():
            total = sum(s * x for s, x in pairs if x is not None) / (by[e] if per_event else len(pairs))
            want[e, u, item] = round(total + log2(max(1, sum(x is not None and x >= 3 for _, x in pairs))) - log2(max(1, sum(x is not None and x < 3 for _, x in pairs))), 6)
        got = rerank.rerank(*frames, include_self=own, normalize="event" if per_event else "candidate").collect()
        assert len(got) == len(want) and {(r.event_id, r.user, r.item): round(r.score, 6) for r in got} == want
    wanted = spark.createDataFrame([(1, i) for i in range(3)], "user int, item int")
    once = rerank.user_scores(wanted, rerank.latest_ratings(frames[1]), frames[2], 0.6, 0.5, True).collect()
    assert sorted((r.user, r.item) for r in once) == [(1, 0), (1, 1), (1, 2)] and all(r.pairs <= rerank.LATEST for r in once)


def test_nearest(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    vecs = [(i, (centres[i % 6] * 4 + rng.normal(size=8)).tolist()) for i in range(300)]
    vecs += [(300 + i, vecs[0][1]) for i in range(15)] + [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [None] * 8)]
    monkeypatch.setattr(similar, "BLOCK", 40)
    monkeypatch.setattr(similar, "PIVOTS", 5)
    got = rows(similar.nearest(spark.createDataFrame(vecs, "vec_id long, embedding array<double>"), n=7), "item", "rank", "other")
    x = np.array([v for _, v in vecs[:315]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(x @ x.T, 9)
    want = [(i, r + 1, j) for i in range(315) for r, j in enumerate(sorted((j for j in range(315) if j != i), key=lambda j: (-s[i, j], j))[:7])]
    assert got == want


def test_nearest_over_many_cells(spark, monkeypatch):
    """Clusters cut into shells, cells of copies cut into parts, and cells that many ask, against all pairs."""
    import numpy as np

    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(9, 12))[i % 9] * 5 + rng.normal(size=12) * (0.2 + i % 3) for i in range(500)]).reshape(500, 12)
    x = np.concatenate([x, np.repeat(x[:1], 250, 0), rng.normal(size=(150, 12))])  # a hot vector, and some without structure
    for name, value in {"BLOCK": 30, "PIVOTS": 12, "LEAF": 20, "PIECE": 16}.items():
        monkeypatch.setattr(similar, name, value)
    got = rows(similar.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), n=4), "item", "rank", "other")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(x @ x.T, 9)
    want = [(i, r + 1, int(j)) for i in range(900) for r, j in enumerate([j for j in np.lexsort((np.arange(900), -s[i])) if j != i][:4])]
    assert got == want
    assert similar.nearest(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    assert rows(similar.nearest(few), "item", "rank", "other") == [(1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 2), (3, 2, 1)]


def test_blocks_of_similar_items_bound_the_journeys():
    """Vectors without structure travel to every cell: the number of cells does not follow the rows."""
    for total in (30_000, 102_564, 615_384, 2_000_000):
        assert total / similar._block(total) <= 16


def test_tree_of_similar_items():
    import numpy as np
    from types import SimpleNamespace as Row

    class Shell(Row):
        def __getitem__(self, name):
            return getattr(self, name)

    pivots = np.eye(3)
    shells = [Shell(cluster=0, first=0, n=25, lo=0.0, hi=0.2), Shell(cluster=0, first=500, n=10, lo=0.4, hi=0.6), Shell(cluster=1, first=0, n=95, lo=0.0, hi=0.1), Shell(cluster=2, first=0, n=5, lo=0.0, hi=0.3)]
    tree = similar._Tree(pivots, shells, 20)
    assert tree.cell.tolist() == [0, 1, 1, 2] and tree.parts.tolist() == [1, 3, 1] and tree.places() == 5
    assert tree.place(np.array([0, 0, 1, 2]), np.array([499, 500, 9, 0]), np.array([7, 7, 8, 9])).tolist() == [0, 2, 3, 4]
    row, place = tree.asks(np.array([[1.0, 0.0, 0.0]]), np.array([0.9]), np.array([0]))
    assert place.tolist() == [1, 2, 3]  # the outer shell, cos 0.4 > 0.9, shares its cell with the second cluster; the third is too far
    row, place = tree.asks(np.array([[1.0, 0.0, 0.0]]), np.array([-3.0]), np.array([2]))
    assert place.tolist() == [0, 1, 3, 4]
