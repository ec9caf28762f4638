import random
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import ranking, recommend


@pytest.fixture(scope="module")
def made(spark):
    """Ratings of low rank with noise, split three ways."""
    rng = np.random.default_rng(5)
    u, v = rng.normal(size=(80, 3)), rng.normal(size=(60, 3))
    rows = [(i, j, float(np.clip(np.round(3 + u[i] @ v[j] + rng.normal() * 0.3), 1, 5)), int(rng.integers(10))) for i in range(80) for j in range(60) if rng.random() < 0.5]
    df = spark.createDataFrame(rows, "user int, item int, rating double, digit int").persist()
    return tuple(df.filter(c).drop("digit") for c in ("digit <= 5", "digit in (6, 7)", "digit > 7"))


def test_grid_by_rmse(spark, made, tmp_path):
    train, validation, test = made
    best, log = recommend.tune_by_rmse(train, validation, (2, 4), (0.05, 5.0), (6,))
    assert len(log) == 4 and best.rank == min(log, key=lambda r: r[3])[0]
    baseline = validation.agg(F.stddev_pop("rating")).first()[0]
    assert min(r[3] for r in log) < 0.7 * baseline
    error = ranking.rmse(test, recommend.predict(best, test.select("user", "item")), ["user", "item"]).first()
    assert error.rmse < 0.75 * baseline and error.n == test.count()
    recommend.save(best, str(tmp_path / "model"))
    again = recommend.load(str(tmp_path / "model"))
    a, b = (recommend.recommend_all(m, 3).orderBy("user", "rank").collect() for m in (best, again))
    assert a == b and len(a) == 240 and {r.rank for r in a} == {1, 2, 3}
    some = recommend.recommend_for(best, spark.createDataFrame([(3,), (5,), (999,)], "user int"), 4)
    assert {r.user for r in some.collect()} == {3, 5} and some.count() == 8
    names = spark.createDataFrame([(i, f"n{i}") for i in range(0, 60, 2)], "id int, name string")
    named = recommend.with_names(some, names).collect()
    assert all(r.name == (f"n{r.item}" if r.item % 2 == 0 else None) for r in named)
    lists = {r.user: r["items"] for r in recommend.id_lists(some).collect()}
    assert lists[3] == ",".join(str(r.item) for r in sorted(named, key=lambda r: r.rank) if r.user == 3)


def test_implicit_grid_beats_chance(spark, made):
    train, _, test = made
    liked = train.filter("rating >= 4")
    held = test.filter("rating >= 4").select("user", "item")
    log = recommend.tune_by_auc(liked, held, train.select("item"), (3, 8), (0.1,), (1.0, 40.0))
    assert [r[3] for r in log] == sorted((r[3] for r in log), reverse=True) and log[0][3] > 0.55
    negatives = ranking.sample_negatives(held, train.select("item"))
    popular = recommend.auc_of(held, negatives, lambda pairs: ranking.predict_popularity(pairs, ranking.popularity(liked))).first()
    assert 0.4 < popular.mean_auc < 0.9


def test_ids_outside_the_int_range_are_rejected(spark):
    df = spark.createDataFrame([(1, 2), (2**31, 2), (None, 2), (-(2**31), 2**31 - 1)], "user long, item long")
    good, bad = recommend.int_ids(df, "user", "item")
    assert good.count() == 2 and bad.count() == 2 and dict(good.dtypes)["user"] == "int"


def test_items_are_numbered_without_one_task(spark):
    rng = random.Random(1)
    ids = sorted({rng.randrange(-(2**63), 2**63) for _ in range(5000)} | {-(2**63), 2**63 - 1, 0})
    items = spark.createDataFrame([(i,) for i in ids * 2] + [(None,)], "item long").repartition(7)
    index = ranking.numbered_items(items)
    assert sorted(map(tuple, index.collect())) == [(i, k) for k, i in enumerate(ids)]
    users = spark.createDataFrame([(1, i) for i in ids[:3000]] + [(2, ids[-1]), (3, 12345)], "user long, item long")
    drawn = ranking.sample_negatives(users, items)
    plan = drawn._jdf.queryExecution().executedPlan().toString().splitlines()
    single = [i for i, line in enumerate(plan) if "Exchange SinglePartition" in line]
    assert single and all("partial_count(1)" in plan[i + 1] for i in single)  # the number of items, counted in parts
    rows = drawn.collect()
    assert sorted((r.user, r.draw) for r in rows) == [(1, k) for k in range(3000)] + [(2, 0)]
    assert not {(r.user, r.item) for r in rows} & {(r.user, r.item) for r in users.collect()} and len({r.item for r in rows if r.user == 1}) > 1000
    assert ranking.numbered_items(items.limit(0)).isEmpty()


def test_grids_do_not_depend_on_which_setting_ends_first(spark):
    running, most, ended = [0], [0], []
    lock = threading.Lock()

    def work(place, wait):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(wait)
        with lock:
            running[0] -= 1
            ended.append(place)
        return place

    settings = [(0, 0.3), (1, 0.05), (2, 0.05), (3, 0.01)]
    assert recommend.each_setting(spark, work, settings, 3) == [0, 1, 2, 3] and 1 < most[0] <= 3 and ended != [0, 1, 2, 3]
    rows = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(30) for i in range(20) if (u + i) % 3], "user int, item int, rating double")
    parts = rows.filter("(user + item) % 4 <> 0"), rows.filter("(user + item) % 4 = 0")
    one, many = (recommend.tune_by_rmse(*parts, (2, 3), (0.1, 1.0), (2,), jobs=jobs) for jobs in (1, 4))
    near = lambda log: [(*r[:3], round(r[3], 9)) for r in log]
    assert near(one[1]) == near(many[1]) and one[0].rank == many[0].rank
    auc = [recommend.tune_by_auc(parts[0], parts[1].select("user", "item"), rows.select("item"), (2, 3), (0.1,), (1.0, 4.0), 2, jobs=jobs) for jobs in (1, 4)]
    assert near(auc[0]) == near(auc[1])


def test_one_step_of_the_explicit_model_by_hand(spark):
    """With item factors fixed, the user factors are ridge regressions: lambda is weighted by the number of the user's ratings."""
    rows = [(u, i, float(1 + (3 * u + 5 * i) % 5)) for u in range(12) for i in range(9) if (u * i + u) % 4]
    model = recommend.explicit(spark.createDataFrame(rows, "user int, item int, rating double"), rank=3, iterations=12, reg=0.2)
    users, items = ({r.id: np.array(r.features, float) for r in f.collect()} for f in (model.userFactors, model.itemFactors))
    for u, factor in users.items():  # the last half step fits the users to the items
        x, y = np.array([items[i] for v, i, _ in rows if v == u]), np.array([r for v, _, r in rows if v == u])
        assert np.allclose(factor, np.linalg.solve(x.T @ x + 0.2 * len(y) * np.eye(3), x.T @ y), atol=1e-4)
    got = {(r.user, r.item): r.prediction for r in recommend.predict(model, spark.createDataFrame(rows, "user int, item int, rating double")).collect()}
    assert all(abs(got[u, i] - users[u] @ items[i]) < 1e-5 for u, i, _ in rows)
    best = {}
    for r in recommend.recommend_all(model, 4).collect():
        best.setdefault(r.user, []).append((r["rank"], r.item, r.score))
    for u, found in best.items():
        want = sorted((-(users[u] @ f), i) for i, f in items.items())[:4]
        assert all(abs(-w - s) < 1e-5 for (w, _), (_, _, s) in zip(want, sorted(found)))
