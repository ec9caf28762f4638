"""Factor models (ALS): training, scores, grids and recommendations."""

from __future__ import annotations

from collections.abc import Callable
from itertools import product
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import mean_auc, rmse, sample_negatives

LARGEST_ID = 2**31 - 1


def int_ids(rows: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): the model takes ids of the int range only; others are rejected and never wrapped."""
    fits = F.lit(True)
    for c in columns:
        fits = fits & F.coalesce(F.col(c).between(-LARGEST_ID - 1, LARGEST_ID), F.lit(False))
    return rows.filter(fits).withColumns({c: F.col(c).try_cast("int") for c in columns}), rows.filter(~fits)


def explicit(train: DataFrame, rank: int = 5, iterations: int = 5, reg: float = 0.1, seed: int = 42) -> ALSModel:
    return ALS(rank=rank, maxIter=iterations, regParam=reg, seed=seed, userCol="user", itemCol="item", ratingCol="rating", coldStartStrategy="drop").fit(train)


def implicit(train: DataFrame, rank: int = 10, iterations: int = 5, reg: float = 0.01, alpha: float = 1.0, seed: int = 42) -> ALSModel:
    als = ALS(rank=rank, maxIter=iterations, regParam=reg, alpha=alpha, implicitPrefs=True, seed=seed, userCol="user", itemCol="item", ratingCol="rating", coldStartStrategy="drop")
    return als.fit(train)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """pairs with ``prediction``; unknown users and items drop."""
    return model.transform(pairs)


def save(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> ALSModel:
    return ALSModel.load(path)


def each_setting(spark: SparkSession, work: Callable, settings: list[tuple], jobs: int) -> list:
    """work(*setting) of all settings, at most ``jobs`` at a time, in the order of the settings whichever ends first. The first failure ends it."""
    if jobs < 1:
        raise ValueError("at least one job")
    with ThreadPool(min(jobs, max(1, len(settings)))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda setting: work(*setting)), settings, chunksize=1)


def tune_by_rmse(train: DataFrame, validation: DataFrame, ranks, regs, iterations, seed: int = 42, jobs: int = 4) -> tuple[ALSModel, list[tuple]]:
    """The model with the smallest validation RMSE (the first of equals), and (rank, reg, iterations, rmse) of the grid in its order.

    Settings are fitted ``jobs`` at a time over one cached frame; models other than the best are not kept.
    """
    best = (None, float("inf"), -1)
    settings, lock = list(product(ranks, regs, iterations)), Lock()
    train, validation = train.persist(), validation.persist()

    def work(place: int, rank: int, reg: float, its: int) -> tuple:
        nonlocal best
        model = explicit(train, rank, its, reg, seed)
        error = rmse(validation, predict(model, validation.select("user", "item")), ["user", "item"]).first().rmse  # one number
        with lock:
            if error is not None and (error, place) < best[1:]:
                best = (model, error, place)
        return rank, reg, its, error

    try:
        log = each_setting(train.sparkSession, work, [(i, *s) for i, s in enumerate(settings)], jobs)
    finally:
        train.unpersist(), validation.unpersist()
    return best[0], log


def tune_by_auc(train: DataFrame, held_out: DataFrame, items: DataFrame, ranks, regs, alphas, iterations: int = 5, seed: int = 42, jobs: int = 4) -> list[tuple]:
    """(rank, reg, alpha, mean AUC) of an implicit grid, the best first, equals in the order of the grid; ``jobs`` settings at a time over one cached frame and one sample."""
    train, negatives = train.persist(), sample_negatives(held_out, items, seed).persist()

    def work(rank: int, reg: float, alpha: float) -> tuple:
        model = implicit(train, rank, iterations, reg, alpha, seed)
        found = auc_of(held_out, negatives, lambda pairs: predict(model, pairs).withColumnRenamed("prediction", "score")).first().mean_auc
        return rank, reg, alpha, found

    try:
        log = each_setting(train.sparkSession, work, list(product(ranks, regs, alphas)), jobs)
    finally:
        train.unpersist(), negatives.unpersist()
    return sorted(log, key=lambda r: -r[3] if r[3] is not None else float("inf"))


def auc_of(held_out: DataFrame, negatives: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """users, mean_auc of any function that adds ``score`` to pairs (user, item)."""
    return mean_auc(score(held_out.select("user", "item")), score(negatives.select("user", "item")))


def _flat(found: DataFrame) -> DataFrame:
    rows = found.select("user", F.posexplode("recommendations").alias("rank", "r"))
    return rows.select("user", (F.col("rank") + 1).alias("rank"), F.col("r.item").alias("item"), F.col("r.rating").alias("score"))


def recommend_all(model: ALSModel, n: int = 10) -> DataFrame:
    """user, rank, item, score: the n best items of every user, as one distributed job."""
    return _flat(model.recommendForAllUsers(n))


def recommend_for(model: ALSModel, users: DataFrame, n: int = 5) -> DataFrame:
    """The n best items of the users given (column user)."""
    return _flat(model.recommendForUserSubset(users, n))


def with_names(recommended: DataFrame, names: DataFrame) -> DataFrame:
    """Recommendations with the names of their items (id, name); items without a name keep null."""
    return recommended.join(names.withColumnRenamed("id", "item"), "item", "left").select("user", "rank", "item", "name", "score")


def id_lists(recommended: DataFrame) -> DataFrame:
    """user, items: the ids in order of rank, joined by commas."""
    ranked = recommended.groupBy("user").agg(F.array_sort(F.collect_list(F.struct("rank", "item"))).alias("r"))
    return ranked.select("user", F.array_join(F.transform("r", lambda x: x["item"].cast("string")), ",").alias("items"))
