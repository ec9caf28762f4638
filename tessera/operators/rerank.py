"""Re-ranking of candidates as new ratings arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import log2

LATEST, DEFAULT_SIMILARITY, LEAST_SIMILARITY, GOOD_RATING = 5, 0.6, 0.5, 3.0


def latest_ratings(ratings: DataFrame, k: int = LATEST) -> DataFrame:
    """user, item, rating of the k latest ratings of each user (ties by item)."""
    w = Window.partitionBy("user").orderBy(F.desc("ts"), "item")
    return ratings.withColumn("r__", F.row_number().over(w)).filter(F.col("r__") <= k).select("user", "item", "rating")


def user_scores(wanted: DataFrame, recent: DataFrame, similar: DataFrame, default: float, least: float, include_self: bool) -> DataFrame:
    """user, item, sum, pairs, up, down: each wanted item of a user (user, item; distinct) compared once with the user's latest ratings, however many events ask for it."""
    pairs = wanted.join(recent.withColumnRenamed("item", "recent"), "user")
    known = similar.join(wanted.select(F.col("item").alias("item1")).distinct(), "item1", "left_semi").groupBy(F.col("item1").alias("item"), F.col("item2").alias("recent")).agg(F.max("similarity").alias("s"))
    pairs = pairs.join(known, ["item", "recent"], "left")
    own = F.when(F.col("item") == F.col("recent"), F.lit(1.0)) if include_self else F.lit(None).cast("double")
    pairs = pairs.withColumn("s", F.coalesce(own, "s", F.lit(default))).filter(F.col("s") > least)
    return pairs.groupBy("user", "item").agg(
        F.sum(F.col("s") * F.col("rating")).alias("sum"), F.count("*").alias("pairs"), F.count_if(F.col("rating") >= GOOD_RATING).alias("up"), F.count_if(F.col("rating") < GOOD_RATING).alias("down")
    )


def rerank(
    events: DataFrame, ratings: DataFrame, similar: DataFrame, k: int = LATEST, default: float = DEFAULT_SIMILARITY,
    least: float = LEAST_SIMILARITY, include_self: bool = True, normalize: str = "event",
) -> DataFrame:
    """event_id, user, item, score of the candidates of each event (event_id, user, item); rows with one event_id are one event.

    Candidates are the items similar to the event's item (item1, item2, similarity), the item itself included, repeated entries kept. Each is
    compared with the user's latest ratings; pairs above ``least`` count (unknown pairs take the default, of several entries the largest). The score
    is the sum of similarity times rating, divided by the number of pairs of the event (or, ``normalize="candidate"``, of the
    candidate), plus log2 of the number of good ratings, minus log2 of the number of others.

    What a candidate gets depends on the user and the item alone: it is worked out once for each of these, and events only carry
    how many times they have the candidate.
    """
    asked = events.select("event_id", "user", F.col("item").alias("from")).distinct()
    recent = latest_ratings(ratings.join(asked.select("user").distinct(), "user", "left_semi"), k)
    near = similar.join(asked.select(F.col("from").alias("item1")).distinct(), "item1", "left_semi").select(F.col("item1").alias("from"), F.col("item2").alias("item"))
    if include_self:
        near = near.unionByName(near.select("from", F.col("from").alias("item")).distinct())
    near = near.groupBy("from", "item").agg(F.count("*").alias("copies"))
    users = asked.groupBy("event_id", "user").agg(F.count("*").alias("times"))
    candidates = asked.select("event_id", "from").join(users, "event_id").join(near, "from").select("event_id", "user", "item", (F.col("times") * F.col("copies")).alias("times"))
    by_user = user_scores(candidates.select("user", "item").distinct(), recent, similar, default, least, include_self).withColumnsRenamed({"user": "user__", "item": "item__"})
    scores = candidates.join(by_user, (F.col("user") == F.col("user__")) & F.col("item").eqNullSafe(F.col("item__")))
    scores = scores.select("event_id", "user", "item", *((F.col("times") * F.col(c)).alias(c) for c in ("sum", "pairs", "up", "down")))
    # dealt and sorted by event once; an item that several items of an event lead to is then summed within its event
    same, event = Window.partitionBy("event_id", "user", "item"), Window.partitionBy("event_id")
    scores = scores.repartition("event_id").withColumn("r__", F.row_number().over(same.orderBy("pairs"))).withColumns({c: F.sum(c).over(same) for c in ("sum", "pairs", "up", "down")}).filter("r__ = 1")
    scores = scores.withColumn("by", F.sum("pairs").over(event) if normalize == "event" else F.col("pairs"))
    score = F.col("sum") / F.col("by") + log2(F.greatest("up", F.lit(1)).cast("double")) - log2(F.greatest("down", F.lit(1)).cast("double"))
    return scores.select("event_id", "user", "item", score.alias("score"))
