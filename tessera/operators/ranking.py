"""Mean AUC per user, negative sampling, and the popularity baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import scratch_path

SCORE_BUCKETS = 1024
ITEM_RANGE = 4096
#: Bits of a row's place in its part, as monotonically_increasing_id() gives it.
PART_BITS = 33


def auc_per_user(positives: DataFrame, negatives: DataFrame, user: str = "user", score: str = "score") -> DataFrame:
    """user, auc: the share of (positive, negative) pairs of a user with a strictly higher positive score; users lacking either drop.

    Scores are counted by value first; negatives below a value are the totals of lower score buckets plus those below within the
    bucket, so a user with very many scores is spread over its buckets.
    """
    both = positives.select(user, score, F.lit(1).alias("p")).unionByName(negatives.select(user, score, F.lit(0).alias("p")))
    both = both.filter(F.col(user).isNotNull() & F.col(score).isNotNull()).withColumn(score, F.col(score).cast("double")).filter(~F.isnan(score))
    counts = both.groupBy(user, score).agg(F.sum("p").alias("p"), F.sum(1 - F.col("p")).alias("n"))
    ends = counts.agg(F.min(score).alias("low"), F.max(score).alias("high"))  # one row
    counts = counts.join(F.broadcast(ends)).withColumn("bucket", F.when(F.col("high") > F.col("low"), F.floor((F.col(score) - F.col("low")) / (F.col("high") - F.col("low")) * (SCORE_BUCKETS - 1))).otherwise(0))
    totals = counts.groupBy(user, "bucket").agg(F.sum("n").alias("n"))
    before = Window.partitionBy(user).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(user, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lower"))
    inside = Window.partitionBy(user, "bucket").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("below", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(totals, [user, "bucket"])
    sums = counts.groupBy(user).agg(F.sum(F.col("p") * (F.col("lower") + F.col("below"))).alias("right"), F.sum("p").alias("p"), F.sum("n").alias("n"))
    return sums.filter("p > 0 and n > 0").select(user, (F.col("right") / (F.col("p") * F.col("n"))).alias("auc"))


def mean_auc(positives: DataFrame, negatives: DataFrame, user: str = "user", score: str = "score") -> DataFrame:
    """One row: users, mean_auc."""
    return auc_per_user(positives, negatives, user, score).agg(F.count("*").alias("users"), F.avg("auc").alias("mean_auc"))


def numbered_items(items: DataFrame, item: str = "item") -> DataFrame:
    """item, idx: dense numbers from 0 in the order of ids, of any spread.

    The distinct ids are sorted by ranges, and written once with their place in their part; each part then begins where the parts before it end. Only the sizes of the
    parts are gathered, one number for each.
    """
    spark = items.sparkSession
    path = scratch_path(spark, "numbered")
    rows = items.select(item).filter(F.col(item).isNotNull()).distinct().repartitionByRange(item).sortWithinPartitions(item)
    rows.withColumn("at__", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.schema(rows.withColumn("at__", F.lit(0).cast("bigint")).schema).parquet(path)
    placed = placed.select(item, F.shiftright("at__", PART_BITS).alias("part__"), F.col("at__").bitwiseAND(F.lit((1 << PART_BITS) - 1)).alias("k__"))
    before, starts = 0, []
    for r in placed.groupBy("part__").agg(F.max("k__").alias("k")).orderBy("part__").collect():  # one row for each part
        starts.append((r.part__, before))
        before += r.k + 1
    starts = spark.createDataFrame(starts, "part__ bigint, before__ bigint")
    return placed.join(F.broadcast(starts), "part__").select(item, (F.col("before__") + F.col("k__")).alias("idx"))


def counted_before(rows: DataFrame, key: str, order: list[str], counted: Column, block: Column, name: str) -> DataFrame:
    """rows with the sum of ``counted`` over the rows of the key up to each, in an order that rises with ``block``: blocks are summed first and then each on its own, so
    a key with very many rows is spread over its blocks."""
    rows = rows.withColumn("block__", block).withColumn("counted__", counted)
    sums = rows.groupBy(key, "block__").agg(F.sum("counted__").alias("s__"))
    earlier = F.coalesce(F.sum("s__").over(Window.partitionBy(key).orderBy("block__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(key, "block__", earlier.alias("earlier__"))
    upto = Window.partitionBy(key, "block__").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn(name, F.sum("counted__").over(upto)).join(sums, [key, "block__"])
    return rows.withColumn(name, F.col(name) + F.col("earlier__")).drop("block__", "counted__", "earlier__")


def draw(user: str, number: str, seed: int) -> Column:
    """A number from 0 to 2^32 - 1 by the digest of user, draw number and seed."""
    text = F.concat_ws(":", F.col(user).cast("string"), F.col(number).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def sample_negatives(positives: DataFrame, items: DataFrame, seed: int = 0, user: str = "user", item: str = "item") -> DataFrame:
    """user, draw, item: for each user as many items as it has distinct positive ones, drawn with replacement from the others.

    A draw r below (items - positives) is moved past the positive items up to it: the same distribution as drawing again until the
    item is not positive, without a failed draw. Users that have all items get none.
    """
    index = numbered_items(items, item)
    pos = positives.select(user, item).distinct().join(index, item)
    total = index.agg(F.count("*").alias("items__"))  # one row
    pos = counted_before(pos, user, ["idx"], F.lit(1), F.expr(f"idx div {ITEM_RANGE}"), "k").withColumn("k", (F.col("k") - 1).cast("int"))
    pos = pos.join(pos.groupBy(user).agg(F.count("*").alias("n")), user).join(F.broadcast(total)).filter("items__ > n")
    others = F.greatest(F.col("items__") - F.col("n"), F.lit(1))  # Spark may divide before the filter
    draws = pos.select(user, F.col("k").alias("draw"), (draw(user, "k", seed) % others).alias("at"), F.lit(1).alias("kind"))
    marks = pos.select(user, F.lit(-1).cast("int").alias("draw"), (F.col("idx") - F.col("k")).alias("at"), F.lit(0).alias("kind"))
    moved = counted_before(marks.unionByName(draws), user, ["at", "kind"], 1 - F.col("kind"), F.expr(f"at div {ITEM_RANGE}"), "past").filter("kind = 1")
    return moved.select(user, "draw", (F.col("at") + F.col("past")).alias("idx")).join(index, "idx").select(user, "draw", item)


def popularity(train: DataFrame, item: str = "item", rating: str = "rating") -> DataFrame:
    """item, score: the sum of the ratings of an item."""
    return train.groupBy(item).agg(F.sum(rating).alias("score"))


def predict_popularity(pairs: DataFrame, scores: DataFrame, item: str = "item") -> DataFrame:
    """pairs with the score of their item, 0 for unknown ones."""
    return pairs.join(scores, item, "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def rmse(truth: DataFrame, predicted: DataFrame, keys: list[str], actual: str = "rating", score: str = "prediction") -> DataFrame:
    """One row: n, rmse over the pairs that both sides have."""
    both = truth.join(predicted, keys)
    return both.agg(F.count("*").alias("n"), F.sqrt(F.avg(F.pow(F.col(actual) - F.col(score), F.lit(2.0)))).alias("rmse"))
