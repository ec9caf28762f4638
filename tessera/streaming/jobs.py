"""Streams over the batch functions: text lines in, increments or tables out. Paths and triggers are parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import clicks, orders, relational, rerank
from ..sources.files import json_rows
from .increments import Increments, query_id


def line_stream(spark: SparkSession, *paths: str, files_per_batch: int | None = None) -> DataFrame:
    """``value`` of the lines of new files; several folders are joined to one stream."""
    out = None
    for path in paths:
        reader = spark.readStream.schema("value string")
        reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader
        one = reader.text(path)
        out = one if out is None else out.unionByName(one)
    return out


def start(rows: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run a function for each micro-batch; without an interval, over what is there now."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def click_counts(spark: SparkSession, lines: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Clicks per day and course and per day, host and course from one cleaned stream, and the rejected lines, in three tables."""
    day = Increments(spark, f"{path}/day", {"day_course": "string"}, {"clicks": "bigint"})
    host = Increments(spark, f"{path}/host", {"day_host_course": "string"}, {"clicks": "bigint"})

    def each(batch: DataFrame, n: int) -> None:
        query = query_id(spark, checkpoint)
        parsed = clicks.parse(batch).persist()
        good = parsed.filter("reason is null and course_id <> 0")
        day.write(clicks.per_day(good), query, n)
        host.write(clicks.per_day_and_host(good), query, n)
        parsed.filter("reason is not null").select("value", "reason").write.mode("overwrite").parquet(f"{path}/rejects/query_id={query}/batch_id={n}")
        parsed.unpersist()

    return start(lines, each, checkpoint, every)


def daily_clicks(lines: DataFrame, late: str = "1 day") -> DataFrame:
    """day, course_id, clicks by event time: a day is given out once, when the watermark has passed its end; later lines of it are dropped."""
    timed = clicks.clean(lines).withWatermark("time", late)
    counts = timed.groupBy(F.window("time", "1 day"), "course_id").agg(F.count("*").alias("clicks"))
    return counts.select(F.to_date("window.start").alias("day"), "course_id", "clicks")


def _side(rows: DataFrame, path: str, what: str, query: str, n: int) -> None:
    """Write a side table of one batch; a replay replaces it."""
    rows.write.mode("overwrite").parquet(f"{path}/{what}/query_id={query}/batch_id={n}")


def side(spark: SparkSession, path: str, what: str, schema: str) -> DataFrame:
    """A side table of all batches, with query_id and batch_id; empty if none was written."""
    try:
        return spark.read.schema(f"{schema}, query_id string, batch_id bigint").parquet(f"{path}/{what}")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], f"{schema}, query_id string, batch_id bigint")


DAILY_KEYS, DAILY_VALUES = {"day": "date", "course_id": "int"}, {"clicks": "bigint"}


def stored_daily_clicks(spark: SparkSession, lines: DataFrame, path: str, checkpoint: str, late: str = "1 day", every: str | None = None) -> tuple[StreamingQuery, Increments]:
    """Clicks per day and course by event time, where every line ends in one of four tables: counts, ``rejects`` (a zero course has the reason ``zero``), or ``late``.

    A line is late if its day ended before the watermark, the newest time of the query's earlier batches less ``late``. The newest time of each batch is stored, so a
    replayed batch judges its lines as it did before.
    """
    table = Increments(spark, f"{path}/days", DAILY_KEYS, DAILY_VALUES)

    def each(batch: DataFrame, n: int) -> None:
        query = query_id(spark, checkpoint)
        before = side(spark, path, "times", "newest timestamp").filter((F.col("query_id") == query) & (F.col("batch_id") < n))
        limit = before.agg((F.max("newest") - F.expr(f"interval {late}")).alias("w")).first().w  # one row
        parsed = clicks.parse(batch).persist()
        good = parsed.filter("reason is null and course_id <> 0")
        ended = F.lit(False) if limit is None else F.to_timestamp(F.date_add(F.to_date("time"), 1)) <= F.lit(limit)
        _side(good.agg(F.max("time").alias("newest")), path, "times", query, n)
        _side(good.filter(ended).select("value", "time"), path, "late", query, n)
        _side(parsed.filter("reason is not null or course_id = 0").select("value", F.coalesce("reason", F.lit("zero")).alias("reason")), path, "rejects", query, n)
        table.write(good.filter(~ended).groupBy(F.to_date("time").alias("day"), "course_id").agg(F.count("*").alias("clicks")), query, n)
        parsed.unpersist()

    return start(lines, each, checkpoint, every), table


def closed_days(spark: SparkSession, path: str, late: str = "1 day") -> DataFrame:
    """day, course_id, clicks of the days that the watermark has passed, whose counts do not change any more."""
    newest = side(spark, path, "times", "newest timestamp").groupBy("query_id").agg(F.max("newest").alias("newest")).agg((F.min("newest") - F.expr(f"interval {late}")).alias("w"))
    totals = Increments(spark, f"{path}/days", DAILY_KEYS, DAILY_VALUES).totals()
    return totals.join(F.broadcast(newest), F.to_timestamp(F.date_add("day", 1)) <= F.col("w")).drop("w")


def word_counts(spark: SparkSession, lines: DataFrame, path: str, checkpoint: str, every: str | None = None) -> tuple[StreamingQuery, Increments]:
    """Word counts of each batch on its own (``batches``), which also add up (``totals``)."""
    table = Increments(spark, path, {"word": "string"}, {"n": "bigint"})
    return start(lines, table.sink(checkpoint, lambda b: relational.word_count(b, "value")), checkpoint, every), table


def order_totals(spark: SparkSession, lines: DataFrame, path: str, checkpoint: str, every: str | None = None) -> tuple[StreamingQuery, Increments]:
    """Orders as JSON messages: number and sum for each product and batch, and the rejected messages of the batch; totals, last values and the grand total follow from the table."""
    table = Increments(spark, path, {"id": "bigint"}, {"n": "bigint", "total": "bigint"})

    def each(batch: DataFrame, n: int) -> None:
        query = query_id(spark, checkpoint)
        good, bad = json_rows(batch, orders.ORDER_SCHEMA, ["id", "price"])
        _side(bad, path, "rejects", query, n)
        table.write(orders.batch_totals(good), query, n)

    return start(lines, each, checkpoint, every), table


def unblocked(lines: DataFrame, blocked: DataFrame) -> DataFrame:
    """The lines whose second word is not flagged in the list (name, flag); a stream-static anti-join."""
    from ..functions.text import part, split_kept

    named = lines.withColumn("name", part(split_kept(F.col("value"), " "), 1))
    return relational.blocked_by_anti_join(named, blocked, "name").select("value")


BUCKETS = 256


def bucketed(rows: DataFrame, key: str, path: str) -> None:
    """Write a table partitioned by a hash bucket of its key, for reads of few keys."""
    rows.withColumn("bucket", F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(BUCKETS))).write.mode("overwrite").partitionBy("bucket").parquet(path)


def of_keys(spark: SparkSession, path: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows of a bucketed table in the buckets of the keys; other partitions are not read. At most ``BUCKETS`` numbers are collected."""
    found = [r[0] for r in keys.select(F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(BUCKETS))).distinct().collect()]
    return spark.read.parquet(path).filter(F.col("bucket").isin(found)).drop("bucket")


EVENT = [("user", "int"), ("item", "int"), ("rating", "double"), ("millis", "bigint")]
EVENT_SCHEMA = ", ".join(f"{n} {k}" for n, k in EVENT)


def rerank_stream(spark: SparkSession, lines: DataFrame, ratings_path: str, similar_path: str, out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Events ``user,item,rating,millis`` re-rank candidates by the bucketed tables of ratings (by user) and similarities (by item1).

    Under ``out``, each batch writes ``scores``, ``rejects``, ``events`` (by day) and ``repeated``: every line is an event, a repeated one or a reject. Equal events are one event, within a
    batch and across batches and checkpoints: those of a batch are looked up among the stored events of the same days.
    """
    from ..sources.files import delimited

    def each(batch: DataFrame, n: int) -> None:
        query = query_id(spark, checkpoint)
        good, bad = delimited(batch, ",", EVENT)
        _side(bad, out, "rejects", query, n)
        good = good.withColumn("event_id", F.concat_ws(":", *good.columns)).withColumn("day", F.floor(F.col("millis") / 86_400_000)).persist()
        days = [r.day for r in good.select("day").distinct().collect()]  # the days of one batch
        known = side(spark, out, "events", f"event_id string, {EVENT_SCHEMA}, day bigint").filter(F.col("day").isin(days) & ((F.col("query_id") != query) | (F.col("batch_id") < n)))
        counted = good.groupBy(*good.columns).agg(F.count("*").alias("times"))
        counted = counted.join(known.select("event_id").distinct().withColumn("known", F.lit(True)), "event_id", "left").persist()
        events = counted.filter("known is null").select(*good.columns)
        more = F.when(F.col("known").isNull(), F.col("times") - 1).otherwise(F.col("times"))
        _side(counted.withColumn("times", more).filter("times > 0").select("event_id", "times"), out, "repeated", query, n)
        events.write.mode("overwrite").partitionBy("day").parquet(f"{out}/events/query_id={query}/batch_id={n}")
        ratings = of_keys(spark, ratings_path, events.select("user"), "user")
        near = of_keys(spark, similar_path, events.select(F.col("item").alias("item1")), "item1")
        more = near.select(F.col("item2").alias("item1")).unionByName(events.select(F.col("item").alias("item1")))
        similar = of_keys(spark, similar_path, more, "item1")
        _side(rerank.rerank(events, ratings, similar), out, "scores", query, n)
        counted.unpersist(), good.unpersist()

    return start(lines, each, checkpoint, every)
