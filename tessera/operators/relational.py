"""Counts, sorts, tops and filters over DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import split_kept


def tokens(rows: DataFrame, text: str = "text", lines: bool = True) -> DataFrame:
    """``word`` of each token between single spaces, line by line; an empty line is one empty token, trailing empty ones are dropped."""
    value = F.col(text)
    if lines:
        rows = rows.select(F.explode(F.split(value, r"\r\n|\n|\r")).alias("line__"))
        value = F.col("line__")
    return rows.select(F.explode(split_kept(value, " ")).alias("word"))


def word_count(rows: DataFrame, text: str = "text") -> DataFrame:
    """word, n; sort by n descending, then word, for a report."""
    return tokens(rows, text).groupBy("word").agg(F.count("*").alias("n"))


def secondary_sort(rows: DataFrame, *columns: str) -> DataFrame:
    """All rows ordered by the columns in turn (range partitions, each sorted)."""
    return rows.orderBy(*columns)


def top_n_per_group(rows: DataFrame, key: str, value: str, n: int, *ties: str) -> DataFrame:
    """The n largest values of each key with their rank; equal values all count, ordered by the tie columns."""
    w = Window.partitionBy(key).orderBy(F.desc(value), *ties)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def top_n_keys(rows: DataFrame, key: str, value: str | Column, n: int, with_ties: bool = False) -> DataFrame:
    """key, total: the n keys with the largest sums; ties by key, or all keys that reach the n-th sum."""
    sums = rows.groupBy(key).agg(F.sum(value).alias("total"))
    first = sums.orderBy(F.desc("total"), key).limit(n)
    if not with_ties:
        return first
    bar = first.agg(F.min("total").alias("bar"))  # one row
    return sums.join(F.broadcast(bar), F.col("total") >= F.col("bar")).drop("bar")


def value_sums(rows: DataFrame, name: str, value: str, time: str) -> DataFrame:
    """name, value, time: times of equal values of a name are added up (the associative merge)."""
    return rows.groupBy(name, value).agg(F.sum(time).alias(time))


def value_map(rows: DataFrame, name: str, value: str, time: str) -> DataFrame:
    """One row for each name with its map from value to time, by ascending value. A name's distinct values must fit one row."""
    sums = value_sums(rows, name, value, time)
    return sums.groupBy(name).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(value, time)))).alias("times"))


def sorted_within_key(rows: DataFrame, key: str, *order: str, partitions: int | None = None) -> DataFrame:
    """Rows of a key in one partition, each partition sorted by key and order."""
    dealt = rows.repartition(partitions, key) if partitions else rows.repartition(key)
    return dealt.sortWithinPartitions(key, *order)


def blocked_by_join(rows: DataFrame, blocked: DataFrame, key: str, flag: str = "flag") -> DataFrame:
    """Rows whose key is not flagged: a left join with the list, then a filter. A key is flagged if any of its entries is."""
    flags = blocked.groupBy(key).agg(F.bool_or(F.coalesce(F.col(flag), F.lit(False))).alias("flag__"))
    return rows.join(flags, key, "left").filter(~F.coalesce(F.col("flag__"), F.lit(False))).drop("flag__")


def blocked_by_anti_join(rows: DataFrame, blocked: DataFrame, key: str, flag: str = "flag") -> DataFrame:
    """The same rows by an anti-join with the flagged entries; also for a stream."""
    return rows.join(blocked.filter(F.col(flag)).select(key), key, "left_anti")


def distinct_labels(rows: DataFrame, labels: str, sep: str = "|") -> DataFrame:
    """label, n of the labels joined by a separator in a column; empty ones are dropped."""
    return rows.select(F.explode(split_kept(F.col(labels), sep)).alias("label")).filter("label <> ''").groupBy("label").agg(F.count("*").alias("n"))


def statistics(rows: DataFrame, *columns: str) -> DataFrame:
    """column, n, mean, stdev (of the population), largest, least of each column."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns)))
    return rows.select(each.alias("e")).select("e.*").groupBy("column").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("stdev"), F.max("x").alias("largest"), F.min("x").alias("least")
    )


def lookup(keys: DataFrame, counts: DataFrame, key: str, value: str, default=0) -> DataFrame:
    """Each key with its value, or the default where there is none."""
    return keys.join(counts.select(key, value), key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def hash_split(key: Column, shares: list[int]) -> Column:
    """Number of the part that a row falls in, by its key's digest: the same for any partitioning. Shares are of their sum."""
    place = F.pmod(F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(sum(shares)))
    out, bound = F.lit(len(shares) - 1), sum(shares)
    for i in range(len(shares) - 2, -1, -1):
        bound -= shares[i + 1]
        out = F.when(place < bound, i).otherwise(out)
    return out
