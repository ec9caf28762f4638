"""Preparation of ratings, movies and play counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import at_first, split_kept, strict, trimmed, worked_out

SPLITS = ((0, 5, "train"), (6, 7, "validation"), (8, 9, "test"))


def parse_ratings(lines: DataFrame, sep: str = ",", value: str = "value") -> DataFrame:
    """user, item, rating, digit (last digit of the time), split, and reason for lines that cannot be read or have user 0."""
    p = worked_out(lines, p__=split_kept(F.col(value), sep))
    time = strict(F.get("p__", 3), "bigint")
    p = worked_out(p, user=strict(F.get("p__", 0), "int"), item=strict(F.get("p__", 1), "int"), rating=strict(F.get("p__", 2), "double"), digit=F.pmod(time, F.lit(10)))
    split = F.when(F.lit(False), "")
    for low, high, name in SPLITS:
        split = split.when(F.col("digit").between(low, high), name)
    bad = F.when(F.size("p__") < 4, "fields").when(F.col("user").isNull() | F.col("item").isNull() | F.col("rating").isNull() | F.col("digit").isNull(), "number").when(F.col("user") == 0, "user")
    return p.withColumns({"split": split, "reason": bad}).drop("p__")


def movies(lines: DataFrame, value: str = "value") -> DataFrame:
    """id, title, year, genres (array), and reason for lines without two commas or a numeric id.

    The id stands before the first comma, the genres behind the last, the title between: its commas stay, quotes around it go, and a
    year in round brackets at its end becomes ``year`` (0 without one).
    """
    head, rest = at_first(F.col(value), ",")
    m = lines.withColumns({"head__": head, "rest__": rest})
    genres = F.substring_index("rest__", ",", -1)
    m = m.withColumns({"genres__": F.when(F.contains("rest__", F.lit(",")), genres), "t__": F.substring(F.col("rest__"), F.lit(1), F.length("rest__") - F.length(genres) - 1)})
    full = trimmed(F.regexp_replace(F.trim("t__"), '^"(.*)"$', "$1"))
    m = m.withColumn("full__", full).withColumn("y__", F.regexp_extract("full__", r"\(([0-9]{4})\)$", 1))
    return m.select(
        value, strict(F.col("head__"), "int").alias("id"),
        F.when(F.col("y__") != "", F.rtrim(F.substring(F.col("full__"), F.lit(1), F.length("full__") - 6))).otherwise(F.col("full__")).alias("title"),
        F.coalesce(F.col("y__").try_cast("int"), F.lit(0)).alias("year"), split_kept(F.col("genres__"), "|").alias("genres"),
        F.when(F.col("genres__").isNull(), "fields").when(strict(F.col("head__"), "int").isNull(), "id").alias("reason"),
    )


def artists(lines: DataFrame, value: str = "value") -> DataFrame:
    """id, name of lines with a tab and a numeric id; others are dropped. A name may be empty."""
    head, rest = at_first(F.col(value), "\t")
    return lines.select(strict(head, "int").alias("id"), trimmed(rest).alias("name")).filter("id is not null")


def aliases(lines: DataFrame, value: str = "value") -> DataFrame:
    """bad_id, good_id; lines with an empty or unreadable id are dropped, of several entries the largest target holds."""
    p = split_kept(F.col(value), "\t")
    rows = lines.select(strict(F.get(p, 0), "int").alias("bad_id"), strict(F.get(p, 1), "int").alias("good_id"))
    return rows.filter("bad_id is not null and good_id is not null").groupBy("bad_id").agg(F.max("good_id").alias("good_id"))


def resolve(plays: DataFrame, alias: DataFrame, aggregate: bool = False) -> DataFrame:
    """user, item, plays with aliases of items replaced; ``aggregate`` adds up the plays of a pair."""
    found = plays.join(alias, plays["item"] == alias["bad_id"], "left")
    out = found.select("user", F.coalesce("good_id", "item").alias("item"), "plays")
    return out.groupBy("user", "item").agg(F.sum("plays").alias("plays")) if aggregate else out
