"""Amounts within categories: lines read from their right end, the rank in the category and the gap to its best."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strict, worked_out

RANGES = 1024


def parse(lines: DataFrame, categories: list[str], value: str = "value") -> DataFrame:
    """The line with product, category, amount and ``reason``, which is null for good lines.

    White space separates the fields but also occurs within products and categories, so a line is read from its right end: the last word is the amount, before it stands
    one of the known categories (the longest that fits), the rest is the product.
    """
    known = "|".join(r"\Q" + c.replace(r"\E", r"\E\\E\Q") + r"\E" for c in sorted(categories, key=lambda c: (-len(c), c)))
    line = F.col(value)
    amount = F.regexp_extract(line, r"(\S+)\s*\z", 1)
    head = F.regexp_extract(line, r"(?s)\A(.*?)\s*\S+\s*\z", 1)
    f = worked_out(lines, amount=strict(amount, "bigint"), head__=head)
    f = worked_out(f, category=F.regexp_extract("head__", rf"(?s)\A(?:.*?\s)??({known})\z", 1)) if categories else f.withColumn("category", F.lit(""))
    f = worked_out(f, product=F.btrim(F.expr("substring(head__, 1, length(head__) - length(category))")))
    reason = F.when(line.isNull() | (F.btrim(line) == ""), "empty").when(F.col("amount").isNull(), "amount").when(F.col("category") == "", "category").when(F.col("product") == "", "product")
    return f.withColumn("reason", reason).drop("head__")


def ranked(rows: DataFrame, category: str = "category", amount: str = "amount") -> DataFrame:
    """rows with ``rank`` (dense, by falling amount within the category) and ``gap`` to the category's best amount.

    Distinct amounts are ranked within ranges of a category's amounts, and each range adds the number of distinct amounts above it, so a category of any size is
    spread over its ranges. Rows with a null amount have neither; a null category is a category.
    """
    span = rows.filter(F.col(amount).isNotNull()).groupBy(category).agg(F.min(amount).alias("low__"), F.max(amount).alias("best__"))
    amounts = rows.filter(F.col(amount).isNotNull()).select(F.col(category).alias("c__"), F.col(amount).alias("a__")).distinct()
    amounts = amounts.join(span.withColumnRenamed(category, "k__"), F.col("c__").eqNullSafe(F.col("k__"))).drop("k__")
    place = F.when(F.col("best__") > F.col("low__"), F.floor((F.col("best__") - F.col("a__")).cast("double") / (F.col("best__") - F.col("low__")).cast("double") * (RANGES - 1))).otherwise(0)
    amounts = amounts.withColumn("range__", place)
    sizes = amounts.groupBy("c__", "range__").agg(F.count("*").alias("n__"))
    above = sizes.select(F.col("c__").alias("k__"), F.col("range__").alias("r__"), (F.sum("n__").over(Window.partitionBy("c__").orderBy("range__")) - F.col("n__")).alias("above__"))
    inside = F.row_number().over(Window.partitionBy("c__", "range__").orderBy(F.desc("a__")))
    amounts = amounts.withColumn("inside__", inside).join(above, F.col("c__").eqNullSafe(F.col("k__")) & (F.col("range__") == F.col("r__")))
    amounts = amounts.select("c__", "a__", (F.col("above__") + F.col("inside__")).alias("rank"), (F.col("best__") - F.col("a__")).alias("gap"))
    return rows.join(amounts, F.col(category).eqNullSafe(F.col("c__")) & (F.col(amount) == F.col("a__")), "left").select(*rows.columns, "rank", "gap")
