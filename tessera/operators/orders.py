"""Order totals per product and over all, in integer cents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER_SCHEMA = "id bigint, price bigint"


def batch_totals(orders: DataFrame) -> DataFrame:
    """id, n, total of the orders (id, price) of one batch."""
    return orders.groupBy("id").agg(F.count("*").alias("n"), F.sum("price").alias("total"))


def per_batch(orders: DataFrame, batch: str) -> DataFrame:
    return orders.groupBy(batch, "id").agg(F.count("*").alias("n"), F.sum("price").alias("total"))


def running(batches: DataFrame, batch: str = "batch_id") -> DataFrame:
    """id, n, total over all batches, and last: the total of the id's latest batch."""
    return batches.groupBy("id").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max_by("total", batch).alias("last"))


def grand_total(batches: DataFrame) -> DataFrame:
    return batches.agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
