"""Connected components of links: each partition joins its own, then alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, settled

#: Links of a partition, and half the nodes that a partition joins at a time.
LINKS = 100_000


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first())


def _joined(most: int):
    """Function for mapInArrow: (node, root) of every node of the links (u, v) of a partition, at most about ``most`` nodes at a time."""

    def find(up: dict, x):
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    def told(up: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        nodes = list(up)
        for start in range(0, len(nodes), 10_000):
            some = nodes[start : start + 10_000]
            cols = [some, [find(up, x) for x in some]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], ["node", "root"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, schema = {}, None
        for batch in batches:
            schema = batch.schema
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                u, v = find(up, u), find(up, v)
                up[max(u, v)] = min(u, v)
                if len(up) > most:
                    yield from told(up, schema)
                    up = {}
        if up:
            yield from told(up, schema)

    return work


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected links (a, b); root is the smallest node of its component, itself included.

    The links of a partition become stars first, without a shuffle; links that fill one partition only are done by that. The stars of several partitions are
    joined by rounds, each of which makes the longest path shorter by a constant factor and is cut off by a checkpoint.
    """
    e = checkpoint(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    parts = max(1, -(-e.count() // LINKS))
    kind = dict(e.dtypes)["u"]
    stars = e.coalesce(parts).mapInArrow(_joined(2 * LINKS), f"node {kind}, root {kind}")
    if parts == 1:
        return stars
    e = settled(stars.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")).distinct())
    before, now = None, _state(e)
    while before != now and now[0]:
        # large star: every node links its larger neighbours to the smallest of its neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every node links itself and its smaller neighbours to the smallest of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        rest = e.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = settled(rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        before, now = now, _state(e)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
