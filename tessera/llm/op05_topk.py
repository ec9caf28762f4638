"""Exact top-k search by aggregation without random access.

Vectors become integers, floor(64 x). Within a block of candidates every component has a list of its entries in
order of value; a query reads the list of component j from the top where its own component is positive, from the bottom where
it is negative, so its terms fall along each list. Lists are read in step, sequentially, to one depth after another. The sum of the terms read is known
for every candidate; the terms still unread are bounded by the current term of their lists, and, as a candidate's length is told with its entries, by the product of the unread parts' lengths
(of the query and of the candidate) to both sides. That gives lower and upper bounds. A candidate whose upper bound is under the k-th best lower bound cannot qualify and is closed.
Reading in step stops when few candidates are open, or at the last depth; then the lists are read to their end for the open candidates alone, which resolves their scores. Blocks give their k best, which are merged by query.

Query blocks meet candidate blocks by an equi-join on block numbers; the k best of a pair of blocks are all that leaves a
task. Bounds are float32 sums with a margin above their rounding error. Scores are exact integers: float64 while sums stay below 2^53, int64 below 2^62, else integers of any length.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do rows without an id or empty
vectors; a query's own rows are those with its id; vectors of another length are no candidates; ties go to the smaller id, copies
of an id are candidates of their own (told apart by rank alone); fewer candidates than k are all returned; an empty table gives an empty one. A score beyond
64 bits ranks by its exact value and is null in the column ``score``; ``search`` gives it in ``beyond``, as big-endian bytes of the score plus 2^2200.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint

K, EVERY = 20, 20
CANDIDATE_BLOCK, QUERY_BLOCK = 4096, 4096
#: Depths of the lists, as shares of the block, at which bounds are made, and the share of open candidates that ends reading in step.
DEPTHS, FEW = (0.75, 0.9), 0.125
SCALE = 64
#: Scores of 64-bit doubles lie between -OFFSET and OFFSET; how many bytes their sum with it takes.
OFFSET, WIDTH = 1 << 2200, 276
FOUND_SCHEMA = "query_id long, vec_id long, score long, beyond binary"


def integers(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, dim, v (binary doubles: the integers by 64, which is exact) of the vectors that take part."""
    rows = vectors.filter(F.col(id_col).isNotNull() & (F.size(vector) > 0)).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, out = [], [], []
            for i, x in zip(batch.column(0), batch.column(1)):
                if x.values.null_count:
                    continue
                v = np.asarray(x.values, np.float64)
                if not np.isfinite(v).all():
                    continue
                ids.append(i.as_py())
                dims.append(len(v))
                # doubles from 2^52 on are whole numbers
                out.append((np.where(np.abs(v) < 1 << 52, np.floor(SCALE * np.clip(v, -(1 << 52), 1 << 52)) / SCALE, v) + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], ["vec_id", "dim", "v"])

    return rows.mapInArrow(work, "vec_id long, dim int, v binary")


def _whole(v: np.ndarray, kind) -> np.ndarray:
    """The integers of doubles that ``integers`` gives."""
    if kind is not object:
        return (SCALE * v).astype(kind)
    return np.array([int(c) * SCALE if abs(c) >= 1 << 52 else int(c * SCALE) for c in v.flat], object).reshape(v.shape)


class Block:
    """Candidates with, for each component, the order of their entries; reads the lists to the depths ``DEPTHS``.

    What a depth gives is the same for every query but for the sign of its components, so bounds of many queries come from
    products of matrices: entries read from the top of their lists count for positive components, from the bottom for negative ones.
    ``read`` and ``resolved`` tell the entries read and the candidates read to the end, of ``asked`` queries.
    """

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        by = np.argsort(ids, kind="stable")
        self.ids, self.v = ids[by], v[by]
        self.read = self.resolved = self.asked = 0
        n, self.most = len(ids), float(np.abs(v).max(initial=0))
        self.kinds: dict = {}
        x = (self.v / (self.most or 1)).astype(np.float32)
        order = np.argsort(x, axis=0, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(n)[:, None], 0)
        self.levels = []
        for depth in sorted({int(n * d) for d in DEPTHS} - {0, n}):
            known = np.concatenate([rank >= n - depth, rank < depth], 1)
            last = np.concatenate([np.take_along_axis(x, order[at][None], 0)[0] for at in (n - depth, depth - 1)])
            both = np.concatenate([x, x], 1)
            sides = [both * known, last * ~known, ~known, both**2 * ~known]  # terms read, bounds of the others, where they are, their squares
            self.levels.append((depth, [np.ascontiguousarray(side.T, np.float32) for side in sides]))

    def whole(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Integers of queries and candidates in the narrowest kind that keeps their sums exact."""
        size = SCALE * self.most, SCALE * float(np.abs(queries).max(initial=0))
        sums = size[0] * size[1] * queries.shape[1] if max(size) < 1 << 62 else np.inf
        kind = np.float64 if sums < 1 << 53 else np.int64 if sums < 1 << 62 else object
        if kind not in self.kinds:
            self.kinds[kind] = _whole(self.v, kind)
        return _whole(queries, kind), self.kinds[kind]

    def still_open(self, level: list[np.ndarray], own: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
        """Which candidates can still be among the k best of each query."""
        terms, bounds, unread, squares = level
        signed = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], 1)
        got = signed @ terms
        rest = np.sqrt(signed**2 @ unread * ((signed != 0).astype(np.float32) @ squares))
        # every sum is at most |q| sqrt(components), as candidates are scaled to 1
        margin = (2 * q.shape[1] + 8) * 2.0**-21 * np.linalg.norm(q.astype(np.float64), axis=1) * q.shape[1] ** 0.5
        low = got - rest
        low[own[:, None] == self.ids[None, :]] = -np.inf
        bar = np.partition(low, -k, 1)[:, -k] - 2 * margin
        return got + np.minimum(rest, signed @ bounds) >= bar[:, None]

    def best(self, own: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, list]:
        """(query, row, score) of the k best candidates of each query, by score and then id."""
        exact, candidates = self.whole(queries)
        most = np.abs(queries).max(1, keepdims=True)
        scaled = (queries / np.where(most > 0, most, 1)).astype(np.float32)  # each to 1: no square underflows that the margin does not cover
        n, m = self.v.shape
        which = np.ones((len(queries), n), bool)
        done, left = np.zeros(len(queries), int), np.arange(len(queries))
        for depth, level in self.levels if n > 2 * k else []:
            which[left] &= self.still_open(level, own[left], scaled[left], k)
            done[left] = depth
            left = left[which[left].sum(1) > FEW * n]
            if not len(left):
                break
        self.asked += len(queries)
        out = []
        for i, (mine, depth) in enumerate(zip(which, done)):
            rows = np.flatnonzero(mine)
            self.read += int(depth) * m + len(rows) * m * (n - int(depth)) // n
            self.resolved += len(rows)
            rows = rows[self.ids[rows] != own[i]]
            score = candidates[rows] @ exact[i] if len(rows) else np.zeros(0)
            first = sorted(range(len(rows)), key=lambda r: (-score[r], rows[r]))[:k] if score.dtype == object else np.lexsort((rows, -score))[:k]
            out.append((np.full(len(first), i), rows[first], [int(s) for s in score[first]]))
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out]).astype(int), [s for o in out for s in o[2]]


def search(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score, beyond: the k best candidates of each query; both sides as ``integers`` gives them."""
    n_c = -(-candidates.count() // CANDIDATE_BLOCK) or 1
    n_q = -(-queries.count() // QUERY_BLOCK) or 1
    block = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
    # both sides may be the same rows: the right one gets columns of its own
    left = candidates.select("dim", block(n_c).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("q"), "vec_id", "v")
    right = queries.select(F.col("dim").alias("d"), F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("c"), block(n_q).alias("q"), F.col("vec_id").alias("own"), F.col("v").alias("asked"))

    def work(key, mine: pa.Table, asked: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("beyond", pa.binary())])
        if not mine.num_rows or not asked.num_rows:
            return schema.empty_table()
        read = lambda t, i, v: (t.column(i).to_numpy(), np.stack([np.frombuffer(x.as_buffer(), np.float64) for x in t.column(v)]))
        has, (own, q) = Block(*read(mine, "vec_id", "v")), read(asked, "own", "asked")
        cols: list[list] = [[], [], [], []]
        for at in range(0, len(own), 256):
            i, rows, score = has.best(own[at : at + 256], q[at : at + 256], k)
            fits = [-(1 << 63) <= s < 1 << 63 for s in score]
            cols[0].extend(own[at + i])
            cols[1].extend(has.ids[rows])
            cols[2].extend(s if f else None for s, f in zip(score, fits))
            cols[3].extend(None if f else (s + OFFSET).to_bytes(WIDTH, "big") for s, f in zip(score, fits))
        return pa.table([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    found = left.groupBy("dim", "c", "q").cogroup(right.groupBy("d", "c", "q")).applyInArrow(work, FOUND_SCHEMA)
    zero = F.lit(OFFSET.to_bytes(WIDTH, "big"))
    side = F.when(F.col("beyond").isNull(), 0).when(F.col("beyond") > zero, 1).otherwise(-1)
    best = Window.partitionBy("query_id").orderBy(side.desc(), F.desc("score"), F.desc("beyond"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "beyond")


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """The k best rows for each row whose id is divisible by ``every``."""
    rows = checkpoint(integers(vectors))
    return search(rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"]), rows, k).drop("beyond")


ORACLE = f"""
WITH able AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM able q JOIN able c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {EVERY} = 0
),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
