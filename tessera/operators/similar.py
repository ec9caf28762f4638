"""Exact nearest items by cosine, over a tree of clusters, shells and cells that follows the number of rows.

Vectors are normalised and belong to the nearest of the pivots (one for each ``LEAF`` rows, at most ``PIVOTS``). A cluster is cut into shells of about
a block of rows by the angle to its pivot; shells that follow one another share a cell of about a block, and a cell of more rows (as with very many copies of one vector)
is dealt into parts by a digest of the id. An item first meets its own part of its cell, which gives its n-th best similarity so far, its bar. By the
triangle inequality of angles no vector of a shell between the angles lo and hi is nearer than max(a - hi, lo - a), a being the item's angle to the pivot: so the
item is sent, once for each cell however many clusters are in it, to the cells with a shell that can still reach the bar. There the same test goes over pieces of
at most ``PIECE`` vectors, the most promising first, and the bar rises on the way. Where very many items ask one cell, they are dealt into turns, each with a copy of the cell, by counts taken before.

The result is exact at any size; the worst case (no bound helps, as with vectors of high dimension without structure) compares all pairs, and each vector then
travels once for each block of rows: to ``CELLS`` cells or so up to ``CELLS`` * ``BLOCK`` rows, and its copies to the turns of the askers. The driver and the tasks know the pivots and the table of shells, at most ``PIVOTS`` + ``SHELLS`` entries: blocks grow where there would be more.

Null and zero vectors and those with null or non-finite components have no similarity and are dropped; an item is not its own
neighbour; ties, to nine decimals, go to the smaller id; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import scratch_path

PIVOTS, LEAF, BLOCK, SHELLS = 2048, 256, 131_072, 65_536
#: Cells as long as blocks may grow: a vector that no bound keeps back travels to so many. Askers of a turn, in blocks and at most.
CELLS, TURN, ASKERS = 16, 4, 131_072
#: Steps of the angle, from which shells are made; rows of a product; slack of a bound, far above the rounding of angles.
STEPS, PIECE, SLACK = 4096, 512, 1e-7
_FOUND = "item long, other long, similarity double"
_FOUND_ARROW = pa.schema([("item", pa.int64()), ("other", pa.int64()), ("similarity", pa.float64())])


def _unit(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for i, x in zip(batch.column(0), batch.column(1)):
                v = np.asarray(x.values, np.float64) if x.is_valid and not x.values.null_count else np.zeros(0)
                norm = np.sqrt((v * v).sum())
                if len(v) and np.isfinite(norm) and norm > 0:
                    ids.append(i.as_py())
                    out.append((v / norm).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["id", "v"])

    return vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>")).filter("id is not null").mapInArrow(work, "id long, v binary")


def _matrix(column) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_buffer(), np.float64) for x in column])


def _stored(df: DataFrame, what: str) -> DataFrame:
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _block(total: int) -> int:
    """Rows of a block: few cells, as each is one more journey for a vector, but tasks enough with the turns of their askers."""
    return max(min(BLOCK, max(1024, -(-total // CELLS))), total // SHELLS)


def _ceiling(angles: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The most that the cosine can be of vectors whose angles to the pivots are lo to hi."""
    return np.cos(np.maximum(0, np.maximum(angles - hi, lo - angles)))


class _Tree:
    """Pivots, and the shells in order of cluster and angle, each with its cell; cells with their numbers of parts."""

    def __init__(self, pivots: np.ndarray, shells: list, block: int):
        self.pivots = pivots
        self.cluster = np.array([r.cluster for r in shells], np.int64)
        self.code = self.cluster * STEPS + np.array([r.first for r in shells], np.int64)
        self.lo, self.hi = (np.array([r[c] for r in shells], np.float64) for c in ("lo", "hi"))
        n = np.array([r.n for r in shells], np.int64)
        _, self.cell = np.unique((np.cumsum(n) - n) // block, return_inverse=True)
        self.start = np.searchsorted(self.cell, np.arange(self.cell[-1] + 1))  # first shell of each cell
        self.parts = -(-np.add.reduceat(n, self.start) // (2 * block))
        self.first_part = np.cumsum(self.parts) - self.parts  # parts are numbered through: places

    def angles(self, v: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(v @ self.pivots.T, -1, 1))

    def places(self) -> int:
        return int(self.parts.sum())

    def place(self, cluster: np.ndarray, step: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Places of members."""
        cell = self.cell[np.searchsorted(self.code, cluster * STEPS + step, "right") - 1]
        return self.first_part[cell] + mark % self.parts[cell]

    def asks(self, v: np.ndarray, bar: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and places that rows with these bars must meet, without their own place."""
        can = _ceiling(self.angles(v)[:, self.cluster], self.lo, self.hi) >= bar[:, None] - SLACK
        row, cell = np.nonzero(np.logical_or.reduceat(can, self.start, axis=1))
        many = self.parts[cell]
        place = np.repeat(self.first_part[cell] - np.cumsum(many) + many, many) + np.arange(many.sum())
        row = np.repeat(row, many)
        keep = place != own[row]
        return row[keep], place[keep]

    def step(self) -> int:
        """Rows whose asks are worked out at a time."""
        return max(1, min(4_000_000 // len(self.cluster), 50_000 // self.places()))


def _meet(ids, x, cluster, angle, asked, w, bars, pivots: np.ndarray, n: int) -> pa.Table:
    """The n best of the members (ids, x) for each asked vector, as far as they reach its bar."""
    by = np.lexsort((ids, angle, cluster))
    ids, x, cluster, angle = ids[by], x[by], cluster[by], angle[by]
    ends = np.concatenate([np.flatnonzero(np.diff(cluster)) + 1, [len(ids)]])
    cuts, at = [], 0
    for end in ends:
        cuts += [(a, min(a + PIECE, end)) for a in range(at, end, PIECE)]
        at = end
    of = np.array([cluster[a] for a, _ in cuts])
    lo, hi = np.array([angle[a] for a, _ in cuts]), np.array([angle[b - 1] for _, b in cuts])
    out = []
    for at in range(0, len(asked), PIECE):
        me, q, floor = asked[at : at + PIECE], w[at : at + PIECE], bars[at : at + PIECE]
        top, who = np.full((len(me), n), -2.0), np.zeros((len(me), n), np.int64)
        reach = floor.copy()
        used, which = np.unique(of, return_inverse=True)
        most = _ceiling(np.arccos(np.clip(q @ pivots[used].T, -1, 1))[:, which], lo, hi)
        for k in np.argsort(-most.mean(0), kind="stable"):
            rows = np.flatnonzero(most[:, k] >= reach - SLACK)
            if not len(rows):
                continue
            a, b = cuts[k]
            s = np.round(q[rows] @ x[a:b].T, 9)
            s[me[rows, None] == ids[None, a:b]] = -2
            better = s.max(1) >= np.maximum(reach[rows], -1.5)
            rows, s = rows[better], s[better]
            both, names = np.concatenate([top[rows], s], 1), np.concatenate([who[rows], np.broadcast_to(ids[a:b], s.shape)], 1)
            best = np.lexsort((names, -both), axis=1)[:, :n]
            top[rows], who[rows] = np.take_along_axis(both, best, 1), np.take_along_axis(names, best, 1)
            reach[rows] = np.maximum(reach[rows], top[rows, n - 1])
        r, c = np.nonzero((top >= floor[:, None]) & (top > -1.5))
        out.append((me[r], who[r, c], top[r, c]))
    return pa.table([np.concatenate(c) for c in zip(*out)], schema=_FOUND_ARROW)


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", n: int = 10) -> DataFrame:
    """item, rank, other, similarity: the n nearest other items of each item."""
    spark = vectors.sparkSession
    unit = _stored(_unit(vectors, key, vector), "unit")
    total = unit.count()
    if not total:
        return spark.createDataFrame([], "item long, rank int, other long, similarity double")
    block = _block(total)
    chosen = unit.orderBy(F.xxhash64("id"), "id").limit(min(PIVOTS, -(-total // LEAF))).collect()  # at most PIVOTS rows
    pivots = np.stack([np.frombuffer(r.v, np.float64) for r in chosen])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                angles = np.arccos(np.clip(_matrix(part.column("v")) @ pivots.T, -1, 1))
                cols = [pa.array(angles.argmin(1), pa.int64()), pa.array(angles.min(1))]
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], ["id", "v", "cluster", "angle"])

    step = F.least(F.floor(F.col("angle") / np.pi * STEPS), F.lit(STEPS - 1)).cast("long")
    mark = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    placed = _stored(unit.mapInArrow(assign, "id long, v binary, cluster long, angle double").select("*", step.alias("step"), mark.alias("mark")), "placed")
    steps = placed.groupBy("cluster", "step").agg(F.count("*").alias("n"), F.min("angle").alias("lo"), F.max("angle").alias("hi"))
    before = Window.partitionBy("cluster").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)  # at most STEPS rows
    steps = steps.withColumn("shell", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / block))
    shells = steps.groupBy("cluster", "shell").agg(F.min("step").alias("first"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    tree = _Tree(pivots, shells.orderBy("cluster", "shell").collect(), block)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, steps, marks = (batch.column(c).to_numpy() for c in ("cluster", "step", "mark"))
            place = tree.place(cluster, steps, marks)
            cols = [batch.column(c) for c in ("id", "v", "cluster", "angle", "mark")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(place, pa.int64())], ["id", "v", "cluster", "angle", "mark", "place"])

    members = placed.mapInArrow(locate, "id long, v binary, cluster long, angle double, mark long, place long")

    def read(mine: pa.Table) -> tuple:
        return mine.column("id").to_numpy(), _matrix(mine.column("v")), mine.column("cluster").to_numpy(), mine.column("angle").to_numpy()

    def at_home(mine: pa.Table) -> pa.Table:
        ids, x, cluster, angle = read(mine)
        by = np.argsort(cluster, kind="stable")  # so that those asked together are near
        return _meet(ids, x, cluster, angle, ids[by], x[by], np.full(len(ids), -3.0), tree.pivots, n)

    best = Window.partitionBy("item").orderBy(F.desc("similarity"), "other")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
    first = _stored(ranked(members.groupBy("place").applyInArrow(at_home, _FOUND)), "first")
    bar = first.filter(F.col("rank") == n).select(F.col("item").alias("id"), F.col("similarity").alias("bar"))
    asking = members.select("id", "v", "mark", F.col("place").alias("own")).join(bar, "id", "left").select("id", "v", "mark", "own", F.coalesce("bar", F.lit(-3.0)).alias("bar"))

    def asks(batch: pa.RecordBatch) -> Iterator[tuple]:
        for at in range(0, batch.num_rows, tree.step()):
            part = batch.slice(at, tree.step())
            yield part, *tree.asks(_matrix(part.column("v")), part.column("bar").to_numpy(), part.column("own").to_numpy())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = np.zeros(tree.places(), np.int64)
        for batch in batches:
            for _, _, place in asks(batch):
                many += np.bincount(place, minlength=len(many))
        hit = np.flatnonzero(many)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(many[hit], pa.int64())], ["place", "n"])

    # of each place: how many ask it, so that no turn holds more than some blocks of them
    counted = asking.mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    turns = np.zeros(tree.places(), np.int64)
    for r in counted:
        turns[r.place] = -(-r.n // min(TURN * block, ASKERS))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, row, place in asks(batch):
                turn = part.column("mark").to_numpy()[row] // 1024 % turns[place]
                cols = [part.column(c).take(pa.array(row)) for c in ("id", "v", "bar")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(place, pa.int64()), pa.array(turn, pa.int64())], ["asked", "w", "bar", "place", "turn"])

    def score(mine: pa.Table, asked: pa.Table) -> pa.Table:
        if not mine.num_rows or not asked.num_rows:
            return _FOUND_ARROW.empty_table()
        return _meet(*read(mine), asked.column("asked").to_numpy(), _matrix(asked.column("w")), asked.column("bar").to_numpy(), tree.pivots, n)

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = turns[batch.column("place").to_numpy()]
            for turn in range(int(many.max(initial=0))):
                part = batch.filter(pa.array(many > turn))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, turn), pa.int64())], [*batch.schema.names, "turn"])

    routed = asking.mapInArrow(route, "asked long, w binary, bar double, place long, turn long")
    met = members.select("id", "v", "cluster", "angle", "place").mapInArrow(copies, "id long, v binary, cluster long, angle double, place long, turn long")
    rest = met.groupBy("place", "turn").cogroup(routed.groupBy("place", "turn")).applyInArrow(score, _FOUND)
    return ranked(first.drop("rank").unionByName(rest)).select("item", F.col("rank").cast("int").alias("rank"), "other", "similarity")
