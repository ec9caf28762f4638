"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Every component c of a vector becomes the integer x = floor(64 c) + 1,000,000. One pass counts and sums the x, a second one sums the products of y = x - m, where
m is the rounded mean: y is small, blocks of rows are multiplied as floats only where every sum stays below 2^53, and the
sums of tasks travel as integers cut into 40-bit parts, which a shuffle by matrix entry adds up. So the scatter n * sum(y y') - sum(y) sum(y)' is exact, whatever
the size of the values and the order of the rows, before it becomes a matrix of doubles (one square matrix of the dimension, the only thing that reaches the driver).

The pivoted Cholesky factor L of that matrix has a triangular form with falling pivots, in which one-sided Jacobi rotations of the columns converge fast and keep small
eigenvalues accurate relative to themselves: when all columns are orthogonal, their squared norms are the eigenvalues and the columns divided by their norms the components.
Pairs of columns are rotated in rounds of pairs that do not meet, all pairs of a round at once. A third pass projects the rows, a fourth measures the
covariance of the result.

Defined cases: rows whose vector is null, empty, or holds null, NaN or infinite entries take no part; of vectors of several lengths, those of the most frequent one (of
equally frequent ones the longest) take part. Repeated rows and ids, null ids: rows like others. Components beyond the rank (pivots below ``RANK`` of the first)
have no variance to scale and do not exist; if all vectors are equal, there are no rows. Without rows, the result is empty. Entries beyond 2^62 / 64 are held at that.
``deviation`` is null where it passes 64 bits; ``deviation_exact`` holds it as text. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Pivots under this share of the largest are rounding errors of linearly dependent entries.
RANK = 1e-13
#: Rows that are multiplied at a time, and bits of a part of a sum.
BLOCK, PART = 4096, 40
LIMIT = float(1 << 62)


def vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The id and the vector as doubles, of the rows that take part."""
    v = df[vector_col].cast("array<double>")
    rows = df.select(df[id_col].alias("vec_id"), v.alias("v")).filter(F.coalesce(F.size("v") > 0, F.lit(False)) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("d")).limit(1).select("d")
    return rows.join(F.broadcast(usual), F.size("v") == F.col("d"), "left_semi")


def whole(v: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1,000,000 as long."""
    return np.clip(np.floor(SCALE * v), -LIMIT, LIMIT).astype(np.int64) + SHIFT


def blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            some = batch.slice(start, BLOCK)
            yield some.column(0), whole(some.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d))


def exact_sum(x: np.ndarray) -> np.ndarray:
    """Sums of the columns, as Python integers where they may pass 64 bits."""
    if int(np.abs(x).max(initial=0)) * len(x) < 1 << 62:
        return x.sum(0).astype(object)
    return x.astype(object).sum(0)


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y exactly: by floats if all sums stay below 2^53, else by halves of the values, else by Python integers."""
    most = int(np.abs(y).max(initial=0)) if y.dtype != object else max(map(abs, y.flat), default=0)
    if most * most * len(y) < 1 << 53:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    if most < 1 << 40:
        high, low = y >> 20, y & 0xFFFFF
        parts = [(a.astype(float).T @ b.astype(float)).astype(np.int64).astype(object) for a, b in ((high, high), (high, low), (low, low))]
        return (parts[0] << 40) + ((parts[1] + parts[1].T) << 20) + parts[2]
    y = y.astype(object)
    return y.T @ y


def parts(values: np.ndarray) -> list[np.ndarray]:
    """An integer as four parts of 40 bits, the last with the sign, so that sums of parts stay below 64 bits."""
    out = [np.array([int(v) >> PART * i & (1 << PART) - 1 for v in values], np.int64) for i in range(3)]
    return [*out, np.array([int(v) >> PART * 3 for v in values], np.int64)]


def joined(row) -> int:
    return sum(int(row[f"p{i}"]) << PART * i for i in range(4))


def _sum_parts(df: DataFrame, work, keys: str) -> list:
    """The sums of all tasks: one row for each entry of a vector or matrix of the dimension."""
    rows = df.mapInArrow(work, f"{keys}, p0 long, p1 long, p2 long, p3 long")
    names = [k.split()[0] for k in keys.split(",")]
    return rows.groupBy(*names).agg(*(F.sum(f"p{i}").alias(f"p{i}") for i in range(4))).collect()


def column_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    def work(batches):
        n, s = 0, np.zeros(d, object)
        for _, x in blocks(batches, d):
            n, s = n + len(x), s + exact_sum(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1), pa.int32()), *map(pa.array, parts(np.array([*s, n], object)))], ["i", "p0", "p1", "p2", "p3"])

    found = {r.i: joined(r) for r in _sum_parts(rows, work, "i int")}
    return found.get(d, 0), [found.get(i, 0) for i in range(d)]


def scatter(rows: DataFrame, d: int, n: int, sums: list[int], centre: list[int]) -> np.ndarray:
    """n^2 times the covariance, as exact integers."""
    i, j = np.triu_indices(d)
    mean = np.array(centre, np.int64)

    def work(batches):
        total = np.zeros((d, d), object)
        empty = True
        for _, x in blocks(batches, d):
            far = max(np.abs(x).max(initial=0), np.abs(mean).max(initial=0)) >= 1 << 61
            total, empty = total + exact_products(x.astype(object) - mean.astype(object) if far else x - mean), False
        if not empty:
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *map(pa.array, parts(total[i, j]))], ["i", "j", "p0", "p1", "p2", "p3"])

    out = np.zeros((d, d), object)
    for r in _sum_parts(rows, work, "i int, j int"):
        out[r.i, r.j] = out[r.j, r.i] = joined(r)
    rest = np.array([s - n * m for s, m in zip(sums, centre)], object)
    return n * out - np.outer(rest, rest)


def pivoted_cholesky(a: np.ndarray, least: float = RANK) -> np.ndarray:
    """L with a = L L', its columns by falling pivot: triangular but for the order of the rows."""
    rest, d = a.astype(float).copy(), len(a)
    columns = []
    first = rest.diagonal().max(initial=0)
    for _ in range(d):
        p = int(np.argmax(rest.diagonal()))
        if not rest[p, p] > least * first:
            break
        column = rest[:, p] / np.sqrt(rest[p, p])
        rest -= np.outer(column, column)
        rest[p, :] = rest[:, p] = 0.0
        columns.append(column)
    return np.array(columns).T.reshape(d, -1)


def rounds(k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of k columns in rounds of pairs that do not meet."""
    ring = [*range(k), *([-1] if k % 2 else [])]
    out = []
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], ring[: len(ring) // 2 - 1 : -1]) if a >= 0 and b >= 0]
        if pairs:
            out.append(tuple(np.array(pairs).T))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60, tolerance: float = 1e-15) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues of factor factor', falling; unit eigenvectors as columns): the columns are rotated until they are orthogonal."""
    a = factor.astype(float).copy()
    for _ in range(sweeps):
        turned = False
        for p, q in rounds(a.shape[1]):
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            apart = np.abs(xy) > tolerance * np.sqrt(xx * yy)
            if not apart.any():
                continue
            turned = True
            with np.errstate(divide="ignore", invalid="ignore"):
                zeta = (yy - xx) / (2 * xy)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(apart, t, 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            a[:, p], a[:, q] = c * x - s * y, s * x + c * y
        if not turned:
            break
    norms = np.sqrt((a * a).sum(0))
    by = np.argsort(-norms, kind="stable")
    return norms[by] ** 2, a[:, by] / norms[by]


class Whitening:
    """The model: ``n``, exact ``sums`` of the integers x, ``values`` and ``components`` (columns) of the covariance, ``trace``."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray):
        self.n, self.sums = n, sums
        self.centre = [(2 * s + n) // (2 * n) for s in sums]
        self.trace = float(np.trace(covariance))
        self.values, self.components = one_sided_jacobi(pivoted_cholesky(covariance))


def fit(rows: DataFrame) -> Whitening | None:
    """The whitening of ``vectors()``; None without rows."""
    first = rows.select(F.size("v")).first()
    if first is None:
        return None
    d = first[0]
    n, sums = column_sums(rows, d)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    exact = scatter(rows, d, n, sums, centre)
    return Whitening(n, sums, np.array([[v / (n * n) for v in row] for row in exact]).reshape(d, d))  # integers divide with one rounding


def transform(rows: DataFrame, model: Whitening, k: int = COMPONENTS) -> DataFrame:
    """vec_id, deviation_exact (text), w (the whitened values of the first k components) of every row."""
    n, d = model.n, len(model.sums)
    k = min(k, len(model.values))
    basis = model.components[:, :k] / np.sqrt(model.values[:k])
    centre, rest = np.array(model.centre, np.int64), np.array([s - n * m for s, m in zip(model.sums, model.centre)], object)
    offset = np.array([r / n for r in rest])

    def work(batches):
        for ids, x in blocks(batches, d):
            far = max(np.abs(x).max(initial=0), np.abs(centre).max(initial=0)) >= 1 << 61
            y = x.astype(object) - centre.astype(object) if far else x - centre
            most = int(np.abs(y).max(initial=0)) if not far else max(map(abs, y.flat))
            gap = most * n + max(map(abs, rest))
            if gap * gap * d < 1 << 63:
                z = n * y - rest.astype(np.int64)
                deviation = (z * z).sum(1).tolist()
            else:
                z = n * y.astype(object) - rest
                deviation = (z * z).sum(1).tolist()
            w = (y.astype(float) - offset) @ basis
            out = pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), k).cast(pa.list_(pa.float64())) if k else pa.array([[]] * len(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(map(str, deviation), pa.string()), out], ["vec_id", "deviation_exact", "w"])

    return rows.mapInArrow(work, f"vec_id {dict(rows.dtypes)['vec_id']}, deviation_exact string, w array<double>")


def identity_error(whitened: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``w`` minus the identity. The mean is zero but for rounding; it is taken off all the same."""

    def work(batches):
        n, s, p = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = batch.column(0).flatten().to_numpy().reshape(-1, k)
            n, s, p = n + len(w), s + w.sum(0), p + w.T @ w
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), pa.array([n] * k, pa.int64()), pa.array(s), pa.array(p.tolist(), pa.list_(pa.float64()))], ["i", "n", "s", "p"])

    rows = whitened.select("w").mapInArrow(work, "i int, n long, s double, p array<double>")
    sums = rows.select("i", "n", "s", F.posexplode("p").alias("j", "p")).groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("p").alias("p")).collect()
    cov, mean = np.zeros((k, k)), np.zeros(k)
    for r in sums:
        cov[r.i, r.j], mean[r.i] = r.p / r.n, r.s / r.n
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact of every row that takes part and component."""
    rows = vectors(df, id_col, vector_col)
    model = fit(rows)
    kind = dict(rows.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact string"
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    k = min(k, len(model.values))
    done = transform(rows, model, k)
    error = identity_error(done, k)
    explained = F.array(*(F.lit(float(v / model.trace)) for v in model.values[:k]))
    out = done.select("vec_id", "deviation_exact", F.posexplode("w").alias("i", "whitened"))
    return out.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), F.col("deviation_exact").try_cast("long").alias("deviation"), "whitened",
        F.get(explained, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"), "deviation_exact",
    )
