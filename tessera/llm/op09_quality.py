"""Quality by ordinal (cumulative-link) regression on graded ratings.

Grades are 0 (toxic), 1 (not toxic, low quality) and 2 (not toxic, good). One weight vector over hashed
distinct words and a few measures of the whole text gives a score; ordered thresholds turn it into
P(grade > k) = sigmoid(score - threshold k). The expected grade ranks texts, the tail probability
P(grade = 2) selects them. Weights are sparse (L1), so words that tell nothing add no noise to long texts.

Fitted on a bounded sample: at most ``TRAIN_ROWS`` rated documents, by hash of their id.

Defined results: null text counts as empty; texts without words have only the measures; a document with
several ratings takes the lowest grade; ratings that are null are left out; repeated rows give repeated rows;
an empty table gives an empty one; without any rating all scores are 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, small_batches

WIDTH, TRAIN_ROWS, GRADES = 1 << 18, 8000, 3
STEPS, RATE, L1, LEAST_DOCS = 400, 0.05, 1e-4, 3
SELECT_AT = 0.5
MEASURES = 10

_WORD = re.compile(r"[^\W\d_]+")
_SIGN = re.compile(r"[#$%&*|!]")
_TABLE: dict[str, int] = {}
_TABLE_ENTRIES = 500_000


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted buckets of the distinct lower-cased words of a whole text, and its measures."""
    low = text.lower()
    found = _WORD.findall(low)
    distinct = set(found)
    if len(_TABLE) > _TABLE_ENTRIES:
        _TABLE.clear()
    for w in (w for w in distinct if w not in _TABLE):
        _TABLE[w] = zlib.crc32(w.encode()) & (WIDTH - 1)
    ids = np.unique(np.fromiter((_TABLE[w] for w in distinct), np.int64, len(distinct)))
    chars, n = max(len(text), 1), max(len(found), 1)
    upper = sum(map(len, re.findall("[A-Z]+", text)))
    signs = len(_SIGN.findall(text))
    measures = [
        1.0, min(signs / n, 2.0), float(signs > n / 20), upper / chars, float(upper > 0.3 * chars), len(distinct) / n, float(len(distinct) < 0.3 * n),
        np.log1p(len(found)) / 10, min(chars / n, 20.0) / 10, min(text.count("\n") / n, 1.0),
    ]
    return ids, np.array(measures)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Model:
    def __init__(self, words: np.ndarray, measures: np.ndarray, thresholds: np.ndarray):
        self.words, self.measures, self.thresholds = words, measures, thresholds

    def tails(self, text: str) -> np.ndarray:
        """P(grade > k) for each threshold k; falling, as the thresholds are ordered."""
        ids, m = features(text)
        return _sigmoid(self.words[ids].sum() + m @ self.measures - self.thresholds)


def fit(ids: list[np.ndarray], measures: np.ndarray, grade: np.ndarray) -> Model:
    """Proximal (L1) Adam on the likelihood of the cumulative-link model; thresholds stay ordered by their parametrisation."""
    zero = Model(np.zeros(WIDTH), np.zeros(MEASURES), np.zeros(GRADES - 1))
    if not len(grade):
        return zero
    used = np.bincount(np.concatenate([*ids, np.zeros(0, np.int64)]), minlength=WIDTH)
    dense = np.cumsum(used >= LEAST_DOCS) - 1
    ids = [dense[i[used[i] >= LEAST_DOCS]] for i in ids]
    width, sizes = int((used >= LEAST_DOCS).sum()), np.array(list(map(len, ids)))
    flat, row = np.concatenate([*ids, np.zeros(0, np.int64)]), np.repeat(np.arange(len(ids)), sizes)
    rare = 1 / np.bincount(grade, minlength=GRADES).clip(1) ** 0.5  # rare grades weigh more
    weight = rare[grade] / rare[grade].sum()
    p = np.zeros(width + MEASURES + GRADES - 1)
    p[-1] = 0.5
    first, second = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1):
        w, v, cut = p[:width], p[width : width + MEASURES], p[width + MEASURES :]
        theta = np.concatenate([cut[:1], cut[0] + np.cumsum(np.exp(cut[1:]))])
        s = np.bincount(row, w[flat], minlength=len(ids)) + measures @ v
        q = np.concatenate([np.ones((len(s), 1)), _sigmoid(s[:, None] - theta), np.zeros((len(s), 1))], 1)
        d = q * (1 - q)
        at = np.arange(len(s))
        prob = (q[at, grade] - q[at, grade + 1]).clip(1e-9)
        up, down = weight * d[at, grade] / prob, weight * d[at, grade + 1] / prob
        gs = down - up
        gt = np.zeros(GRADES + 1)
        np.add.at(gt, grade, up)
        np.add.at(gt, grade + 1, -down)
        gt = gt[1:GRADES]
        g_cut = np.concatenate([[gt.sum()], [gt[k:].sum() * np.exp(cut[k]) for k in range(1, len(gt))]])
        g = np.concatenate([np.bincount(flat, gs[row], minlength=width), measures.T @ gs + 1e-5 * v, g_cut])
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        scale = RATE / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        p = p - scale * first / (1 - 0.9**step)
        shrink = np.minimum(scale[:width], RATE / L1) * L1
        p[:width] = np.sign(p[:width]) * np.maximum(np.abs(p[:width]) - shrink, 0)
    cut = p[width + MEASURES :]
    words = np.zeros(WIDTH)
    words[used >= LEAST_DOCS] = p[:width]
    return Model(words, p[width : width + MEASURES], np.concatenate([cut[:1], cut[0] + np.cumsum(np.exp(cut[1:]))]))


def train(docs: DataFrame, ratings: DataFrame) -> Model:
    """Fit on ``text`` of docs and ``doc_id, grade`` of ratings."""
    small_batches(docs.sparkSession)
    graded = ratings.filter("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    chosen = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)  # bounded, so it may be broadcast
    rows = docs.select("doc_id", docs["text"].cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("grade", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [features(t.as_py() or "") for t in batch.column(1)]
            cols = [pa.array([i.astype(np.int32).tobytes() for i, _ in got], pa.binary()), pa.array([m.tobytes() for _, m in got], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["grade", "ids", "measures"])

    # copies of an id would exceed the bound, so it holds for rows as well
    got = sorted(checkpoint(rows.mapInArrow(work, "grade int, ids binary, measures binary").limit(TRAIN_ROWS)).collect())
    ids = [np.frombuffer(r.ids, np.int32).astype(np.int64) for r in got]
    measures = np.array([np.frombuffer(r.measures, np.float64) for r in got]).reshape(-1, MEASURES)
    return fit(ids, measures, np.array([r.grade for r in got], np.int64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_grade, p_good and selected of every document."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = np.array([model.tails(t.as_py() or "") for t in batch.column(1)]).reshape(-1, GRADES - 1)
            cols = [pa.array(np.round(t.sum(1), 6)), pa.array(np.round(t[:, -1], 6)), pa.array(np.round(t[:, 0], 6)), pa.array(t[:, -1] >= SELECT_AT)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "expected_grade", "p_good", "p_not_toxic", "selected"])

    return rows.mapInArrow(work, f"doc_id {dict(rows.dtypes)['doc_id']}, expected_grade double, p_good double, p_not_toxic double, selected boolean")


def grades(labels: DataFrame) -> DataFrame:
    """doc_id, grade of the labels: 0 toxic, 1 of low quality, 2 good; null where a label is missing and the other doesn't decide."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("toxic").isNull(), None).otherwise(1 + F.col("quality"))
    return labels.select("doc_id", grade.alias("grade"))
