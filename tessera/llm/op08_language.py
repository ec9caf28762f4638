"""Language identification by nearest centroid over hashed, weighted n-grams.

A text becomes counts of byte bigrams and trigrams of its lower-cased form (white space, digits and ASCII
signs count as one break), hashed into ``WIDTH`` buckets, weighted by (1 + log count) times inverse
document frequency and normalised. Each language has ``CENTROIDS`` centroids from spherical k-means; a text
takes the language of the centroid nearest by cosine. A text is rejected when its distance is
larger than any seen in training for texts of its length (or shorter ones), by a margin.

The classifier is fitted on a bounded sample: at most ``TRAIN_PER_LANG`` labelled texts of each language,
by hash of their id. Whole texts are read, both there and in prediction.

Defined results: null text, the empty text and texts without a letter get ``und`` with score 0 and are rejected;
ids that are null are never held out; equal centroids give the language first in order; repeated rows give
repeated rows; an empty table gives an empty one; with no labelled text at all every text gets ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, small_batches

WIDTH, CENTROIDS, TRAIN_PER_LANG, STEPS = 8192, 4, 500, 12
MARGIN = 0.3
UNDETERMINED = "und"

_LETTER = re.compile("[A-Za-z]")
_PIECE = 1 << 20
#: Bytes of ASCII that are not letters become one break; other bytes stay.
_CLASS = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_LETTER.search(text)) or any(map(str.isalpha, text)))


def counts(text: str) -> np.ndarray:
    """Hashed bigram and trigram counts of a whole text, read in pieces."""
    out = np.zeros(WIDTH, np.int64)
    raw = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)
    for at in range(0, len(raw), _PIECE):
        b = _CLASS[raw[at : at + _PIECE + 2]]
        if len(b) < 2:
            break
        b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])]
        two = b[:-1] * np.uint32(2654435761) + b[1:] * np.uint32(40503)
        three = two[:-1] * np.uint32(2246822519) + b[2:] * np.uint32(3266489917)
        for h in (two, three):
            out += np.bincount((h ^ (h >> np.uint32(15))) * np.uint32(2654435769) >> np.uint32(32 - 13), minlength=WIDTH)
    return out


def vectors(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.where(rows > 0, 1 + np.log(np.maximum(rows, 1)), 0) * idf
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)


#: Rows whose texts are Python strings at a time.
PREDICTED = 64


def spherical_k_means(x: np.ndarray, k: int) -> np.ndarray:
    """Unit centroids; the first is the mean's nearest row, each next one the row farthest from those before."""
    start = [int((x @ x.mean(0)).argmax())]
    while len(start) < min(k, len(x)):
        start.append(int((x @ x[start].T).max(1).argmin()))
    c = x[start]
    for _ in range(STEPS):
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


class Model:
    """Centroids with their languages, inverse document frequencies, and the least similarity seen by size."""

    def __init__(self, langs: list[str], centroids: np.ndarray, idf: np.ndarray, least: np.ndarray):
        self.langs, self.centroids, self.idf, self.least = langs, centroids, idf, least

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        lettered = [i for i, t in enumerate(texts) if has_letter(t)]
        out = [(UNDETERMINED, 0.0, True)] * len(texts)
        if not self.langs:
            return out
        for at in range(0, len(lettered), 128):
            part = lettered[at : at + 128]
            rows = np.stack([counts(texts[i]) for i in part])
            near = vectors(rows, self.idf) @ self.centroids.T
            size = np.log2(rows.sum(1) + 1).astype(int).clip(0, len(self.least) - 1)
            for i, j, s, z in zip(part, near.argmax(1), near.max(1), size):
                out[i] = (self.langs[j], float(np.clip(s, 0, 1)), bool(s < self.least[z] * MARGIN))
        return out


def _counted(rows: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [counts(t.as_py()).clip(0, 65535).astype(np.uint16).tobytes() if has_letter(t.as_py()) else None for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], ["lang", "counts"])

    return rows.mapInArrow(work, "lang string, counts binary").filter("counts is not null")


def train(labelled: DataFrame, key: str = "doc_id") -> Model:
    """Fit on ``text`` and ``lang`` of the rows given; ``key`` only chooses the bounded sample."""
    rows = labelled.filter("lang is not null and text is not null").select(F.xxhash64(key).alias("h"), "lang", "text")
    by = F.broadcast(rows.groupBy("lang").agg(F.count("*").alias("n")))  # a row for each language code
    # twice the wanted share of each language by hash, then exactly the first by hash
    likely = rows.join(by, "lang").filter(F.pmod("h", F.lit(1 << 20)) <= (F.lit(2.0 * TRAIN_PER_LANG) / F.col("n")) * (1 << 20) + 2)
    w = Window.partitionBy("lang").orderBy("h", "text")
    sample = likely.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= TRAIN_PER_LANG)
    sample = checkpoint(_counted(sample.select("lang", "text")))
    width = WIDTH

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(width, np.int64), 0
        for batch in batches:
            for c in batch.column(0):
                df += np.frombuffer(c.as_py(), np.uint16) > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([df.tobytes()], pa.binary())], ["n", "df"])

    sums = sample.select("counts").mapInArrow(add_up, "n long, df binary").collect()  # one vector for each task of the bounded sample
    n = sum(r.n for r in sums)
    if not n:
        return Model([], np.zeros((0, WIDTH), np.float32), np.ones(WIDTH), np.zeros(1))
    df = sum(np.frombuffer(r.df, np.int64) for r in sums)
    idf = np.log((1 + n) / (1 + df)) + 0.05

    def cluster(key, group):
        import pandas as pd

        rows = np.stack([np.frombuffer(c, np.uint16) for c in group["counts"]]).astype(np.int64)
        x = vectors(rows, idf)
        c = spherical_k_means(x, CENTROIDS)
        size = np.log2(rows.sum(1) + 1).astype(int).clip(0, 39)
        least = np.full(40, 1.0)
        np.minimum.at(least, size, (x @ c.T).max(1))
        return pd.DataFrame({"lang": [key[0]], "c": [c.tobytes()], "least": [least.tolist()]})

    fitted = sorted(sample.groupBy("lang").applyInPandas(cluster, "lang string, c binary, least array<double>").collect())
    parts = [np.frombuffer(r.c, np.float32).reshape(-1, WIDTH) for r in fitted]
    least = np.min([r.least for r in fitted], axis=0)
    least = np.minimum.accumulate(least[::-1])[::-1] if (least < 1).any() else least
    least = np.where(least >= 1, 0.0, least)
    first = int(np.argmax(least > 0)) if (least > 0).any() else 0
    least[:first] = 0.0  # texts shorter than any seen are never too far
    return Model([r.lang for r, p in zip(fitted, parts) for _ in p], np.concatenate(parts), idf, least)


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of docs, then lang_pred, score, rejected."""
    small_batches(docs.sparkSession)
    sent = list(keep) if dict(docs.dtypes).get("text") == "string" and "text" in keep else [*keep, "text__"]  # a text goes to Python once
    rows = docs.withColumn("text__", docs["text"].cast("string")).select(*(F.col(f"`{c}`") for c in sent))
    at, kept = sent.index("text") if "text__" not in sent else len(keep), len(keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PREDICTED):
                batch = whole.slice(start, PREDICTED)
                lang, score, rejected = zip(*model.predict(batch.column(at).to_pylist()))
                cols = [*batch.columns[:kept], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
                yield pa.RecordBatch.from_arrays(cols, [*keep, "lang_pred", "score", "rejected"])

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return rows.mapInArrow(work, f"{schema}, lang_pred string, score double, rejected boolean")


def held_out(key: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def predict_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learned only from rows whose id is known and not held out."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", held_out().alias("held_out"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"))
    model = train(rows.filter(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return identify(rows, model, ["doc_id", "held_out"])
