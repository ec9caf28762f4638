import zlib

import numpy as np

from tessera.llm import op08_language as op


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = op.predict_held_out(docs.drop("n_chars").withColumn("held_out", docs.doc_id)).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == len(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97
    assert sum(r.rejected for r in got) <= 0.01 * len(got)


def test_edges(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = [(-1, None, "en"), (-2, "", None), (-3, "123 !? \n", "de"), (None, "the thing", "en"), (-4, "Ж", None), (-5, "the and of " * 300_000, None), (-5, "the and of " * 300_000, None)]
    docs = base.union(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    got = [r for r in op.predict_held_out(docs).collect() if r.doc_id is None or r.doc_id < 0]
    langs = {r.doc_id: r.lang_pred for r in got}
    assert langs[-1] == langs[-2] == langs[-3] == "und"
    assert langs[-5] == "en" and langs[None] in ("en", "de", "fr", "es") and langs[-4] in ("en", "de", "fr", "es")
    assert sum(r.doc_id == -5 for r in got) == 2
    assert op.predict_held_out(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in op.predict_held_out(docs.withColumn("lang", docs.lang.substr(9, 0)).filter("false or lang is null")).collect()} <= {"und", ""}


def test_noise_is_rejected(spark):
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = op.train(base)
    rng = np.random.default_rng(1)
    noise = ["".join(rng.choice(list("qxzjkvwþðЖЩÐ"), 4000)) for _ in range(5)]
    assert all(r for _, _, r in model.predict(noise))


def test_counts_do_not_depend_on_the_piece():
    text = "Été à la plage " * 5000
    whole = op.counts(text)
    op._PIECE, kept = 1000, op._PIECE
    try:
        assert abs(op.counts(text) - whole).sum() <= 0.02 * whole.sum()
    finally:
        op._PIECE = kept
