import hashlib

import public_tokenizers
import pytest
import sentencepiece

from tessera.llm import op01_sentencepiece as op

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "\n", " \n", "\nfoo", "a\nb", "foo bar", "  foo  bar ", "foo▁bar", "▁", "a\tb\r\nc", "\x00x", "<s>x</s>", "<0x0A>",
    "é é ﻿x", "①②", "中文 字 x", "😀 a😀b", "　x", "x" * 500, "ab" * 5000 + " " + "ab" * 5000, "word " * 20000, "foo bar", "   " * 30 + "x",
]


def expected(text):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = sp.encode(text or "")
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), h(",".join(map(str, ids))), h(sp.decode(ids))


def test_edges(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "a b", "y")], "doc_id long, text string, ids string")
    got = {r[0]: tuple(r)[1:] for r in op.round_trip(docs, MODEL).collect()}
    assert got == {i: expected(t) for i, t in enumerate(TEXTS)} | {None: expected("a b")}
    assert op.round_trip(docs.limit(0), MODEL).count() == 0


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in op.round_trip(docs, MODEL).collect()}
    assert got == {r.doc_id: expected(r.text) for r in docs.collect()}


def test_general_interface(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    enc = op.encode(docs, MODEL)
    assert {r[0]: r[1] for r in enc.collect()} == {i: sp.encode(t or "") for i, t in enumerate(TEXTS)}
    assert {r[0]: r[1] for r in op.decode(enc, MODEL).collect()} == {i: sp.decode(sp.encode(t or "")) for i, t in enumerate(TEXTS)}


def test_full_table_is_emptied(monkeypatch):
    monkeypatch.setattr(op, "TABLE_ENTRIES", 3)
    table = op.ChunkTable(MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for t in ["a b c d e f", "a b x y", "a"]:
        assert table.encode([t]) == [sp.encode(t)]


def test_unfit_model():
    with pytest.raises(Exception):
        op.ChunkTable("/no/such/model")
