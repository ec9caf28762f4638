import hashlib
import re

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as cp
from test_op03 import brute


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = [(-1, None, "en", "src0", None), (-2, "123 456", "de", None, 7), (-3, "", None, "src1", 0)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    before = {r.doc_id: r for r in docs.collect()}
    for k, (name, stage) in enumerate(cp.STAGES[:4]):
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == cp.COLUMNS
        after = {r.doc_id: r for r in docs.collect()}
        if name == "language_id":
            gone = before.keys() - after.keys()
            assert {-1, -2, -3} <= gone and len(gone) <= 3 + 0.01 * len(before)
            assert sum(r.lang == before[i].lang for i, r in after.items()) > 0.97 * len(after)
            assert all(r.text == before[i].text for i, r in after.items())
        if name == "near_duplicates":
            want = {d for d, _, _, kept in brute([(i, r.text) for i, r in before.items()]) if kept}
            assert after.keys() == want and all(r == before[i] for i, r in after.items())
        if name == "secret_scan":
            assert after.keys() == before.keys()
            for i, r in after.items():
                assert r.text == re.sub(r'(token = ")[0-9a-f]{40}(")', r"\1[SECRET]\2", before[i].text, flags=re.I) and r.n_chars == len(r.text)
        if name == "mix_sources":
            assert after == before
            order = [r.doc_id for p in sorted((tmp_path / name).glob("part-*.parquet")) for r in spark.read.parquet(str(p)).collect()]
            mixed = cp.op07_mixing.mix(spark.createDataFrame(list(before.values()), docs.schema)).select("doc_id", "mix_position").collect()
            assert order == [r.doc_id for r in sorted(mixed, key=lambda r: r.mix_position)]
        before = after
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in cp.tokenize(spark, docs, "").collect():
        ids = sp.encode(before[r.doc_id].text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_run(spark):
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert 100 < out.count() <= 200


def test_empty(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter(F.lit(False))
    for _, stage in cp.STAGES:
        assert stage(spark, docs, "").count() == 0
