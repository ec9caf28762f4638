"""Queries over the given tables, one for each operator, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import op01_sentencepiece, op02_substrings, op03_minhash, op04_pii, op05_topk, op06_spotsigs, op07_mixing, op08_language, op09_quality, op10_secrets, op11_collocations, op12_whitening, op13_packing
from .common import documents


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return op01_sentencepiece.round_trip(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op02_substrings.remove_repeated(documents(spark, sf_dir)).drop("removed")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03_minhash.components(documents(spark, sf_dir))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op04_pii.find(documents(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_language.predict_held_out(documents(spark, sf_dir))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    ratings = op09_quality.grades(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return op09_quality.score(docs, op09_quality.train(docs, ratings))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op05_topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06_spotsigs.fingerprints(documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = op07_mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "source", *(mixed[f"mix_{c}"].alias(c) for c in ("slots", "block", "release", "deadline", "slot", "position")))


def op10_secrets_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return op10_secrets.report(docs, op10_secrets.train(op10_secrets.labelled_findings(docs)))


def op11_collocations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_collocations.collocations(documents(spark, sf_dir))


def op12_whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return op13_packing.pack(op13_packing.encode_pieces(documents(spark, sf_dir), *files))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_substrings": op2_substrings,
    "op3_minhash": op3_minhash,
    "op4_pii": op4_pii,
    "op5_topk": op5_topk,
    "op6_spotsigs": op6_spotsigs,
    "op7_mixing": op7_mixing,
    "op8_language_id": op8_language_id,
    "op9_quality": op9_quality,
    "op10_secrets_scan": op10_secrets_scan,
    "op11_collocations": op11_collocations_query,
    "op12_whitening": op12_whitening_query,
    "op13_packing": op13_packing_query,
}
ORACLES: dict[str, str] = {"op2_substrings": op02_substrings.ORACLE, "op3_minhash": op03_minhash.ORACLE, "op5_topk": op05_topk.ORACLE, "op7_mixing": op07_mixing.ORACLE, "op11_collocations": op11_collocations.ORACLE}
