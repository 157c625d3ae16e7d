"""One query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexvane.llm import (
    bpe,
    embedding_dedup,
    language_model,
    merkle,
    minhash,
    mixing,
    oracle,
    piece_bpe,
    quality,
    ranked_search,
    substring_dedup,
    suffix_dedup,
    toxicity,
    url_filter,
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "position", "takes")


def op2_suffix(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf, "documents"))


def op3_language_model(spark: SparkSession, sf: str) -> DataFrame:
    return language_model.score_documents(_table(spark, sf, "documents"))


def op4_substring(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf, "documents"))


def op5_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf, "documents"))


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf, "labels")))


def op7_urls(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, url_filter.listed_hosts(pages)).drop("listed")


def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge_quality(_table(spark, sf, "documents"))


def op9_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_documents(_table(spark, sf, "documents"), path, digests=True)


def op10_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf, "embeddings"))


def op11_pieces(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return piece_bpe.encode_documents(_table(spark, sf, "documents"), path, digests=True)


def op12_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf, "benchmark"), _table(spark, sf, "documents"))


def op13_merkle(spark: SparkSession, sf: str) -> DataFrame:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = F.when(chosen, F.translate("text", letters, letters.lower())).otherwise(F.col("text"))
    checked = merkle.verify(_table(spark, sf, "documents"), {"text": tampered})
    return checked.withColumn("proof", F.sha2("proof", 256)).withColumnRenamed("proof", "proof_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_mix,
        op2_suffix,
        op3_language_model,
        op4_substring,
        op5_minhash,
        op6_toxicity,
        op7_urls,
        op8_quality,
        op9_bpe,
        op10_embeddings,
        op11_pieces,
        op12_search,
        op13_merkle,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
