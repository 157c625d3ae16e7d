"""From raw documents to training ids: five stages, each one operator.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet in
the shared folder and read again as the next stage's documents. All stages but
the last return the columns of ``documents``. Stages look at nothing but their
own input (and, to learn, the labels), so what one removes is gone for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexvane.llm import bpe, minhash, mixing, substring_dedup, toxicity
from lexvane.storage import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon does not reject.

    The verdict is made beside the row, so null ids and repeated rows are judged
    like others. Null and empty texts stay unless the labels call empty texts
    toxic; very long texts are read whole; an empty table stays empty; further
    columns pass through.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id.

    Only the ids that go are joined. Rows without an id stay.
    """
    judged = minhash.near_duplicates(docs)
    gone = judged.filter(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has.

    A changed text is its kept words, joined by one space; a document of which
    nothing is left goes, all others keep their text as it was.
    """
    return substring_dedup.cut_texts(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, a row for each copy, in training order.

    Texts without words (null, empty) add nothing to a mix and are left out; a
    null source is a source of its own; equal positions are ordered by id;
    repeated rows are documents of their own; an empty table stays empty.
    """
    return mixing.training_stream(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to.

    Null texts are empty and have no tokens; repeated rows and ids stay as they
    are; very long texts are cut at forced boundaries only; an empty table stays
    empty.
    """
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("mix", mix),
    ("encode", encode),
]

# Learned scores, hashed signatures and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
