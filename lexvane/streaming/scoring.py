"""Scoring report streams with the same steps as batch tables.

Small dictionaries are tested row by row inside the stream. Larger ones are met
batch by batch with the plans of batch tables, through their index.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexvane.config import KEYWORD_FLAG, MALWARE_FLAG, DetectionConfig
from lexvane.functions.text import clean_text, contains_any
from lexvane.operators.match import Filed, TermSet, file_sets, flag_in_place, flag_sets
from lexvane.operators.model import LogisticFit
from lexvane.plans.detection import row_features
from lexvane.sources.terms import newest_version, version_terms


def text_flags(
    stream: DataFrame, terms: DataFrame, id_col: str, text_col: str, keywords: tuple[str, ...]
) -> DataFrame:
    """``(id, malware_flag, has_info_keywords)`` of a stream; keeps no state.

    ``terms`` is a static, minimal dictionary small enough to broadcast.
    """
    cleaned = stream.select(id_col, clean_text(F.col(text_col)).alias("_clean"))
    flagged = flag_in_place(cleaned, terms, "_clean")
    return flagged.select(
        id_col, "malware_flag", contains_any(F.col("_clean"), keywords).alias("has_info_keywords")
    )


def score_reports(
    stream: DataFrame,
    terms: DataFrame,
    model: LogisticFit,
    cfg: DetectionConfig = DetectionConfig(),
    entity_flag: Column | None = None,
) -> DataFrame:
    """Features and prediction of a stream of wide reports; keeps no state."""
    return model.predict(row_features(stream, cfg, entity_flag, terms))


def write_available(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start writing everything there is now as Parquet, exactly once per input file."""
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def match_batches(
    dictionary: str,
    out: str,
    id_col: str,
    text_col: str,
    keywords: tuple[str, ...],
    whole_word: bool = False,
    plan: str = "auto",
) -> Callable[[DataFrame, int], None]:
    """A function of ``(rows, batch number)`` that flags a batch and writes it under ``out``.

    Each batch looks for the newest version in the folder ``dictionary`` (see
    ``publish_terms``). A version is measured and filed once, when it is first
    met, and a batch is read once. The result ``(id, malware_flag,
    has_info_keywords, dictionary_version)`` replaces the folder of its batch
    number, so a batch done again after a failure leaves one result, by the
    version that is newest then.
    """
    ready: dict[int, tuple[TermSet, list[Filed]]] = {}

    def write(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        version = newest_version(spark, dictionary)
        if version not in ready:
            ready.clear()
            terms = version_terms(spark, dictionary, version)
            one = TermSet(MALWARE_FLAG, terms, text_col, whole_word, True, plan)
            ready[version] = one, file_sets([one])
        one, filed = ready[version]
        carry = {KEYWORD_FLAG: contains_any(clean_text(F.col(text_col)), keywords)}
        flagged = flag_sets(rows, [one], [id_col], carry, filed)
        flagged = flagged.select(
            id_col, MALWARE_FLAG, F.col(KEYWORD_FLAG).cast("int").alias(KEYWORD_FLAG), F.lit(version).alias("dictionary_version")
        )
        flagged.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return write


def write_matches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Start giving everything there is now to ``write``, batch by batch."""
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
