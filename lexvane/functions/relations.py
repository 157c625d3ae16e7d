"""Reading relation lists that were stored as text.

A relation list is a list of mappings holding ``from_id`` and ``to_id``. Lists
of the plain shape tools write are read by Spark's JSON reader inside the JVM.
Only strings of another shape (nested values, ``None``/``True``, trailing
commas, escapes ...) go through a small Arrow-batched helper that reads Python
literals, so both paths together accept what Python accepts.
"""

from __future__ import annotations

import ast
import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIRS = "array<struct<from_id:bigint,to_id:bigint>>"

_QUOTED = r"""(?:'[^'"{}\\\r\n\x00]*+'|"[^'"{}\\\r\n\x00]*+")"""
_PLAIN = r"(?:0|-?[1-9][0-9]{0,17}|-?(?:0|[1-9][0-9]{0,14})\.[0-9]{1,15})(?![0-9.eEjJ_])"
_FIELD = rf"{_QUOTED}[ \t]*+:[ \t]*+(?:{_PLAIN}|{_QUOTED})[ \t]*+"
# One flat mapping with the blanks around it.
_ITEM = rf"[ \t]*+\{{[ \t]*+(?:{_FIELD}(?:,[ \t]*+{_FIELD})*+)?\}}[ \t]*+"
_MARK = "\x01"
_INT_TEXT = r"^[ \t]*[+-]?[0-9]{1,18}[ \t]*$"
_DECIMAL = r"^-?[0-9.]+(E-?[0-9]+)?$"
# A decimal in quotes, with or without an exponent, is no id, one without quotes
# is: left to the helper.
_QUOTED_DECIMAL = r"""['"][ \t]*[+-]?[0-9]*(?:\.[0-9]*(?:[eE][+-]?[0-9]*)?|[eE][+-]?[0-9]*)[ \t]*['"]"""
# Digits of other scripts and digit groups are numbers to Python only.
_ODD_NUMBER = r"[_\P{ASCII}]"


def _plain_shape(relations: Column) -> Column:
    """True if the text is one flat list of flat mappings.

    Each mapping is replaced by a mark; what is left has to read as marks
    separated by commas between brackets. This needs no repetition over the
    whole list, so long lists do not deepen the matcher's stack.
    """
    skeleton = F.trim(F.regexp_replace(relations, _ITEM, _MARK))
    between = F.replace(skeleton, F.lit("," + _MARK), F.lit(""))
    one_or_more = F.startswith(skeleton, F.lit("[" + _MARK)) & (between == f"[{_MARK}]")
    unclear = F.contains(relations, F.lit(_MARK)) | relations.rlike(_QUOTED_DECIMAL)
    return ~unclear & ((skeleton == "[]") | one_or_more)


def _plain_text_ids(relations: Column) -> Column:
    """Array of id texts for the plain shape, else null."""
    listed = F.from_json(relations, "array<struct<from_id:string,to_id:string>>")
    return F.when(_plain_shape(relations), listed)


def _has_odd_number(raw: Column) -> Column:
    return F.exists(
        raw,
        lambda e: F.coalesce(e["from_id"].rlike(_ODD_NUMBER), F.lit(False))
        | F.coalesce(e["to_id"].rlike(_ODD_NUMBER), F.lit(False)),
    )


def _as_pairs(raw: Column) -> Column:
    def as_id(value: Column) -> Column:
        whole = F.trim(F.replace(value, F.lit("\t"))).try_cast("bigint")
        truncated = value.try_cast("double").try_cast("bigint")
        return F.when(value.rlike(_INT_TEXT), whole).when(value.rlike(_DECIMAL), truncated)

    pairs = F.transform(
        raw, lambda e: F.struct(as_id(e["from_id"]).alias("from_id"), as_id(e["to_id"]).alias("to_id"))
    )
    return F.filter(pairs, lambda e: e["from_id"].isNotNull() & e["to_id"].isNotNull())


def with_plain_relations(df: DataFrame, relations_col: str, out: str) -> DataFrame:
    """Add the pairs of ids for texts of the plain shape, null for all others; JVM only.

    Steps are columns of their own, so that each is computed once.
    """
    staged = df.withColumn("_raw", _plain_text_ids(F.col(relations_col)))
    pairs = F.when(~_has_odd_number(F.col("_raw")), _as_pairs(F.col("_raw")))
    return staged.withColumn(out, pairs).drop("_raw")


def _literal_relations(texts: Column) -> Column:
    """Pairs in Python literals; an unreadable literal or an infinite id gives none.

    The helpers live inside, so that they travel with the task and workers need
    not have this package installed.
    """

    def id_pair(item: object) -> dict[str, int] | None:
        if not isinstance(item, dict):
            return None
        try:
            pair = {key: int(item[key]) for key in ("from_id", "to_id")}
        except (KeyError, TypeError, ValueError):
            return None
        return {key: v if -(2**63) <= v < 2**63 else stand_in(v) for key, v in pair.items()}

    def stand_in(value: int) -> int:
        # Ids are 64-bit here; a wider integer is named by a hash of its digits,
        # so that it counts and stays itself.
        return int.from_bytes(hashlib.blake2b(hex(value).encode(), digest_size=8).digest(), "big", signed=True)

    def pairs(text: str | None) -> list[dict[str, int]]:
        if text is None:
            return []
        try:
            value = ast.literal_eval(text)
            items = value if isinstance(value, list) else []
            return [pair for pair in map(id_pair, items) if pair is not None]
        except Exception:
            return []

    @F.pandas_udf(PAIRS)
    def read(batch: pd.Series) -> pd.Series:
        return batch.map(pairs)

    return read(texts)


def with_relations(df: DataFrame, relations_col: str, out: str) -> DataFrame:
    """Add the array of ``(from_id, to_id)`` in list order; never null.

    Rows of the plain shape send only a null to the Python helper.
    """
    text, plain = F.col(relations_col), F.col("_plain")
    blank = F.coalesce(F.trim(text) == "", F.lit(True))
    staged = with_plain_relations(df, relations_col, "_plain").withColumn(
        "_rest", F.when(plain.isNull() & ~blank, text)
    )
    found = F.coalesce(plain, _literal_relations(F.col("_rest")))
    empty = F.array().cast(PAIRS)
    return staged.withColumn(out, F.when(blank, empty).otherwise(found)).drop("_plain", "_rest")
