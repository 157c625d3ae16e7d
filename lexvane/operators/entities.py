"""Labelled entities of a report row.

Reports arrive wide: ``id_1, label_1, start_offset_1, end_offset_1, id_2, ...``.
Row-local work uses the groups as one array column; span work uses them as
rows of a mentions table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexvane.functions.text import (
    fill_text,
    is_malware_label,
    span,
    span_is_valid,
    strip,
    whole_number,
)

_GROUP_FIELDS = {"id": "id", "label": "label", "start": "start_offset", "end": "end_offset"}


def group_width(columns: list[str]) -> int:
    """Highest group number among columns starting with ``label_<number>``."""
    numbers = [re.match(r"label_(\d+)", name) for name in columns]
    width = max((int(m.group(1)) for m in numbers if m), default=0)
    if width == 0:
        raise ValueError("no label_<number> column: cannot tell how many entity groups there are")
    return width


def _as_bigint(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(f"`{name}`").cast("bigint")
    if isinstance(kind, (T.FractionalType,)):
        return F.col(f"`{name}`").try_cast("bigint")
    return whole_number(F.col(f"`{name}`"))


def entity_array(df: DataFrame, need: tuple[str, ...] = ("label",)) -> Column:
    """Groups of one row as ``array<struct<idx,id,label,start,end>>``.

    ``need`` names the fields a group must have as columns to be taken; other
    missing columns are null. Only column names are looked at, not data.
    """
    have = set(df.columns)
    groups = []
    for i in range(1, group_width(df.columns) + 1):
        names = {field: f"{stem}_{i}" for field, stem in _GROUP_FIELDS.items()}
        if not all(names[field] in have for field in need):
            continue
        fields = [F.lit(i).alias("idx")]
        for field, name in names.items():
            if name not in have:
                kind = "string" if field == "label" else "bigint"
                fields.append(F.lit(None).cast(kind).alias(field))
            elif field == "label":
                fields.append(F.col(f"`{name}`").cast("string").alias(field))
            else:
                fields.append(_as_bigint(df, name).alias(field))
        groups.append(F.struct(*fields))
    kind = "array<struct<idx:int,id:bigint,label:string,start:bigint,end:bigint>>"
    return F.array(*groups).cast(kind)


def unpivot_entities(
    df: DataFrame, id_col: str, need: tuple[str, ...] = ("label",), keep: tuple[str, ...] = ()
) -> DataFrame:
    """Wide groups to rows ``(id_col, *keep, idx, id, label, start, end)``; no shuffle."""
    packed = df.select(id_col, *keep, entity_array(df, need).alias("_entities"))
    # The array is never empty; the outer form spares a test that would build it twice.
    return packed.select(id_col, *keep, F.inline_outer("_entities"))


def malware_ids(entities: Column) -> Column:
    """Ids of the malware-labelled entities of a row, without missing ids."""
    chosen = F.filter(entities, lambda e: is_malware_label(e["label"]) & e["id"].isNotNull())
    return F.array_distinct(F.transform(chosen, lambda e: e["id"]))


def any_malware(labels: Column) -> Column:
    """1 if any label of the array is malware, else 0 (also for missing labels)."""
    return F.coalesce(F.exists(labels, is_malware_label).cast("int"), F.lit(0))


def derive_label(df: DataFrame, name: str = "true_label") -> DataFrame:
    """Add the 0/1 target taken from all label columns of a wide row."""
    width = group_width(df.columns)
    labels = [f"label_{i}" for i in range(1, width + 1) if f"label_{i}" in df.columns]
    return df.withColumn(name, any_malware(F.array(*(F.col(c).cast("string") for c in labels))))


def label_map(label: Column) -> Column:
    """0/1 for one label."""
    return is_malware_label(label).cast("int")


def malware_spans(mentions: DataFrame, text_col: str = "text") -> DataFrame:
    """Malware mentions with ``valid`` and the stripped ``name`` (null if invalid)."""
    text = fill_text(F.col(text_col))
    valid = span_is_valid(text, F.col("start"), F.col("end"))
    return (
        mentions.filter(is_malware_label(F.col("label")))
        .withColumn("valid", valid)
        .withColumn("name", F.when(F.col("valid"), strip(span(text, F.col("start"), F.col("end")))))
    )


def span_quality(reports: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """One row of extraction counters.

    Counts rows, malware mentions, invalid spans and distinct names. The
    per-row counters need no shuffle of rows; only distinct names are shuffled,
    after a partial aggregation.
    """
    text = fill_text(F.col(text_col))
    packed = reports.select(
        text.alias("_text"), entity_array(reports, ("label", "start", "end")).alias("_e")
    )
    chosen = packed.select(
        "_text", F.filter("_e", lambda e: is_malware_label(e["label"])).alias("_e")
    ).select(
        F.size("_e").cast("bigint").alias("n"),
        F.size(F.filter("_e", lambda e: ~span_is_valid(F.col("_text"), e["start"], e["end"])))
        .cast("bigint")
        .alias("bad"),
    )
    counts = chosen.agg(
        F.count(F.lit(1)).alias("rows_processed"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("malware_mentions"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_spans"),
    )
    mentions = unpivot_entities(reports, id_col, ("label", "start", "end"), (text_col,))
    names = malware_spans(mentions, text_col).filter(F.col("name") != "").select("name").distinct()
    return counts.withColumn("distinct_names", names.agg(F.count(F.lit(1))).scalar())
