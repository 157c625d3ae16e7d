"""Reading report tables: wide CSV files and the older shape with nested entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexvane.storage import written

# Columns a report table must have.
REQUIRED_COLUMNS = ("text", "relations", "id_1", "label_1", "start_offset_1", "end_offset_1")

# The tokens data tools read as a missing value.
MISSING_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All columns as text, missing-value tokens as null.

    Only the header is looked at to plan the scan; there is no inference pass.
    ``multi_line`` is needed where quoted texts hold line breaks; files are then
    read whole by one task each, so give many files, or convert to Parquet once.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    return raw.select(
        *(F.when(~F.col(f"`{c}`").isin(*MISSING_TOKENS), F.col(f"`{c}`")).alias(c) for c in raw.columns)
    )


def check_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED_COLUMNS) -> DataFrame:
    """The table itself, or an error naming the columns it lacks."""
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise ValueError(
            f"missing columns: {', '.join(lacking)} (needed: {', '.join(required)})"
        )
    return df


def check_rows(df: DataFrame, at_least: int = 1) -> DataFrame:
    """The table itself, or an error if it has fewer rows; reads no more rows than needed."""
    if df.limit(at_least).count() < at_least:
        raise ValueError(f"fewer than {at_least} rows")
    return df


def load_reports(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Checked wide reports of a CSV path."""
    return check_rows(check_columns(read_csv(spark, path, multi_line)))


def with_row_id(df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """The table with a key column, made up only if there is none.

    Made-up numbers hold for one computation only, so the numbered table is
    written once to the shared folder and read from there by all later steps.
    """
    if id_col in df.columns:
        return df
    return written(df.withColumn(id_col, F.monotonically_increasing_id()), "reports")


NESTED = "array<struct<id:bigint,label:string,start_offset:bigint,end_offset:bigint>>"


def nested_mentions(
    df: DataFrame, id_col: str, entities_col: str = "entities", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Mentions ``(id_col, *keep, idx, id, label, start, end)`` of a JSON list of entities."""
    parsed = df.select(id_col, *keep, F.posexplode(F.from_json(F.col(entities_col), NESTED)))
    return parsed.select(
        id_col,
        *keep,
        (F.col("pos") + 1).alias("idx"),
        F.col("col.id").alias("id"),
        F.col("col.label").alias("label"),
        F.col("col.start_offset").alias("start"),
        F.col("col.end_offset").alias("end"),
    )
