"""Writing the nested result of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _column(value: object):
    if isinstance(value, dict):
        return F.struct(*(_column(v).alias(str(k)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return F.array(*map(_column, value))
    if value is None or isinstance(value, (bool, int, float, str)):
        return F.lit(value)
    return F.lit(str(value))


def result_frame(spark: SparkSession, result: dict) -> DataFrame:
    """One row of nested structs; keys become text, other values are written as text."""
    return spark.range(1).select(*(_column(v).alias(str(k)) for k, v in result.items()))


def write_result(spark: SparkSession, result: dict, path: str) -> None:
    """Write the result as one JSON document."""
    result_frame(spark, result).coalesce(1).write.mode("overwrite").option(
        "ignoreNullFields", False
    ).json(path)
