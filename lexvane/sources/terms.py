"""Dictionaries kept as text, one term per line, or as numbered versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexvane.operators.dictionary import usable_terms
from lexvane.storage import written


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """Distinct stripped non-blank lines ``(term)``, taken as they are otherwise."""
    return usable_terms(spark.read.text(path).withColumnRenamed("value", "term"))


def write_terms(terms: DataFrame, path: str) -> bool:
    """Write the terms in code-point order; an empty dictionary is not written.

    The sorted ranges become files whose names follow the order; a small
    dictionary is one file.
    """
    if terms.isEmpty():
        return False
    terms.select("term").orderBy("term").write.mode("overwrite").text(path)
    return True


def load_or_build_terms(
    spark: SparkSession, path: str, build: Callable[[], DataFrame]
) -> tuple[DataFrame, bool]:
    """The stored dictionary if there is a non-empty one, else a built and stored one.

    One that cannot be read is built anew and written over. What is built is
    written down before it is counted, sorted and stored. The second value tells
    whether the dictionary was loaded.
    """
    try:
        stored = read_terms(spark, path)
        if not stored.isEmpty():
            return stored, True
    except PySparkException:
        pass
    built = written(build(), "dictionary")
    return (read_terms(spark, path) if write_terms(built, path) else built), False


def publish_terms(terms: DataFrame, folder: str) -> int:
    """Write the terms as the next version of a dictionary; its number, from 1.

    Readers see a version only after its number is listed, which is one small
    file written last. One publisher at a time; earlier versions stay.
    """
    spark = terms.sparkSession
    try:
        version = newest_version(spark, folder) + 1
    except PySparkException:  # nothing published yet
        version = 1
    usable_terms(terms).write.mode("overwrite").parquet(f"{folder}/terms-{version}")
    spark.range(version, version + 1, 1, 1).write.mode("append").parquet(f"{folder}/published")
    return version


def newest_version(spark: SparkSession, folder: str) -> int:
    """The number of the newest published version."""
    return spark.read.parquet(f"{folder}/published").agg(F.max("id")).first()[0]


def version_terms(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """The terms of one published version."""
    return spark.read.parquet(f"{folder}/terms-{version}")
