"""The given tables, and report-shaped tables that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexvane.functions.text import clean_text
from lexvane.storage import spread

# Document numbers that are sent to all tasks at most.
SENT_IDS = 2_000_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The table as a stream of its files; it may be one file or a folder of files.

    The path is a pattern that fits the table alone, since a stream takes a
    plain path for a folder.
    """
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/[{name[0]}]{name[1:]}.parquet")


def documents(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """Documents, spread over the cores where the file is a single piece."""
    return spread(table(spark, sf, "documents").select(*(cols or ("doc_id", "text"))))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", clean_text(F.col("text")).alias("clean"))


def benchmark_terms(spark: SparkSession, sf: str, words: int = 4) -> DataFrame:
    """Every run of ``words`` words of the cleaned benchmark passages."""
    split = table(spark, sf, "benchmark").select(F.split(clean_text(F.col("text")), " ").alias("w"))
    starts = F.sequence(F.lit(1), F.size("w") - (words - 1))
    long_enough = split.filter(F.size("w") >= words)
    runs = F.transform(starts, lambda i: F.concat_ws(" ", F.slice("w", i, words)))
    return long_enough.select(F.explode(runs).alias("term")).distinct()


def benchmark_words(spark: SparkSession, sf: str, at_least: int = 4) -> DataFrame:
    """Distinct words, long enough for a dictionary, of the cleaned benchmark passages."""
    words = table(spark, sf, "benchmark").select(
        F.explode(F.split(clean_text(F.col("text")), " ")).alias("term")
    )
    return words.filter(F.length("term") >= at_least).distinct()


def gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """``(name, type)``: nations, regions, first words of passages, and roles."""
    parts = [
        table(spark, sf, "nation").select(F.col("n_name").alias("name"), F.lit("GPE").alias("type")),
        table(spark, sf, "region").select(F.col("r_name").alias("name"), F.lit("GPE").alias("type")),
        table(spark, sf, "benchmark").select(
            F.get(F.split("text", " "), F.lit(0)).alias("name"), F.lit("PRODUCT").alias("type")
        ),
        table(spark, sf, "conversations").select(
            F.col("role").alias("name"), F.lit("ROLE").alias("type")
        ),
    ]
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.union(part)
    return everything.distinct()


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as wide reports with three entity groups.

    Offsets follow the first blank of the text, so some spans are invalid; the
    third group's offsets are numbers written as decimals.
    """
    docs = documents(spark, sf, "doc_id", "text", "lang", "source")
    blank = F.locate(" ", F.col("text")).cast("bigint")
    size = F.length("text").cast("bigint")
    first = F.when(blank > 6, "Malware").otherwise("TOOL")
    second = F.when(F.col("lang") == "es", "MALWARE").when(F.col("lang") == "fr", "malware").otherwise("TOOL")

    def decimal(value):
        return value.cast("double").cast("string")

    return docs.select(
        "doc_id",
        "text",
        F.col("doc_id").alias("id_1"),
        first.alias("label_1"),
        F.lit(0).cast("bigint").alias("start_offset_1"),
        (blank - 1).alias("end_offset_1"),
        blank.alias("id_2"),
        second.alias("label_2"),
        blank.alias("start_offset_2"),
        (blank + 8).alias("end_offset_2"),
        size.alias("id_3"),
        F.when(F.col("source") == "src7", "malware").alias("label_3"),
        decimal(size - 6).alias("start_offset_3"),
        decimal(size - 6 + blank).alias("end_offset_3"),
    )


def alias_answers(spark: SparkSession, sf: str) -> DataFrame:
    """``(name, content)``: conversation turns filed under their first word."""
    return table(spark, sf, "conversations").select(
        F.get(F.split("text", " "), F.lit(0)).alias("name"), F.col("text").alias("content")
    )


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """One order is one record; each of its lines relates a part to a supplier."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("from_id"), F.col("l_suppkey").alias("to_id")
    )


def labelled_parts(spark: SparkSession, sf: str) -> DataFrame:
    """``(l_orderkey, node)``: parts of one brand in the orders they occur in."""
    parts = table(spark, sf, "part").filter(F.col("p_brand") == "Brand#13").select("p_partkey")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", F.col("l_partkey").alias("node")
    )


def relation_texts(spark: SparkSession, sf: str, asked: DataFrame | None = None) -> DataFrame:
    """``(l_orderkey, relations)``: the lines of an order as a literal list.

    Lines numbered 7 are written with a decimal part, and orders of a single
    line with a trailing comma, as some exports do. With ``asked(asked_key)``
    only the orders of these numbers are listed.
    """
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    if asked is not None:
        lines = lines.join(asked, F.col("l_orderkey") == F.col("asked_key"), "left_semi")
    listed = lines.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("e")
    )
    items = F.transform(
        "e",
        lambda e: F.concat(
            F.lit("{'from_id': "),
            e["l_partkey"].cast("string"),
            F.when(e["l_linenumber"] == 7, ".5").otherwise(""),
            F.lit(", 'to_id': "),
            e["l_suppkey"].cast("string"),
            F.lit("}"),
        ),
    )
    return listed.select(
        "l_orderkey",
        F.concat(
            F.lit("["), F.array_join(items, ", "), F.when(F.size("e") == 1, ",]").otherwise("]")
        ).alias("relations"),
    )


def wide_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as wide rows, an entity group for each line; as wide as the longest order."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    label = F.when(F.col("p_brand") == "Brand#13", "Malware").otherwise(F.col("p_type"))
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    joined = lines.withColumn("place", place).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    width = lines.groupBy("l_orderkey").count().agg(F.max("count")).first()[0] or 1
    groups = []
    for i in range(1, width + 1):
        here = F.col("place") == i
        groups.append(F.min(F.when(here, F.col("l_partkey"))).alias(f"id_{i}"))
        groups.append(F.min(F.when(here, label)).alias(f"label_{i}"))
    return joined.groupBy("l_orderkey").agg(*groups)


def full_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Wide document reports with the relations of the order of the same number.

    Lines of orders that no document asks for are left out before they are listed.
    """
    ids = table(spark, sf, "documents").select(F.col("doc_id").alias("asked_key"))
    relations = relation_texts(spark, sf, F.broadcast(ids) if ids.count() <= SENT_IDS else ids)
    wide = reports(spark, sf)
    joined = wide.join(relations, F.col("doc_id") == F.col("l_orderkey"), "left").drop("l_orderkey")
    return joined.withColumn(
        "id_1", F.coalesce(F.regexp_extract("relations", r"(\d+)", 1).try_cast("bigint"), F.col("id_1"))
    )
