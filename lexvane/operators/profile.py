"""Column profiles: value shares, numeric summaries, class counts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Distinct values a single task may put in order.
ORDERED_VALUES = 1_000_000
CUTS = 64
QUARTILES = (0.25, 0.5, 0.75)

SUMMARY = "column string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double"


def frequencies(df: DataFrame, col: str) -> DataFrame:
    """``(value, n)`` of the values that are there; NaN is as missing as null."""
    there = F.col(col).isNotNull()
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)):
        there = there & ~F.isnan(col)
    return (
        df.filter(there)
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """``(value, n, share)`` of the non-null values, most frequent first."""
    counts = frequencies(df, col)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), "value")


def class_counts(df: DataFrame, col: str) -> DataFrame:
    """``(value, n, classes)``: size of every class and the number of classes."""
    counts = frequencies(df, col)
    return counts.withColumn("classes", counts.agg(F.count(F.lit(1))).scalar())


def _order_statistics(freq: DataFrame, ranks: set[int]) -> dict[int, float]:
    """Values at 0-based ranks of ``(value, n)``, exactly and in bounded tasks.

    While there are too many distinct values for one task, they are cut into
    ranges at approximate quantiles, the ranges are counted, and the search
    goes on inside the ranges that hold a rank. Repeats of a value are one row.
    """
    order = sorted(ranks)
    if freq.count() <= ORDERED_VALUES:
        upto = F.sum("n").over(Window.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
        found = freq.withColumn("upto", upto).agg(
            *(F.min(F.when(F.col("upto") > r, F.col("value"))) for r in order)
        )
        return dict(zip(order, found.first()))
    shares = F.array(*(F.lit(i / CUTS) for i in range(1, CUTS)))
    cuts = sorted(set(freq.agg(F.percentile_approx("value", shares, F.lit(10_000))).first()[0]))
    part: Column = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("value")))
    sizes = dict(freq.groupBy(part).agg(F.sum("n")).collect())  # at most CUTS rows
    found, before = {}, 0
    for i in range(len(cuts) + 1):
        size = sizes.get(i, 0)
        inside = {r - before for r in order if before <= r < before + size}
        if inside:
            low = F.col("value") > cuts[i - 1] if i else F.lit(True)
            high = F.col("value") <= cuts[i] if i < len(cuts) else F.lit(True)
            deeper = _order_statistics(freq.filter(low & high), inside)
            found.update({r + before: v for r, v in deeper.items()})
        before += size
    return found


def exact_quantiles(df: DataFrame, col: str, shares: tuple[float, ...], rows: int) -> list[float]:
    """Linearly interpolated quantiles of a double column with ``rows`` non-null values."""
    places = [(rows - 1) * p for p in shares]
    ranks = {math.floor(x) for x in places} | {math.ceil(x) for x in places}
    at = _order_statistics(frequencies(df, col), ranks)
    return [
        at[math.floor(x)] + (at[math.ceil(x)] - at[math.floor(x)]) * (x - math.floor(x))
        for x in places
    ]


def numeric_summary(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """One row per column: count, mean, sample deviation, min, quartiles, max.

    Missing values and NaN are left out. Quartiles are exact and interpolated;
    ``approx=True`` takes them from a sketch in the same pass instead. Only the
    summary values themselves reach the driver.
    """
    numbers = df.select(
        *(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols)
    )
    measures = []
    for c in cols:
        q = F.percentile_approx(c, F.array(*map(F.lit, QUARTILES)), F.lit(10_000))
        measures.append(
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
                (q if approx else F.lit(None).cast("array<double>")).alias("q"),
            ).alias(c)
        )
    first = numbers.agg(*measures).first()
    rows = []
    for c in cols:
        m = first[c]
        if m["count"] == 0:
            quartiles = [None] * len(QUARTILES)
        else:
            quartiles = m["q"] if approx else exact_quantiles(numbers, c, QUARTILES, m["count"])
        rows.append((c, m["count"], m["mean"], m["std"], m["min"], *quartiles, m["max"]))
    return df.sparkSession.createDataFrame(rows, T._parse_datatype_string(SUMMARY))


def share_map(df: DataFrame, col: str) -> dict[str, float]:
    """Value shares of a column of few classes (such as a flag) as a dict with text keys."""
    return {str(r["value"]): r["share"] for r in value_shares(df, col).collect()}
