"""Exact train/test split, optionally stratified.

Rows are ordered by a seeded hash inside each class and a fixed number of them
goes to the test set. To find the last of them without ordering a whole class
in one task, hashes are counted in buckets first, and only the one bucket per
class that the cut falls into is ordered row by row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 16


def hash_order(id_col: str, seed: int) -> Column:
    """Seeded non-negative 63-bit position of a row."""
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 1)


def test_sizes(counts: dict, test_size: float) -> dict:
    """Test rows per class: the total is rounded up, classes by largest remainder."""
    rows = sum(counts.values())
    # The share is rounded first: 0.2 * 15 is a little more than 3 in binary.
    wanted = math.ceil(round(rows * test_size, 9))
    exact = {k: wanted * n / rows for k, n in counts.items()}
    sizes = {k: math.floor(x) for k, x in exact.items()}
    order = sorted(counts, key=lambda k: (sizes[k] - exact[k], str(k)))
    for k in order[: wanted - sum(sizes.values())]:
        sizes[k] += 1
    return sizes


def can_stratify(counts: dict, test_size: float) -> bool:
    """More than one class, none with a single row, and room for all on both sides."""
    rows = sum(counts.values())
    wanted = math.ceil(round(rows * test_size, 9))
    return (
        len(counts) > 1
        and min(counts.values()) > 1
        and wanted >= len(counts)
        and rows - wanted >= len(counts)
    )


def stratified_split(
    df: DataFrame,
    id_col: str,
    strata_col: str | None,
    test_size: float = 0.2,
    seed: int = 42,
    order: Column | None = None,
    order_bits: int = 63,
) -> DataFrame:
    """Add ``is_test`` (boolean).

    ``id_col`` has to be a key. ``order`` replaces the seeded hash; it has to be
    a non-negative bigint below ``2 ** order_bits``, spread evenly. Without
    ``strata_col``, or where the classes do not allow stratifying, the split
    ignores classes.
    """
    counts: dict = {}
    if strata_col is not None:
        seen = df.groupBy(strata_col).agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {r[0]: r["n"] for r in seen}  # one row per class
    if not counts or not can_stratify(counts, test_size):
        strata_col = None
        counts = {0: sum(counts.values()) or df.count()}
    sizes = test_sizes(counts, test_size) if sum(counts.values()) else {}

    stratum = F.lit(0) if strata_col is None else F.col(strata_col)
    h = hash_order(id_col, seed) if order is None else order
    placed = df.select(F.col(id_col).alias("_id"), stratum.alias("_s"), h.alias("_h")).withColumn(
        "_b", F.shiftright("_h", max(0, order_bits - BUCKET_BITS))
    )

    def by_class(values: dict, default: Column) -> Column:
        chosen = default
        for value, then in values.items():
            chosen = F.when(F.col("_s").eqNullSafe(F.lit(value)), then).otherwise(chosen)
        return chosen

    # Per class: the bucket the cut falls into and how many of its rows to take.
    histogram = placed.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        histogram.withColumn("upto", F.sum("n").over(running))
        .withColumn("wanted", by_class({k: F.lit(n) for k, n in sizes.items()}, F.lit(0)))
        .filter((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted")))
        .select("_s", "_b", (F.col("wanted") - F.col("upto") + F.col("n")).alias("take"))
        .collect()
    )  # at most one row per class
    edge = placed.filter(F.col("_b") == by_class({c["_s"]: F.lit(c["_b"]) for c in cuts}, F.lit(None)))
    place = F.row_number().over(Window.partitionBy("_s").orderBy("_h", "_id"))
    last = (
        edge.withColumn("r", place)
        .filter(F.col("r") == by_class({c["_s"]: F.lit(c["take"]) for c in cuts}, F.lit(None)))
        .select("_s", "_h", "_id")
        .collect()
    )  # the last test row of every class

    # Everything up to that row is in the test set: a projection, no join.
    is_test = F.lit(False)
    for row in last:
        here = stratum.eqNullSafe(F.lit(row["_s"]))
        up_to = (h < row["_h"]) | ((h == row["_h"]) & (F.col(id_col) <= F.lit(row["_id"])))
        is_test = is_test | (here & up_to)
    return df.withColumn("is_test", is_test)
