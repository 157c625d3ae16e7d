"""Connected components of large graphs, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexvane.storage import written


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` to ``(node, component)``: the smallest node reachable.

    Alternates two steps: every node hands its smallest neighbour to its larger
    neighbours, then to its smaller ones, until all hang on the smallest node.
    The number of rounds grows with the logarithm of the longest path. Each
    round is written down, so a lost executor repeats one round only. Smallest
    neighbours are merged before the shuffle; a node with very many links is
    never gathered.
    """
    edges = written(
        links.filter("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    while not _stars(edges):
        edges = written(_handed(written(_handed(edges, both=True), "large-star"), both=False), "small-star")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one link down, and no end of a link has one."""
    downs = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("end"))
    ends = edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("end"))
    roles = downs.unionByName(ends).groupBy("node").agg(F.sum("down").alias("down"), F.max("end").alias("end"))
    return roles.filter((F.col("down") > 1) | ((F.col("down") == 1) & (F.col("end") == 1))).isEmpty()


def _handed(edges: DataFrame, both: bool) -> DataFrame:
    """Large star (``both``): neighbours above a node link to its smallest neighbour.

    Small star: the neighbours below a node, and the node, link to the smallest.
    """
    down = edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
    near = down.unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y"))) if both else down
    least = near.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
    named = near.join(least.withColumnRenamed("x", "x2"), F.col("x") == F.col("x2"))
    if both:
        handed = named.filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
    else:
        # The node's own link to the smallest comes along with its first neighbour.
        ends = F.array_distinct(F.array("x", "y"))
        handed = named.select(F.explode(ends).alias("u"), F.col("m").alias("v"))
    return handed.filter("u != v").distinct()
