"""Features of the small undirected graph each report's relations span.

Two forms with the same answers: column expressions over the relation array of
a row (no shuffle; for reports whose relations fit one row), and joins and
groupings over an edges table (for graphs of any size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Edges that one task groups.
TASK_EDGES = 1_000_000


def total_edges(relations: Column) -> Column:
    """Number of relations; repeats, reversals and self-loops all count."""
    return F.coalesce(F.size(relations), F.lit(0))


def _degree(relations: Column, node: Column) -> Column:
    """Distinct neighbours of a node; a self-loop counts twice."""
    touching = F.filter(relations, lambda e: (e["from_id"] == node) | (e["to_id"] == node))
    others = F.array_distinct(
        F.transform(touching, lambda e: F.when(e["from_id"] == node, e["to_id"]).otherwise(e["from_id"]))
    )
    return F.size(others) + F.array_contains(others, node).cast("int")


def max_degree(relations: Column, nodes: Column) -> Column:
    """Highest degree among ``nodes``; a node without relations has degree 0."""
    degrees = F.transform(nodes, lambda n: _degree(relations, n))
    return F.coalesce(F.array_max(degrees), F.lit(0))


def explode_relations(df: DataFrame, id_col: str, relations: Column) -> DataFrame:
    """Edges table ``(id_col, pos, from_id, to_id)`` in list order, repeats kept.

    Empty lists are dropped after the explosion: testing for them before it
    would parse every list twice.
    """
    rows = df.select(id_col, F.posexplode_outer(relations).alias("pos", "_e"))
    return rows.filter(F.col("pos").isNotNull()).select(
        id_col, "pos", F.col("_e.from_id").alias("from_id"), F.col("_e.to_id").alias("to_id")
    )


def edge_counts(edges: DataFrame, id_col: str) -> DataFrame:
    """``(id_col, graph_total_edges)`` of every record that has an edge."""
    return edges.groupBy(id_col).agg(F.count(F.lit(1)).cast("int").alias("graph_total_edges"))


def _tasks(edges: DataFrame) -> int:
    return max(edges.count() // TASK_EDGES + 1, edges.sparkSession.sparkContext.defaultParallelism)


def node_degrees(edges: DataFrame, id_col: str, tasks: int | None = None) -> DataFrame:
    """``(id_col, node, degree)`` of the simple undirected graph of every record.

    Repeats and reversals collapse in the first grouping, which spreads a large
    record over all its edges. Hardly any rows of a table without repeats
    collapse before they are dealt, so rows are dealt first, to as many tasks as
    the number of edges (or ``tasks``) asks for: what a task holds does not grow
    with the table. The result is in twice as many parts by record and node.
    """
    tasks = tasks or _tasks(edges)
    simple = edges.select(
        id_col,
        F.least("from_id", "to_id").alias("_a"),
        F.greatest("from_id", "to_id").alias("_b"),
    )
    simple = simple.repartition(tasks, id_col, "_a", "_b").distinct()
    ends = simple.select(id_col, F.explode(F.array("_a", "_b")).alias("node"))
    ends = ends.repartition(2 * tasks, id_col, "node")
    return ends.groupBy(id_col, "node").agg(F.count(F.lit(1)).cast("int").alias("degree"))


def labelled_nodes(edges: DataFrame, labelled: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``labelled(id_col, node)`` that are nodes of their record's graph."""
    ends = edges.select(id_col, F.explode(F.array("from_id", "to_id")).alias("node"))
    return labelled.select(id_col, "node").distinct().join(ends.distinct(), [id_col, "node"], "left_semi")


def graph_features_of_edges(
    records: DataFrame, edges: DataFrame, labelled: DataFrame, id_col: str
) -> DataFrame:
    """``(id_col, graph_max_malware_degree, graph_total_edges)`` for every record.

    ``labelled(id_col, node)`` holds the malware nodes. Every join is on a key
    that is unique on both sides, so no group of rows multiplies. Malware nodes
    are dealt like the degrees, which then stay where they are.
    """
    tasks = _tasks(edges)
    wanted = labelled.select(id_col, "node").repartition(2 * tasks, id_col, "node").distinct()
    top = (
        node_degrees(edges, id_col, tasks)
        .join(wanted, [id_col, "node"])
        .groupBy(id_col)
        .agg(F.max("degree").alias("graph_max_malware_degree"))
    )
    return (
        records.select(id_col)
        .join(edge_counts(edges, id_col), id_col, "left")
        .join(top, id_col, "left")
        .select(
            id_col,
            F.coalesce("graph_max_malware_degree", F.lit(0)).alias("graph_max_malware_degree"),
            F.coalesce("graph_total_edges", F.lit(0)).alias("graph_total_edges"),
        )
    )
