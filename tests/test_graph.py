import random

from pyspark.sql import functions as F

from lexvane.operators import graph as G

# edges, malware ids -> highest degree, total edges
CASES = [
    ([(1, 2), (2, 1), (1, 2)], [1], 1, 3),
    ([(1, 1), (1, 2)], [1], 3, 2),
    ([(1, 2), (1, 3)], [9], 0, 2),
    ([(1, 2), (1, 3)], [2, 1], 2, 2),
    ([], [1], 0, 0),
    ([(4, 4), (4, 4)], [4], 2, 2),
    ([(1, 2)], [], 0, 1),
]


def brute(edges, nodes):
    simple = {frozenset(e) for e in edges}
    degree = {}
    for e in simple:
        for node in e:
            degree[node] = degree.get(node, 0) + (2 if len(e) == 1 else 1)
    return max([degree.get(n, 0) for n in nodes], default=0), len(edges)


def both_forms(spark, cases):
    df = spark.createDataFrame(
        [(i, [{"from_id": a, "to_id": b} for a, b in e], n) for i, (e, n) in enumerate(cases)],
        "row_id int, rel array<struct<from_id:bigint,to_id:bigint>>, nodes array<bigint>",
    )
    rows = df.select(
        "row_id", G.max_degree(F.col("rel"), F.col("nodes")), G.total_edges(F.col("rel"))
    )
    edges = G.explode_relations(df, "row_id", F.col("rel"))
    labelled = df.select("row_id", F.explode("nodes").alias("node"))
    joined = G.graph_features_of_edges(df, edges, labelled, "row_id")
    return [{r[0]: (r[1], r[2]) for r in x.collect()} for x in (rows, joined)]


def test_cases(spark):
    for got in both_forms(spark, [c[:2] for c in CASES]):
        assert got == {i: (c[2], c[3]) for i, c in enumerate(CASES)}


def test_forms_agree_on_random_graphs(spark):
    rnd = random.Random(3)
    cases = []
    for _ in range(60):
        edges = [(rnd.randrange(6), rnd.randrange(6)) for _ in range(rnd.randrange(12))]
        cases.append((edges, sorted({rnd.randrange(7) for _ in range(3)})))
    rows, joined = both_forms(spark, cases)
    assert rows == joined == {i: brute(e, n) for i, (e, n) in enumerate(cases)}


def test_edge_direction_and_order_do_not_matter(spark):
    edges = [(1, 2), (3, 1), (1, 1), (2, 3)]
    turned = [(b, a) for a, b in reversed(edges)]
    rows, _ = both_forms(spark, [(edges, [1, 2]), (turned, [1, 2])])
    assert rows[0] == rows[1]


def test_labelled_nodes(spark):
    edges = spark.createDataFrame([(0, 1, 2), (0, 2, 3), (1, 5, 5)], "row_id int, from_id long, to_id long")
    labelled = spark.createDataFrame([(0, 3), (0, 9), (1, 3), (0, 3)], "row_id int, node long")
    assert {tuple(r) for r in G.labelled_nodes(edges, labelled, "row_id").collect()} == {(0, 3)}


def test_tasks_grow_with_the_edges(spark, monkeypatch):
    """What one task of the groupings holds used to grow with the table."""
    monkeypatch.setattr(G, "TASK_EDGES", 50, raising=False)
    edges = spark.range(2000).selectExpr("id div 20 as rec", "id % 7 as from_id", "id % 11 as to_id").repartition(2)
    got = G.node_degrees(edges, "rec")
    parts = got.select(F.spark_partition_id().alias("p"), "rec").groupBy("p").count().collect()
    assert len(parts) > 40 and max(r["count"] for r in parts) < 100
    links = {(r["rec"], *sorted((r["from_id"], r["to_id"]))) for r in edges.collect()}
    want = {}
    for rec, a, b in links:
        for node in (a, b):
            want[rec, node] = want.get((rec, node), 0) + 1
    assert {(r["rec"], r["node"]): r["degree"] for r in got.collect()} == want
