"""Merkle manifest of a dataset: a tree of digests for each source, and one over the sources.

Nodes of a level are numbered inside their tree. A level is joined with itself
by shifts of 1, 2, 4, ... places: a node takes what the node so many places on
has gathered, by the computed index, and half of the nodes are left. So the rows
of slot zero gather their run, and each of them emits a parent. Each shift is
written down, so a level costs few joins and one of them at a time. Going down again, every node
gets its own siblings in front of the path of its parent. Paths are made for
runs, not for leaves; a leaf meets its run's path in the last step.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexvane.storage import written

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: every value with its size in bytes in front, ``-`` for null."""
    shown = [v.cast("string") for v in values]
    sized = [F.concat(F.octet_length(v).cast("string"), F.lit(":"), v) for v in shown]
    return digest(*(F.coalesce(s, F.lit("-")) for s in sized))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``idx`` (from 0) and ``n``, place and number of rows inside each ``tree``.

    Rows are dealt by ranges of (tree, order), counted in each range, and
    numbered inside it, so that a tree of any size is spread. Rows that are
    alike in all of these are spread too, as the place they were read from
    comes last; which of them has which number makes no difference.
    """
    keys = ["tree", *order]
    dealt = rows.withColumn("read", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*keys, "read").withColumn("range", F.spark_partition_id())
    dealt = written(dealt.drop("read"), "ranges")
    sizes = dealt.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("size"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("size").over(tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(
        F.col("tree").alias("of"), F.col("range").alias("at"), before.alias("before"), F.sum("size").over(tree).alias("n")
    )
    place = F.row_number().over(Window.partitionBy("tree", "range").orderBy(*order))
    placed = dealt.withColumn("place", place)
    joined = placed.join(sizes, (F.col("tree") == F.col("of")) & (F.col("range") == F.col("at")))
    return joined.withColumn("idx", F.col("before") + F.col("place") - 1).drop("of", "at", "range", "before", "place")


def _runs(nodes: DataFrame, arity: int) -> DataFrame:
    """``tree, idx, n, digests, digest``: the parents of nodes, with their runs from left to right."""
    runs, slot, step = nodes.select("tree", "idx", "n", F.array("digest").alias("digests")), F.col("idx") % arity, 1
    while step < arity:
        sibling = runs.filter(slot % (2 * step) == step).select(
            F.col("tree").alias("of"), (F.col("idx") - step).alias("at"), F.col("digests").alias("next")
        )
        runs = runs.filter(slot % (2 * step) == 0)
        runs = runs.join(sibling, (F.col("tree") == F.col("of")) & (F.col("idx") == F.col("at")), "left")
        both = F.concat("digests", F.coalesce("next", F.array().cast("array<string>")))
        runs, step = runs.select("tree", "idx", "n", both.alias("digests")), 2 * step
        if step < arity:
            runs = written(runs, "shifted")
    gathered = runs.select(
        "tree",
        F.expr(f"idx div {arity}").alias("idx"),
        F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
        "digests",
    )
    return gathered.withColumn("digest", F.sha2(F.concat_ws("", "digests"), 256))


@dataclass(frozen=True)
class Forest:
    """Runs of every level above the leaves, and the top of every tree ``(tree, height, digest)``."""

    runs: list[DataFrame]
    tops: DataFrame
    arity: int


def grow(leaves: DataFrame, arity: int = ARITY) -> Forest:
    """All trees over ``leaves(tree, idx, n, digest)`` at once, level by level.

    A tree is done when one node is left. Every level is written down; there
    are as many as the largest tree needs.
    """
    nodes = leaves.select("tree", "idx", "n", "digest")
    runs, tops = [], []
    while True:
        tops.append(nodes.filter("n = 1").select("tree", F.lit(len(runs)).alias("height"), "digest"))
        open_ = nodes.filter("n > 1")
        if open_.isEmpty():
            return Forest(runs, reduce(DataFrame.unionByName, tops), arity)
        runs.append(written(_runs(open_, arity), f"level-{len(runs) + 1}"))
        nodes = runs[-1].select("tree", "idx", "n", "digest")


def _with_path(rows: DataFrame, slot: Column) -> DataFrame:
    """Put the siblings of a slot of the run ``digests`` in front of ``path``."""
    before = F.concat_ws("", F.slice("digests", F.lit(1), slot))
    after = F.concat_ws("", F.slice("digests", slot + 2, F.size("digests")))
    step = F.array(F.struct(before.alias("before"), after.alias("after")))
    return rows.withColumn("path", F.concat(step, F.col("path")))


def paths(forest: Forest, leaves: DataFrame, tops: DataFrame) -> DataFrame:
    """``leaves`` with ``path`` (siblings to the left and right, level by level) and ``tops``' columns.

    ``tops(tree, height, path, ...)`` says how each tree goes on above its top.
    """
    arity, carried = forest.arity, [c for c in tops.columns if c not in ("tree", "height")]

    def tops_at(height: int) -> DataFrame:
        return tops.filter(F.col("height") == height).select(F.col("tree").alias("of"), F.lit(0).cast("long").alias("at"), *carried)

    above = tops_at(len(forest.runs))
    same = (F.col("tree") == F.col("of")) & (F.col("idx") == F.col("at"))
    for level in range(len(forest.runs), 1, -1):
        run = forest.runs[level - 1].join(above, same).select("tree", "idx", "digests", *carried)
        nodes = run.select("*", F.posexplode("digests").alias("slot", "digest"))
        nodes = _with_path(nodes, F.col("slot"))
        nodes = nodes.select(F.col("tree").alias("of"), (F.col("idx") * arity + F.col("slot")).alias("at"), *carried)
        above = written(nodes.unionByName(tops_at(level - 1)), f"paths-{level - 1}")
    if not forest.runs:
        return leaves.join(above, same).drop("of", "at")
    run = forest.runs[0].join(above, same).select(F.col("tree").alias("of"), F.col("idx").alias("at"), "digests", *carried)
    parent = (F.col("tree") == F.col("of")) & (F.expr(f"idx div {arity}") == F.col("at"))
    several = leaves.filter("n > 1").join(run, parent)
    several = _with_path(several, (F.col("idx") % arity).cast("int")).drop("of", "at", "digests")
    single = leaves.filter("n = 1").join(tops_at(0), same).drop("of", "at")
    return several.unionByName(single)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest leads to along its path."""
    return F.aggregate(path, leaf, lambda d, step: digest(step["before"], d, step["after"]))


def siblings(path: Column) -> Column:
    """All digests of a path as one text, from the leaf's siblings up, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def manifest(docs: DataFrame, keep: dict[str, Column] | None = None, arity: int = ARITY) -> DataFrame:
    """``doc_id, leaf, path, subroot, root`` of every row, and ``keep``, columns made of the row.

    A leaf is the digest of the row's FIELDS. The leaves of a source in order of
    ``doc_id`` (null first; equal ids by digest) form its tree; the tops of all
    sources (null first, then by UTF-8 bytes) form the tree of the dataset. A
    null field is marked and differs from an empty one; a null source is a
    source of its own; rows that repeat are leaves of their own; an empty table
    gives no rows; columns beyond FIELDS are left out unless kept. Texts are
    read once and only digests are shuffled.
    """
    kept = keep or {}
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    rows = docs.select(
        tree.alias("tree"), "doc_id", leaf_digest(*map(F.col, FIELDS)).alias("digest"), *(c.alias(f"_{k}") for k, c in kept.items())
    )
    leaves = written(numbered(rows, ["doc_id", "digest"]), "leaves")
    sources = grow(leaves, arity)
    subroots = sources.tops.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "height", "digest")
    subroots = written(numbered(subroots, ["source"]), "subroots")
    whole = grow(subroots, arity)
    start = whole.tops.select("tree", "height", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    tops = paths(whole, subroots.withColumnRenamed("height", "own"), start)
    tops = tops.select(
        F.col("source").alias("tree"), F.col("own").alias("height"), "path", F.col("digest").alias("subroot"), "root"
    )
    proved = paths(sources, leaves, written(tops, "tops"))
    return proved.select("doc_id", F.col("digest").alias("leaf"), "path", "subroot", "root", *(F.col(f"_{k}").alias(k) for k in kept))


def verify(docs: DataFrame, changed: dict[str, Column] | None = None, arity: int = ARITY) -> DataFrame:
    """Fold every row's path again, with some fields ``changed``, and compare with the root.

    Gives ``doc_id, leaf, subroot, root, proof, folded_root, verified``; ``proof``
    is the text of all siblings. A null in a changed field stays a field's null.
    """
    new = [(changed or {}).get(f, F.col(f)) for f in FIELDS]
    found = manifest(docs, {"claim": leaf_digest(*new)}, arity)
    return found.select(
        "doc_id", "leaf", "subroot", "root", siblings(F.col("path")).alias("proof"), fold(F.col("claim"), F.col("path")).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
