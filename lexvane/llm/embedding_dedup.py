"""Embedding near-dedup with cross-polytope hashing.

A vector is turned by random signs and fast Hadamard transforms; the axis it
then lies nearest to, with its sign, is one hash. A few such hashes make the
bucket of a table. A vector is filed in one bucket of each table and asks for
partners in that bucket and in the next likely ones (multiprobe). Pairs found
are checked by their cosine in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexvane.llm.components import components
from lexvane.storage import written

LEAST, TABLES, PROBES = 0.93, 12, 4


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row (a power of two of columns)."""
    x, rows, size, half = x.copy(), len(x), x.shape[1], 1
    while half < size:
        y = x.reshape(rows, size // (2 * half), 2, half)
        left, right = y[:, :, 0, :] + y[:, :, 1, :], y[:, :, 0, :] - y[:, :, 1, :]
        x = np.stack([left, right], axis=2).reshape(rows, size)
        half *= 2
    return x / math.sqrt(size)


def axes(x: np.ndarray, seed: int, best: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """The nearest signed axes after a rotation, and how much nearer the first is."""
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    size = np.abs(x)
    order = np.argsort(-size, axis=1, kind="stable")[:, :best]
    far = np.take_along_axis(size, order, axis=1)
    value = np.take_along_axis(x, order, axis=1)
    return order * 2 + (value < 0), far[:, :1] - far


def buckets(x: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """Bucket numbers of a table: first the own one, then the likeliest others.

    Every combination of a nearest or second axis for each hash is a bucket;
    those that lose least come first.
    """
    codes, losses = zip(*(axes(x, 1000 * table + j) for j in range(hashes)))
    size = 2 * x.shape[1]
    number, loss = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for code, lost in zip(codes, losses):
        number = (number[:, :, None] * size + code[:, None, :]).reshape(len(x), -1)
        loss = (loss[:, :, None] + lost[:, None, :] ** 2).reshape(len(x), -1)
    order = np.argsort(loss, axis=1, kind="stable")[:, : 1 + probes]
    return np.take_along_axis(number, order, axis=1)


def _usable() -> Column:
    """Vectors that can link: labelled, of finite components, not all zero."""
    good = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.coalesce(good, F.lit(False))
        & F.exists("embedding", lambda v: v != 0)
    )


def _matrix(column: pa.ListArray, rows: np.ndarray, dim: int) -> np.ndarray:
    """The vectors of these rows, all of length ``dim``, in double precision."""
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(rows), dim)


def _filed(vectors: DataFrame, tables: int, hashes: int, probes: int) -> DataFrame:
    """``node, label, dim, table, bucket, own``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            dims = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = _matrix(column, rows, dim)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                x = np.pad(x, ((0, 0), (0, (1 << int(dim - 1).bit_length()) - dim)))
                ids, labels = batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))
                for table in range(tables):
                    found = buckets(x, table, hashes, probes)
                    width = found.shape[1]
                    again = pa.array(np.repeat(np.arange(len(rows)), width))
                    n = len(again)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(again),
                            labels.take(again),
                            pa.array(np.full(n, dim, np.int32)),
                            pa.array(np.full(n, table, np.int32)),
                            pa.array(found.ravel()),
                            pa.array(np.tile(np.arange(width) == 0, len(rows))),
                        ],
                        ["node", "label", "dim", "table", "bucket", "own"],
                    )

    label = vectors.schema["label"].dataType.simpleString()
    schema = f"node long, label {label}, dim int, table int, bucket long, own boolean"
    return vectors.select("node", "label", "embedding").mapInArrow(run, schema)


def _checked(pairs: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    left = vectors.select(F.col("node").alias("a2"), F.col("embedding").alias("va"))
    right = vectors.select(F.col("node").alias("b2"), F.col("embedding").alias("vb"))
    both = pairs.join(left, F.col("a") == F.col("a2")).join(right, F.col("b") == F.col("b2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            x, y = batch.column(2), batch.column(3)
            dims = pc.list_value_length(x).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                p, q = _matrix(x, rows, dim), _matrix(y, rows, dim)
                p, q = p / np.abs(p).max(axis=1, keepdims=True), q / np.abs(q).max(axis=1, keepdims=True)
                norms = np.linalg.norm(p, axis=1) * np.linalg.norm(q, axis=1)
                keep[rows] = (p * q).sum(axis=1) / norms >= least
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def near_duplicates(
    rows: DataFrame, least: float = LEAST, tables: int = TABLES, probes: int = PROBES, hashes: int | None = None
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Vectors of the same label (not null) and length link at a cosine of
    ``least`` or more. ``n_links`` counts the other rows linked directly;
    ``component_id`` is the smallest ``vec_id`` reachable. Vectors that are
    null, empty, zero, hold a null or a component that is not finite, and rows
    without ``vec_id`` or label, link with nothing and are kept. Equal vectors
    of a label are one row in all comparisons and counted as many times as
    they occur; rows sharing a ``vec_id`` are one node of the components.
    Further columns are left out; an empty table stays empty.

    ``hashes`` a bucket follow the number of different vectors (about as many
    buckets as vectors), and the tables grow with them, so that the share of
    links found stays: over 0.99 of the given tables' links, by brute force.
    """
    text = F.to_json(F.struct("label", "embedding"))
    named = rows.select("vec_id", "label", "embedding").filter(_usable())
    named = named.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding", F.xxhash64(text, F.md5(text)).alias("node"))
    vectors = written(
        named.groupBy("node", "label").agg(
            F.first("embedding").alias("embedding"), F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("times")
        ),
        "vectors",
    )
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("embedding")), F.lit(2)).alias("d")).first()
    if hashes is None:
        hashes = max(2, int(math.log(max(size["n"], 2)) / math.log(2 * size["d"])))
    tables = math.ceil(tables * 1.7 ** max(0, hashes - 2))
    filed = written(_filed(vectors, tables, hashes, probes), "filed")
    keys = ["label", "dim", "table", "bucket"]
    own = filed.filter("own").select(*keys, F.col("node").alias("other"))
    met = filed.join(own, keys).filter("node != other")
    pairs = met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    links = written(_checked(pairs, vectors, least), "links")

    reps = vectors.select("node", "rep", "times")
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ends = ends.join(reps.withColumnRenamed("node", "n2"), F.col("b") == F.col("n2"))
    ends = written(ends.select(F.col("a").alias("node"), F.col("rep").alias("other_rep"), "times"), "ends")
    counts = ends.groupBy("node").agg(F.sum("times").alias("others"))
    by_rep = ends.join(reps.select(F.col("node").alias("n2"), "rep"), F.col("node") == F.col("n2"))
    # Copies hang on the first of their ids.
    to_rep = named.select("node", "vec_id").join(reps.filter("times > 1").select(F.col("node").alias("n2"), "rep"), F.col("node") == F.col("n2"))
    edges = by_rep.select(F.col("rep").alias("a"), F.col("other_rep").alias("b")).unionByName(
        to_rep.select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    )
    classes = components(edges)
    per_node = written(
        reps.join(counts, "node", "left").select(
            F.col("node").alias("n2"), (F.col("times") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
        ),
        "links-of-nodes",
    )
    key = F.when(_usable(), F.xxhash64(text, F.md5(text)))
    out = rows.select("vec_id", key.alias("node")).join(per_node, F.col("node") == F.col("n2"), "left").drop("n2", "node")
    out = out.join(classes.toDF("c_node", "component"), F.col("vec_id") == F.col("c_node"), "left")
    own_id = F.coalesce("component", F.col("vec_id").cast("long"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own_id.alias("component_id"),
        F.coalesce(own_id == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
