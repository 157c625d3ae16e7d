"""Ranked lexical search: bundles of items visit the owners of terms one after another.

Documents are indexed in blocks: for each block and term, the places of the
documents in the block and how often they hold the term. Every term has an
owner, by how frequent it is, the owner of the rarest first. A bundle of items
carries, for each block, sparse accumulators of document scores from owner to
owner; at each of them a cogroup brings together the accumulators and the
owner's postings of the terms that the bundle asks for, and adds contributions
in 64-bit integers. So the frequent terms, which touch most documents, come
last, and what they touch is never shuffled again: the last owner's stage keeps
the best of each block, and the best of those are the answer.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexvane.storage import written

BEST = 20
BLOCK = 4096  # documents a block
BUNDLE = 64  # items a bundle, about
SENT_BYTES = 16 * 1024 * 1024  # of terms or requests that are sent to all workers
# Owners: shares of the documents from which on a term belongs to the next one.
SHARES = (1 / 64, 1 / 8)

_KEPT = bytes(b if chr(b).isalnum() and b < 128 or b > 127 else 32 for b in range(256)).lower()
_INDEX = "block long, term binary, places array<int>, times array<int>, ids array<long>, sizes array<long>"
_STATE = "block long, bundle int, item long, places array<int>, scores array<long>, ids array<long>"


def terms_of(text: bytes | None) -> list[bytes]:
    """ASCII letters and digits and all other characters beyond ASCII, in runs; A-Z lower-cased."""
    return (text or b"").translate(_KEPT).split()


def _item_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, term, times`` of rows ``item, item_id, text``; an item without terms gives none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            found = [(i, t, n) for i, text in enumerate(texts) for t, n in Counter(terms_of(text)).items()]
            at = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array([f[1] for f in found], pa.binary()),
                    pa.array([f[2] for f in found], pa.int64()),
                ],
                ["item", "item_id", "term", "times"],
            )

    id_type = items.schema["item_id"].dataType.simpleString()
    return items.mapInArrow(run, f"item long, item_id {id_type}, term binary, times long")


def index_blocks(docs: DataFrame, wanted: Broadcast | None) -> DataFrame:
    """Postings of each block and term, and of each block a head row without a term.

    The head holds the ids of the block's documents in ascending order (null
    last) and their numbers of terms; a document's place in it is its place in
    the postings. ``wanted`` limits the postings to these terms.
    """

    def block_rows(number: int, held: list[tuple]) -> pa.RecordBatch:
        held.sort(key=lambda d: (d[0] is None, d[0] or 0))
        postings: dict[bytes, tuple[list, list]] = {}
        for place, (_, _, counts) in enumerate(held):
            for term, times in counts.items():
                places_times = postings.setdefault(term, ([], []))
                places_times[0].append(place)
                places_times[1].append(times)
        rows = len(postings)
        columns = [
            pa.array([number] * (rows + 1), pa.int64()),
            pa.array([None, *postings], pa.binary()),
            pa.array([None, *(p[0] for p in postings.values())], pa.list_(pa.int32())),
            pa.array([None, *(p[1] for p in postings.values())], pa.list_(pa.int32())),
            pa.array([[d[0] for d in held]] + [None] * rows, pa.list_(pa.int64())),
            pa.array([[d[1] for d in held]] + [None] * rows, pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "term", "places", "times", "ids", "sizes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = None if wanted is None else wanted.value.__contains__
        number, held = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    terms = terms_of(text)
                    held.append((doc, len(terms), Counter(filter(asked, terms) if asked else terms)))
                    if len(held) == BLOCK:
                        yield block_rows(number, held)
                        number, held = number + 1, []
        if held:
            yield block_rows(number, held)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _INDEX)


def _owned(index: DataFrame, rows: int) -> DataFrame:
    """``term, weight, owner`` of the terms that some document holds."""
    counted = index.filter("term is not null").groupBy("term").agg(F.sum(F.size("places")).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * rows + 2.0) / (2.0 * F.col("df") + 1.0)))
    owner = F.lit(0)
    for share in SHARES:
        owner = owner + (F.col("df") >= share * rows).cast("int")
    return counted.select("term", weight.cast("long").alias("weight"), owner.alias("owner"))


def _lists(column: pa.ChunkedArray) -> list[np.ndarray | None]:
    """The lists of a column as arrays, without copying their values one by one."""
    one = column.combine_chunks()
    one = one.chunk(0) if isinstance(one, pa.ChunkedArray) else one
    if len(one) == 0:
        return []
    offsets, values = one.offsets.to_numpy(), one.values.to_numpy(zero_copy_only=False)
    there = one.is_valid().to_numpy(zero_copy_only=False)
    return [values[a:b] if ok else None for a, b, ok in zip(offsets, offsets[1:], there)]


def _visit(rows: int, total: int, best: int | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One owner's work on a bundle and block: add, and carry on or (``best``) select."""

    def table(columns: list[pa.Array]) -> pa.Table:
        return pa.Table.from_arrays(columns, ["block", "bundle", "item", "places", "scores", "ids"])

    def visit(state: pa.Table, postings: pa.Table) -> pa.Table:
        items = state.column("item").to_pylist()
        places, scores = _lists(state.column("places")), _lists(state.column("scores"))
        head = items.index(None)
        key = [state.column(c)[head].as_py() for c in ("block", "bundle")]
        sizes = scores[head].astype(np.int64)
        longer = 75 + 25 * sizes * rows // total
        carried: dict[int, np.ndarray] = {}

        def scores_of(item: int) -> np.ndarray:
            if item not in carried:
                carried[item] = np.zeros(len(sizes), np.int64)
            return carried[item]

        for item, at, score in zip(items, places, scores):
            if item is not None:
                scores_of(item)[at] = score
        weights = postings.column("weight").to_pylist()
        parts = (_lists(postings.column(c)) for c in ("places", "times", "items", "repeats"))
        for weight, at, times, asking, repeats in zip(weights, *parts):
            times = times.astype(np.int64)
            adds = weight * (1_000_000_000 * times // (1000 * times + 12 * longer[at]))
            for item, repeat in zip(asking.tolist(), repeats.tolist()):
                scores_of(item)[at] += repeat * adds
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        for item, sums in carried.items():
            at = np.flatnonzero(sums)
            if best is not None and len(at) > best:
                least = np.partition(sums, len(sums) - best)[len(sums) - best]
                at = at[sums[at] >= least]
                at = np.sort(at[np.argsort(-sums[at], kind="stable")[:best]])
            if len(at):
                out.append((item, at.astype(np.int32), sums[at]))
        if best is None:
            head_row = (None, None, sizes)
            heads = [state.column("ids")[head].as_py()] + [None] * len(out)
            out.insert(0, head_row)
        else:
            ids = np.array(state.column("ids")[head].as_py(), object)
            heads = [ids[at].tolist() for _, at, _ in out]
        return table(
            [
                pa.array([key[0]] * len(out), pa.int64()),
                pa.array([key[1]] * len(out), pa.int32()),
                pa.array([o[0] for o in out], pa.int64()),
                pa.array([o[1] for o in out], pa.list_(pa.int32())),
                pa.array([o[2] for o in out], pa.list_(pa.int64())),
                pa.array(heads, pa.list_(pa.int64())),
            ]
        )

    return visit


def search(items: DataFrame, docs: DataFrame, best: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of each item.

    Every row of ``items(item_id, text)`` is an item and every row of
    ``docs(doc_id, text)`` a document of its own, also if ids repeat or are null
    (equal scores: null ids last). Null texts, and texts without terms, match
    nothing and do not count as documents. Items that match nothing, and empty
    tables, give no rows. Further columns are left out.

    Up to SENT_BYTES of terms are sent to the workers, which then index no others;
    of a larger index only what meets an item's term is read on. Blocks bound what a task holds at once; each
    is a key of its own, so a frequent term is spread over all of them.
    """
    spark = docs.sparkSession
    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    asked = written(_item_terms(numbered), "item-terms")
    names = asked.select("item", "item_id").distinct()
    vocabulary = asked.select("term").distinct()
    count, size = asked.select(F.countDistinct("item")).first()[0], vocabulary.agg(F.sum(F.octet_length("term"))).first()[0]
    answer = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
    if not count:
        return spark.createDataFrame([], answer)
    if size <= SENT_BYTES:
        wanted = spark.sparkContext.broadcast(frozenset(bytes(r[0]) for r in vocabulary.collect()))
        index = written(index_blocks(docs, wanted), "index")
    else:  # blocks are numbered by their tasks: they are written before anything else
        index = written(index_blocks(docs, None), "index")
    heads = index.filter("term is null").select("block", "ids", "sizes")
    there = F.size(F.filter("sizes", lambda n: n > 0))
    spoken = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)
    rows, total = heads.agg(F.sum(there.cast("long")), F.sum(spoken)).first()
    if not rows:
        return spark.createDataFrame([], answer)

    bundles = -(-count // BUNDLE)
    bundled = asked.withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int"))
    wanting = bundled.groupBy("term", "bundle").agg(F.collect_list(F.struct("item", "times")).alias("w"))
    wanting = wanting.select("term", "bundle", F.col("w.item").alias("items"), F.col("w.times").alias("repeats"))
    requests = written(wanting.join(_owned(index, rows), "term"), "requests")
    sent = requests.agg(F.sum(F.octet_length("term") + 16 * F.size("items") + 32)).first()[0] or 0
    state = heads.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle"),
        F.lit(None).cast("long").alias("item"),
        F.lit(None).cast("array<int>").alias("places"),
        F.col("sizes").alias("scores"),
        "ids",
    )
    owners = len(SHARES) + 1
    for owner in range(owners):
        here = requests.filter(F.col("owner") == owner).drop("owner")
        here = F.broadcast(here) if sent <= SENT_BYTES else here
        postings = index.filter("term is not null").select("block", "term", "places", "times")
        postings = postings.join(here, "term").drop("term")
        postings = postings.select(*(F.col(c).alias(c) for c in postings.columns))
        work = _visit(rows, total, best if owner == owners - 1 else None)
        pairs = state.groupBy("block", "bundle").cogroup(postings.groupBy("block", "bundle"))
        state = pairs.applyInArrow(work, _STATE)
    found = state.select("item", F.inline(F.arrays_zip(F.col("ids").alias("doc_id"), F.col("scores").alias("score"))))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
