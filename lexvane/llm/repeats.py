"""What repeats across documents: marked places, and levels that thin them out.

Shared by the two substring operators. A document is marked at a few places (a
small share of its symbols) so that equal windows have equal marks. Everything
that follows works on marks; texts meet them again only where repeats are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexvane.llm import sequences as seq
from lexvane.storage import written

_RIGHT, _LEFT, _SEGMENT = 0x51ED270B, 0x2545F491, 0x6A09E667


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id, oid, rid, text``: the id to order by, and a number for the row.

    A null id comes after all others. Equal rows share their number: what holds
    for one holds for all of them.
    """
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    last = F.lit((1 << 63) - 1)
    return docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), last).alias("oid"), key.alias("rid"), "text", *more
    )


def mark(rows: DataFrame, words: bool, n: int, k: int, m: int | None) -> DataFrame:
    """Marks of every row with at least ``n`` symbols, one array entry each.

    ``at`` (begin of the first window that chose the mark), ``back`` (from there
    to the mark), ``count`` (windows), ``h`` (hash of the mark's ``k`` symbols),
    ``s`` (hash of all symbols its windows cover) and, with ``m``, ``r`` and
    ``l``: hashes of the ``m`` symbols from the mark on and up to its end, null
    where the text is too short for them.
    """
    levels = m is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = seq.texts_of(batch.column(2))
            for a, b in seq.text_chunks(texts):
                some = seq.word_symbols(texts[a:b]) if words else seq.byte_symbols(texts[a:b])
                sums = seq.prefix(some.values)
                found, runs = seq.anchors(some, sums, n, k)
                counts = np.bincount(found.text, minlength=b - a)
                covers = found.count + n - 1
                columns = [
                    seq.lists((found.first - some.bounds[found.text]).astype(np.int32), counts, pa.int32()),
                    seq.lists((found.place - found.first).astype(np.int32), counts, pa.int32()),
                    seq.lists(found.count.astype(np.int32), counts, pa.int32()),
                    seq.lists(runs[found.place], counts, pa.int64()),
                    seq.lists(seq.run_hash(sums, found.first, covers, _SEGMENT), counts, pa.int64()),
                ]
                if levels:
                    begins, ends = some.bounds[found.text], some.bounds[found.text + 1]
                    for start, salt in ((found.place, _RIGHT), (found.place + k - m, _LEFT)):
                        fits = (start >= begins) & (start + m <= ends)
                        hashes = seq.run_hash(sums, np.where(fits, start, 0), np.where(fits, m, 0), salt)
                        columns.append(seq.lists(np.where(fits, hashes, np.uint64(0)), counts, pa.int64()))
                keep = pa.array(counts > 0)
                part = batch.slice(a, b - a)
                out = pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names)
                yield out.filter(keep)

    names = ["oid", "rid", "at", "back", "count", "h", "s"] + ["r", "l"] * levels
    schema = "oid long, rid long, at array<int>, back array<int>, count array<int>, h array<long>, s array<long>"
    marked = rows.select("oid", "rid", "text").mapInArrow(run, schema + ", r array<long>, l array<long>" * levels)
    return written(marked, "marks")


def exploded(marked: DataFrame, *names: str) -> DataFrame:
    """A row for each mark."""
    return marked.select("oid", "rid", F.inline(F.arrays_zip(*names)))


def repeated(rows: DataFrame, keys: list[str], across: bool) -> DataFrame:
    """Keys found in two documents (``across``), or found twice; written down.

    Merged before the shuffle, so a key with most of the rows is no burden.
    """
    grouped = rows.groupBy(*keys)
    if across:
        found = grouped.agg(F.min("oid").alias("lo"), F.max("oid").alias("hi")).filter("lo < hi")
    else:
        found = grouped.agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return written(found.select(*keys), "repeated")


def flagged_ranges(parts: list[DataFrame]) -> DataFrame:
    """``rid, starts, counts``: all ranges of flagged windows of a document."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return (
        rows.distinct()
        .groupBy("rid")
        .agg(F.collect_list(F.struct("at", "count")).alias("ranges"))
        .select("rid", F.col("ranges.at").alias("starts"), F.col("ranges.count").alias("counts"))
    )


def with_ranges(rows: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    """Texts and their ranges side by side; texts are shuffled once for it."""
    right = ranges.withColumnRenamed("rid", "range_rid")
    return rows.join(right, F.col("rid") == F.col("range_rid"), how).drop("range_rid")


def range_arrays(starts: pa.Array, counts: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray]:
    def values(column: pa.Array) -> np.ndarray:
        item = column[i]
        return item.values.to_numpy(zero_copy_only=False).astype(np.int64) if item.is_valid else np.zeros(0, np.int64)

    return values(starts), values(counts)
