"""Substring dedup: long runs of words that an earlier document already has.

Level-wise doubling. Runs of 13 words (at marked places) that repeat across
documents are extended to 25 words, both ways; those that still repeat lead to
the windows of 50. What is unique at one level is never looked at again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lexvane.llm import sequences as seq
from lexvane.llm.repeats import (
    exploded,
    flagged_ranges,
    keyed,
    mark,
    range_arrays,
    repeated,
    with_ranges,
)
from lexvane.storage import written

WINDOW = 50


def halves(n: int) -> tuple[int, int]:
    """The two lengths below ``n``: a half and a quarter of it, rounded up."""
    return -(-n // 2), -(-n // 4)


def repeated_ranges(rows: DataFrame, n: int = WINDOW) -> DataFrame:
    """``rid, starts, counts``: windows whose words also start in an earlier document."""
    m, k = halves(n)
    names = ("at", "back", "count", "h", "s", "r", "l")
    marks = exploded(mark(rows, True, n, k, m), *names)
    short = repeated(marks.select("h", "oid"), ["h"], across=True)
    alive = written(marks.join(short, "h", "left_semi"), "level-1")

    sides = alive.select(F.explode(F.array("r", "l")).alias("side"), "oid").filter("side != 0")
    double = repeated(sides, ["side"], across=True)
    to_right = alive.join(double.select(F.col("side").alias("r"), F.lit(True).alias("by_r")), "r", "left")
    both = to_right.join(double.select(F.col("side").alias("l"), F.lit(True).alias("by_l")), "l", "left")
    alive = written(both.filter("by_r or by_l").select("oid", "rid", "at", "count", "h", "s"), "level-2")

    # Equal stretches count once; all but the earliest document lose theirs whole.
    earliest = F.min(F.struct("oid", "rid", "at", "count")).alias("first")
    stretches = written(alive.groupBy("s", "h", F.col("count").alias("n")).agg(earliest), "stretches")
    copies = alive.join(
        stretches.select(F.col("s").alias("s2"), F.col("h").alias("h2"), F.col("first.oid").alias("first_oid")),
        (F.col("s") == F.col("s2")) & (F.col("h") == F.col("h2")) & (F.col("oid") > F.col("first_oid")),
    ).select("rid", "at", "count")

    # What is left is compared window by window.
    asked = flagged_ranges([stretches.select("first.rid", "first.at", "first.count")])
    windows = written(_windows(with_ranges(rows, asked, "inner"), n), "windows")
    first = windows.groupBy("h", "g").agg(F.min("oid").alias("lo"), F.max("oid").alias("hi")).filter("lo < hi")
    first = written(first.select(F.col("h").alias("h2"), F.col("g").alias("g2"), "lo"), "repeated-windows")
    later = windows.join(
        first, (F.col("h") == F.col("h2")) & (F.col("g") == F.col("g2")) & (F.col("oid") > F.col("lo"))
    ).select("rid", "at", F.lit(1).alias("count"))
    return flagged_ranges([copies, later])


def _windows(texts: DataFrame, n: int) -> DataFrame:
    """The windows in the given ranges: 96 bits of hash, document and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = seq.texts_of(batch.column(2))
            for a, b in seq.text_chunks(texts):
                some = seq.word_symbols(texts[a:b])
                sums, more = seq.prefix(some.values), seq.prefix(seq.mix(some.values))
                for i in range(a, b):
                    starts, counts = range_arrays(batch.column(3), batch.column(4), i)
                    if not len(starts):
                        continue
                    ends = np.cumsum(counts)
                    at = np.arange(ends[-1]) + np.repeat(starts - ends + counts, counts)
                    place = at + some.bounds[i - a]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(seq.run_hash(sums, place, n).view(np.int64)),
                            pa.array((seq.run_hash(more, place, n) >> np.uint64(33)).astype(np.int32)),
                            pa.array(np.full(len(at), batch.column(0)[i].as_py(), np.int64)),
                            pa.array(np.full(len(at), batch.column(1)[i].as_py(), np.int64)),
                            pa.array(at.astype(np.int32)),
                        ],
                        ["h", "g", "oid", "rid", "at"],
                    )

    return texts.select("oid", "rid", "text", "starts", "counts").mapInArrow(
        run, "h long, g int, oid long, rid long, at int"
    )


def remove_repeats(docs: DataFrame, n: int = WINDOW, texts: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document.

    A word goes if it lies in a window of ``n`` words that also starts in a
    document with a smaller id; windows are those of the input. ``texts`` also
    gives the kept words as ``kept_text``. Documents under ``n`` words, null
    and empty texts lose nothing. Documents sharing an id do not count as
    earlier than each other; a null id comes after all others, and documents
    without id not before each other. Repeated rows give repeated rows, further
    columns are left out, an empty table gives an empty table.
    """
    rows = keyed(docs)
    joined = with_ranges(rows, repeated_ranges(rows, n), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, str, str | None]] = []
            for i, text in enumerate(seq.texts_of(batch.column(1))):
                words = text.split()
                starts, counts = range_arrays(batch.column(2), batch.column(3), i)
                removed = seq.covered(len(words), starts, counts, n)
                kept = [w for w, gone in zip(words, removed.tolist()) if not gone] if len(starts) else words
                whole = b" ".join(kept)
                digest = hashlib.sha256(whole).hexdigest()
                out.append((len(words), len(words) - len(kept), digest, whole.decode() if texts else None))
            columns = list(zip(*out)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]][: 5 if texts else 4]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * texts
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts
    return joined.select("doc_id", "text", "starts", "counts").mapInArrow(run, schema)


def cut_texts(docs: DataFrame, n: int = WINDOW) -> DataFrame:
    """The documents without their repeated words, with the columns they had.

    A document that loses words gets its kept words, joined by one space, as
    ``text`` (and their length as ``n_chars``, if it has such a column). One
    that loses all of them is left out. All others are returned unchanged, those
    without words included.
    """
    keys = keyed(docs).columns
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = keyed(docs, whole)
    ranges = repeated_ranges(rows.select(*keys), n)
    joined = with_ranges(rows.select("rid", "whole"), ranges, "left")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, text in enumerate(seq.texts_of(batch.column(0).field("text"))):
                words = text.split()
                removed = seq.covered(len(words), *range_arrays(batch.column(1), batch.column(2), i), n)
                out.append(b" ".join([w for w, gone in zip(words, removed.tolist()) if not gone]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["whole", "new"])

    # Only documents that lose something go through Python, and once: a function used as a
    # column is called for the filter and again for the row, by two workers in each task.
    losing = joined.filter("starts is not null").select("whole", "starts", "counts")
    changed = losing.mapInArrow(kept, StructType([joined.schema["whole"], StructField("new", StringType())]))
    row = F.col("whole").withField("text", F.col("new"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("new").cast(docs.schema["n_chars"].dataType))
    changed = changed.filter(F.length("new") > 0).select(row.alias("whole"))
    same = joined.filter("starts is null").select("whole")
    return same.unionByName(changed).select("whole.*")
