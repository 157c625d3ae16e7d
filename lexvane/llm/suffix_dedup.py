"""Suffix-array dedup: long byte strings that occur anywhere else.

Stretches of text that may hold a repeat are gathered by a marked run of bytes
they share and lined up at it. Each collection of stretches is then taken
column by column from the right: every round inserts one symbol of each stretch
in front of its suffix, which keeps the order of suffixes (a stable sort of the
old order by the new symbol, as in the Burrows-Wheeler transform of a
collection) and their common prefixes (one more than the smallest between two
suffixes of the same symbol). Symbols lie in a file, column after column, and
are read in sequence; memory holds one column, the order and the prefixes.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

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

WINDOW, RUN = 200, 64
NONE = 256  # symbol beyond either end of a stretch, equal to nothing
ROWS = 20_000  # stretches of a collection handed to the file at once


class Columns:
    """Symbols of lined-up stretches in a file: blocks of rows, each column after column."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.blocks: list[int] = []
        self.file = tempfile.TemporaryFile()  # noqa: SIM115

    @property
    def rows(self) -> int:
        return sum(self.blocks)

    def add(self, pieces: list[bytes], starts: np.ndarray) -> None:
        """Put down stretches, each beginning at its own column."""
        block = np.full((self.width, len(pieces)), NONE, np.uint16)
        for row, (piece, start) in enumerate(zip(pieces, starts.tolist())):
            block[start : start + len(piece), row] = np.frombuffer(piece, np.uint8)
        self.file.write(block.data)
        self.blocks.append(len(pieces))

    def column(self, number: int) -> np.ndarray:
        parts, at = [], 0
        for rows in self.blocks:
            self.file.seek(2 * (at * self.width + number * rows))
            parts.append(np.frombuffer(self.file.read(2 * rows), np.uint16))
            at += rows
        return np.concatenate(parts)


def insert_columns(columns: Columns, group: np.ndarray, n: int, last: int) -> np.ndarray:
    """Which windows of ``n`` symbols, beginning in the first ``last`` columns, repeat.

    ``group`` numbers the collections (equal numbers side by side); suffixes are
    compared within one only. Row i of the answer is for stretch i.
    """
    rows = columns.rows
    order = np.arange(rows)
    prefix = np.zeros(rows + 1, np.int32)  # with the neighbour before, in this order
    group = group.astype(np.int64)
    found = np.zeros((rows, last), bool)
    for column in range(columns.width - 1, -1, -1):
        symbols = columns.column(column).astype(np.int64)[order]
        key = group[order] * 512 + symbols
        back = np.argsort(key, kind="stable")  # old ranks in the new order
        key = key[back]
        same = np.flatnonzero((key[1:] == key[:-1]) & (symbols[back[1:]] != NONE)) + 1
        low, high = back[same - 1], back[same]
        least = prefix[high]
        wide = np.flatnonzero(high - low > 1)
        if len(wide):
            wide = wide[np.argsort(low[wide], kind="stable")]
            pairs = np.stack([low[wide] + 1, high[wide] + 1], axis=1).ravel()
            least[wide] = np.minimum.reduceat(prefix, pairs)[::2]
        prefix = np.zeros(rows + 1, np.int32)
        prefix[same] = least + 1
        order = order[back]
        if column < last:
            long = prefix >= n
            found[order, column] = long[:-1] | long[1:]
    return found


def _ranges(found: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Begins and lengths of the true runs of each row."""
    edge = np.diff(found.astype(np.int8), axis=1, prepend=0, append=0)
    out = []
    for row in edge:
        begins = np.flatnonzero(row == 1)
        out.append((begins, np.flatnonzero(row == -1) - begins))
    return out


def repeated_ranges(rows: DataFrame, n: int = WINDOW, k: int = RUN) -> DataFrame:
    """``rid, starts, counts``: windows of ``n`` bytes that also start elsewhere."""
    marks = exploded(mark(rows, False, n, k, None), "at", "back", "count", "h", "s")
    twice = repeated(marks.select("h"), ["h"], across=False)
    alive = written(marks.join(twice, "h", "left_semi").drop("oid"), "alive")

    # Equal stretches are one row and a number of times.
    one = F.min(F.struct("rid", "at", "back")).alias("first")
    stretches = written(
        alive.groupBy("s", "h", F.col("count").alias("n")).agg(one, F.count(F.lit(1)).alias("times")), "stretches"
    )
    often = stretches.filter("times > 1").select(F.col("s").alias("s2"), F.col("h").alias("h2"), F.col("n").alias("n2"))
    copies = alive.join(
        often, (F.col("s") == F.col("s2")) & (F.col("h") == F.col("h2")) & (F.col("count") == F.col("n2"))
    ).select("rid", "at", "count")

    # Different stretches around the same mark are compared symbol by symbol.
    several = repeated(stretches, ["h"], across=False)
    open_ = stretches.join(several, "h", "left_semi")
    asked = open_.groupBy("first.rid").agg(
        F.collect_list(F.struct("h", "first.at", "first.back", F.col("n").alias("count"), "times")).alias("parts")
    )
    asked = asked.select(F.col("rid").alias("range_rid"), *[F.col(f"parts.{c}").alias(c) for c in ("h", "at", "back", "count", "times")])
    cut = _stretches(rows.join(asked, F.col("rid") == F.col("range_rid")), n, k)
    found = written(_compared(cut, n, k), "found")
    return flagged_ranges([copies, found])


def _stretches(texts: DataFrame, n: int, k: int) -> DataFrame:
    """The bytes of the asked stretches with their mark, document and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(seq.texts_of(batch.column(1))):
                h, at, back, count, times = (batch.column(c)[i].values for c in range(2, 7))
                spans = zip(at.to_pylist(), count.to_pylist())
                pieces = [text[a : a + c + n - 1] for a, c in spans]
                rid = pa.array(np.full(len(pieces), batch.column(0)[i].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [h, rid, at, back, times, pa.array(pieces, pa.binary())], ["h", "rid", "at", "back", "times", "piece"]
                )

    return texts.select("rid", "text", "h", "at", "back", "count", "times").mapInArrow(
        run, "h long, rid long, at int, back int, times long, piece binary"
    )


def _compared(cut: DataFrame, n: int, k: int) -> DataFrame:
    """``rid, at, count`` of the windows that repeat, of stretches that occur once."""
    reach = n - k  # the most bytes a stretch has before its mark
    width = reach + n

    def answers(columns: Columns, facts: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        whole = pa.concat_tables(facts)
        h, back, at, rid, times = (whole.column(c).to_numpy() for c in ("h", "back", "at", "rid", "times"))
        group = np.cumsum(np.r_[0, h[1:] != h[:-1]])
        found = insert_columns(columns, group, n, reach + 1)
        columns.file.close()
        out: list[list[np.ndarray]] = [[], [], []]
        for i in np.flatnonzero((times == 1) & found.any(axis=1)):
            begins, lengths = _ranges(found[i : i + 1])[0]
            out[0].append(np.full(len(begins), rid[i]))
            out[1].append(begins - (reach - back[i]) + at[i])
            out[2].append(lengths)
        if out[0]:
            kinds = (np.int64, np.int32, np.int32)
            arrays = [pa.array(np.concatenate(c).astype(t)) for c, t in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["rid", "at", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole marks are put together until there are ROWS stretches; a mark of
        # any number of stretches is one collection, its symbols in the file.
        columns, facts = Columns(width), []

        def add(table: pa.Table) -> None:
            if table.num_rows:
                columns.add(table.column("piece").to_pylist(), reach - table.column("back").to_numpy())
                facts.append(table.drop_columns(["piece"]))

        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                table = pa.Table.from_batches([batch.slice(low, ROWS)])
                h = table.column("h").to_numpy()
                last = facts[-1].column("h")[-1].as_py() if facts else h[0]
                change = np.flatnonzero(np.r_[last, h[:-1]] != h)
                if len(change) and columns.rows + len(h) >= ROWS:
                    add(table.slice(0, int(change[-1])))
                    if facts:
                        yield from answers(columns, facts)
                    columns, facts, table = Columns(width), [], table.slice(int(change[-1]))
                add(table)
        if facts:
            yield from answers(columns, facts)

    return cut.repartition("h").sortWithinPartitions("h").mapInArrow(run, "rid long, at int, count int")


def remove_repeats(docs: DataFrame, n: int = WINDOW, texts: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    A byte of a text's UTF-8 goes if it lies in a string of ``n`` bytes that also
    starts anywhere else, the same document included; strings are those of the
    input and never cross documents. ``n_spans`` counts the maximal removed
    runs; ``texts`` also gives the remaining bytes as ``kept``. Null texts are
    empty and lose nothing, nor do texts under ``n`` bytes. Repeated rows are
    documents of their own and so remove each other; further columns are left
    out; an empty table gives an empty table.
    """
    rows = keyed(docs)
    joined = with_ranges(rows, repeated_ranges(rows, n), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, str, bytes | None]] = []
            for i, text in enumerate(seq.texts_of(batch.column(1))):
                starts, counts = range_arrays(batch.column(2), batch.column(3), i)
                kept, spans = text, 0
                if len(starts):
                    removed = seq.covered(len(text), starts, counts, n)
                    spans = int((np.diff(removed.astype(np.int8), prepend=0) == 1).sum())
                    kept = np.frombuffer(text, np.uint8)[~removed].tobytes()
                digest = hashlib.sha256(kept).hexdigest()
                out.append((len(text), len(text) - len(kept), spans, digest, kept if texts else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = list(zip(*out)) or [()] * 5
            arrays = [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds)]][: 6 if texts else 5]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * texts
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    return joined.select("doc_id", "text", "starts", "counts").mapInArrow(run, schema)
