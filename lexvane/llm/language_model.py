"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised to powers of a base; an n-gram of
level q is in the filter under q names, one for each level up to its own. A
count is found by asking for level after level until the answer is no. Pairs
are smoothed with the words: ``p(w | v) = (c(vw) + M p(w)) / (c(v) + M)``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexvane.llm import sequences as seq
from lexvane.storage import written

FOLDS = 10  # rows whose checksum leaves no remainder are held out
BASE = 1.5  # of the levels
BITS, PROBES = 10, 6  # bits for each name in the filter, probes for each question
PRIOR = 1000.0  # M
ADDED = 0.1
BUCKET_KEYS = 16_384  # n-grams a bucket has, about
SEND_BYTES = 64 << 20  # of the filter, or of the word counts, in a block
GROUP = 16  # MB of text, at most, that a task takes through all blocks at once
FLUSH = 4_000_000  # pairs counted in a task before they are handed on
ASKED = 100_000  # hashes looked up in the filter at once
PARTS = 16  # ranges of hashes in which they are handed on, one at a time; a power of two

END = np.uint64(0x5DEECE66D1234567)  # the token that ends a text
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def held_out() -> Column:
    """Rows that are never learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each closed by the end token, and bounds of texts."""
    some = seq.word_symbols(texts, seq.LOWER_BYTES)
    return np.insert(some.values, some.bounds[1:], END), some.bounds + np.arange(len(texts) + 1)


def pairs(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash for each token with the one before; the first follows an end."""
    before = np.empty_like(values)
    before[1:] = values[:-1]
    before[bounds[:-1]] = END
    return seq.mix(before * _PAIR + values)


def level_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-9).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The count in the middle of a level; 0 for level 0."""
    return np.where(levels > 0, np.maximum(1.0, np.round(BASE ** (levels - 0.5))), 0.0)


class Filter:
    """Some neighbouring buckets of a log-frequency Bloom filter.

    ``first`` numbers the first bucket and ``offsets`` are the byte places of
    the buckets in ``bits``; ``shift`` takes a hash to its bucket.
    """

    def __init__(self, first: int, shift: int, offsets: np.ndarray, bits: np.ndarray) -> None:
        self.first, self.shift, self.offsets, self.bits = first, shift, offsets, bits

    def span(self, h: np.ndarray) -> slice:
        """Those of ascending hashes whose buckets are here."""
        low, high = (bucket << self.shift for bucket in (self.first, self.first + len(self.offsets) - 1))
        end = np.searchsorted(h, np.uint64(high)) if high < 1 << 64 else len(h)
        return slice(int(np.searchsorted(h, np.uint64(low))), int(end))

    def counts(self, h: np.ndarray) -> np.ndarray:
        """Counts of hashes whose buckets are here."""
        return np.concatenate([np.zeros(0), *(self._counts(h[i : i + ASKED]) for i in range(0, len(h), ASKED))])

    def _counts(self, h: np.ndarray) -> np.ndarray:
        bucket = _bucket(h, self.shift) - self.first
        start, size = self.offsets[bucket] * 8, (self.offsets[bucket + 1] - self.offsets[bucket]) * 8
        levels = np.zeros(len(h), np.int64)
        open_ = np.flatnonzero(size > 0)
        level = 1
        while len(open_):
            name = _name(h[open_], level)
            yes = np.ones(len(open_), bool)
            for probe in range(PROBES):
                asked = np.flatnonzero(yes)
                at = start[open_[asked]] + _place(name[asked], probe, size[open_[asked]])
                yes[asked] = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            open_ = open_[yes]
            levels[open_] = level
            level += 1
        return count_of(levels)


def _bucket(h: np.ndarray, shift: int) -> np.ndarray:
    return (h >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(h), np.int64)


def _known_bits(h: np.ndarray, shift: int) -> np.ndarray:
    """The bits of a pair's hash that are kept: its bucket and 32 more."""
    return h >> np.uint64(shift - 32) << np.uint64(shift - 32)


def _name(h: np.ndarray, level: int | np.ndarray) -> np.ndarray:
    return seq.mix(h + np.asarray(level, np.uint64) * np.uint64(0xA24BAED4963EE407))


def _place(name: np.ndarray, probe: int, size: np.ndarray) -> np.ndarray:
    step = (name >> np.uint64(32)) | np.uint64(1)
    return ((name & np.uint64(0xFFFFFFFF)) + np.uint64(probe) * step).astype(np.int64) % size


def bucket_bits(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits of one bucket for these hashes and counts."""
    levels = level_of(counts)
    names = int(levels.sum())
    if not names:
        return np.zeros(0, np.uint8)
    size = (names * BITS + 63) // 64 * 64
    level = np.arange(names) - np.repeat(np.cumsum(levels) - levels, levels) + 1
    name = _name(np.repeat(h, levels), level)
    bits = np.zeros(size, np.uint8)
    for probe in range(PROBES):
        bits[_place(name, probe, np.full(names, size))] = 1
    return np.packbits(bits, bitorder="little")


def _counted(docs: DataFrame, pair: bool, shift: int) -> DataFrame:
    """``bucket, keys, counts``: packed partial counts, a row for each bucket and flush.

    Counting and packing in the task leave few bytes for the shuffle: a key is
    the 32 bits of a hash that follow its bucket (pairs) or the whole hash.
    """

    def packed(h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        bucket = _bucket(h, shift)
        begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[begin[1:], len(h)]
        keys = (h >> np.uint64(shift - 32)).astype(np.uint32) if pair else h
        cells = list(zip(begin.tolist(), ends.tolist()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[begin]),
                pa.array([keys[a:b].tobytes() for a, b in cells], pa.binary()),
                pa.array([_thin(n[a:b]) for a, b in cells], pa.binary()),
            ],
            ["bucket", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            column = batch.column(0)
            for a, b in seq.column_chunks(column):
                values, bounds = tokens(seq.texts_of(column.slice(a, b - a)))
                h, n = np.unique(pairs(values, bounds) if pair else values, return_counts=True)
                held.append((h, n.astype(np.uint32)))
                size += len(h)
                if size >= FLUSH:
                    yield from (packed(*some) for some in _in_parts(held))
                    held, size = [], 0
        yield from (packed(*some) for some in _in_parts(held))

    return docs.select("text").mapInArrow(run, "bucket long, keys binary, counts binary")


def _thin(counts: np.ndarray) -> bytes:
    """Counts in one byte each if they fit, else in eight; the length tells."""
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint64).tobytes()


def _in_parts(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The merged hashes and counts of ascending runs, range after range, so that little is sorted at once."""
    edges = np.arange(1, PARTS, dtype=np.uint64) << np.uint64(65 - PARTS.bit_length())
    cuts = [[0, *np.searchsorted(h, edges).tolist(), len(h)] for h, _ in held]
    for i in range(PARTS):
        some = [(h[c[i] : c[i + 1]], n[c[i] : c[i + 1]]) for (h, n), c in zip(held, cuts)]
        if any(len(h) for h, _ in some):
            yield _merged(some)


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    h, n = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    begin = np.flatnonzero(np.r_[True, h[1:] != h[:-1]][: len(h)])
    return h[begin], np.add.reduceat(n, begin, dtype=np.int64) if len(h) else n


def _summed(counted: DataFrame, pair: bool, shift: int) -> DataFrame:
    """``bucket, bits, n, total`` and, for words, ``hashes, counts``, one row a bucket."""
    dtype = np.uint32 if pair else np.uint64

    def merged(rows: list[tuple[int, bytes, bytes]]) -> tuple:
        held = []
        for _, keys, counts in rows:
            k = np.frombuffer(keys, dtype)
            held.append((k, np.frombuffer(counts, np.uint8 if len(counts) == len(k) else np.uint64).astype(np.int64)))
        k, n = _merged(held)
        bucket = rows[0][0]
        h = k.astype(np.uint64)
        if pair:
            h = h << np.uint64(shift - 32) | (np.uint64(bucket << shift) if shift < 64 else np.uint64(0))
        exact = (None, None) if pair else (k.tobytes(), n.tobytes())
        return bucket, bucket_bits(h, n).tobytes(), len(k), int(n.sum()), *exact

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, bytes]] = []
        for batch in seq.parts(batches):
            done = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    done.append(merged(held))
                    held = []
                held.append(row)
            if done:
                yield out(done)
        if held:
            yield out([merged(held)])

    def out(done: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*done), kinds)], ["bucket", "bits", "n", "total", "hashes", "counts"]
        )

    schema = "bucket long, bits binary, n long, total long, hashes binary, counts binary"
    return counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _blocks(buckets: DataFrame, column: str, limit: int) -> list[tuple[int, int]]:
    """Ranges of buckets of at most ``limit`` bytes each (or a single bucket)."""
    out: list[list[int]] = []
    room = 0
    for row in buckets.select("bucket", F.length(column).alias("n")).orderBy("bucket").toLocalIterator():
        if not out or row["n"] > room:
            out.append([row["bucket"], row["bucket"]])
            room = limit
        out[-1][1] = row["bucket"]
        room -= row["n"]
    return [(a, b) for a, b in out]


def _load_filter(buckets: DataFrame, shift: int, low: int, high: int) -> Filter:
    part = buckets.filter(F.col("bucket").between(low, high)).select("bucket", "bits").orderBy("bucket")
    sizes, pieces = np.zeros(high - low + 2, np.int64), []
    for row in part.toLocalIterator():
        sizes[row["bucket"] - low + 1] = len(row["bits"])
        pieces.append(row["bits"])
    return Filter(low, shift, np.cumsum(sizes), np.frombuffer(b"".join(pieces) or b"\0", np.uint8))


def _load_words(buckets: DataFrame, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    part = buckets.filter(F.col("bucket").between(low, high)).select("hashes", "counts").orderBy("bucket")
    rows = [(r["hashes"], r["counts"]) for r in part.toLocalIterator()]
    counts = np.frombuffer(b"".join(n for _, n in rows), np.int64)
    return (
        np.frombuffer(b"".join(h for h, _ in rows), np.uint64),
        counts.astype(np.min_scalar_type(counts.max(initial=0))),
    )


def _shift_for(n: int) -> int:
    """So many bits of a hash follow its bucket that buckets have about BUCKET_KEYS keys."""
    return 64 - min(32, max(0, (n // BUCKET_KEYS).bit_length()))


def score_documents(docs: DataFrame, limit: int = SEND_BYTES) -> DataFrame:
    """Base and model scores of every document, learned from those not held out.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``. Scores are log10 probabilities of the text and its end. Null and
    empty texts are the end token alone; repeated rows are scored (and learned
    from) each; further columns are left out; an empty table gives an empty
    table. Without any training row nothing is known and each token counts the
    same.

    Word counts and the filter are sent in blocks of ``limit`` bytes, and a task
    holds one block at a time: texts are read and cut into tokens once, and the
    different words and pairs of a group of texts go through block after block.
    """
    train = docs.filter(~held_out())
    # A word takes six bytes or so; a guess of the tokens sizes the buckets.
    chars = train.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    shift = _shift_for(chars // 6)
    word_shift = _shift_for(chars // 60)
    words = written(_summed(_counted(train, False, word_shift), False, word_shift), "lm-words")
    two = written(_summed(_counted(train, True, shift), True, shift), "lm-pairs")
    known = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("v"), F.coalesce(F.sum("total"), F.lit(0)).alias("n")
    ).first()
    total, distinct = known["n"], known["v"]

    context = docs.sparkSession.sparkContext
    word_blocks, pair_blocks = _blocks(words, "hashes", limit // 2), _blocks(two, "bits", limit)
    of_words = [
        context.broadcast((*_load_words(words, *span), _load_filter(words, word_shift, *span)))
        for span in _covers(word_blocks, word_shift)
    ]
    of_pairs = [context.broadcast(_load_filter(two, shift, *span)) for span in _covers(pair_blocks, shift)]
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    out = _scored(rows, of_words, of_pairs, shift, total, distinct)
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )


def _covers(blocks: list[tuple[int, int]], shift: int) -> list[tuple[int, int]]:
    """The ranges of buckets, widened by the empty ones up to the next block."""
    ends = [low - 1 for low, _ in blocks[1:]] + [(1 << (64 - shift)) - 1]
    return [(low if i else 0, end) for i, ((low, _), end) in enumerate(zip(blocks or [(0, 0)], ends))]


def _in_turn(sent: list[Broadcast], use: Callable[..., None]) -> None:
    """Use the blocks one after the other; a task holds none but a single one, also while it reads the next."""
    for handle in sent:
        use(handle.value)
        if len(sent) > 1:
            vars(handle).pop("_value", None)  # it is read from the worker's disk again when needed


def _scored(
    rows: DataFrame, of_words: list[Broadcast], of_pairs: list[Broadcast], shift: int, total: int, distinct: int
) -> DataFrame:
    """Scores of all rows, in one pass over them."""
    below = total + ADDED * (distinct + 1)
    most = seq.CHUNK * min(GROUP, max(len(of_words), len(of_pairs)))

    def scored(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """A group of texts: cut up chunk by chunk, so that numbers of tokens alone are kept of all."""
        chunks = []
        for a, b in seq.column_chunks(batch.column(2)):
            values, bounds = tokens(seq.texts_of(batch.column(2).slice(a, b - a)))
            chunks.append((a, b, bounds, *_numbered(values), *_numbered(_known_bits(pairs(values, bounds), shift))))
        different, asked = _union([chunk[3] for chunk in chunks]), _union([chunk[5] for chunk in chunks])
        exact, about = np.zeros(len(different), np.int64), np.zeros(len(different))
        together = np.zeros(len(asked))

        def count_words(block: tuple[np.ndarray, np.ndarray, Filter]) -> None:
            words, counts, found = block
            mine = found.span(different)
            exact[mine] = _exact_counts(different[mine], words, counts)
            about[mine] = found.counts(different[mine])

        def count_pairs(found: Filter) -> None:
            mine = found.span(asked)
            together[mine] = found.counts(asked[mine])

        _in_turn(of_words, count_words)
        _in_turn(of_pairs, count_pairs)
        ended = about[np.searchsorted(different, END)]
        for a, b, bounds, words, back, two, again in chunks:
            lengths = np.diff(bounds)
            owner = np.repeat(np.arange(b - a), lengths)
            at = np.searchsorted(different, words)
            here = about[at][back]
            first = np.empty(len(back))
            first[1:] = here[:-1]
            first[bounds[:-1]] = ended
            both = np.minimum(together[np.searchsorted(asked, two)][again], np.minimum(first, here))
            score = np.log10((both + PRIOR * (here + ADDED) / below) / (first + PRIOR))
            base = np.log10((exact[at] + ADDED) / below)
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(lengths),
                    pa.array(np.bincount(owner, (exact[at] > 0)[back], b - a).astype(np.int64)),
                    pa.array(np.bincount(owner, base[back], b - a)),
                    pa.array(np.bincount(owner, score, b - a)),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in seq.column_chunks(batch.column(2), most):
                yield from scored(batch.slice(a, b - a))

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, ascending, and the place of each value among them."""
    different, back = np.unique(values, return_inverse=True)
    return different, back.astype(np.int32)


def _union(parts: list[np.ndarray]) -> np.ndarray:
    """The different values of ascending parts; ``np.unique`` would put them in a hash table."""
    if len(parts) == 1:
        return parts[0]
    values = np.concatenate(parts)
    values.sort()
    return values[np.r_[True, values[1:] != values[:-1]]]


def _exact_counts(h: np.ndarray, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(words):
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(words, h), len(words) - 1)
    return np.where(words[at] == h, counts[at], 0)
