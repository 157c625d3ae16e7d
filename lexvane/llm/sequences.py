"""Hashing runs of bytes or words of many texts at once, with numpy inside tasks.

A hash of a run is a difference of prefix sums ``sum(symbol[i] * B**i)`` modulo
the prime 2**61 - 1, shifted back by a power of the inverse of ``B`` and mixed; so
every run of any length costs the same. (Modulo a power of two, two different
runs of a regular kind, the Thue-Morse sequence and its complement, are equal
whatever ``B`` and the symbols are.)
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20  # bytes of text worked on at once; a longer text is a chunk of its own

_PRIME = (1 << 61) - 1
_BASE = 0x1E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, _PRIME)
LOOKED_UP = 32  # bytes of a word, at most, whose products with powers are looked up
_tables: dict[bytes, np.ndarray] = {}
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a new array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_FOLD = np.arange(256)
_FOLD[65:91] += 32
LOWER_BYTES = BYTES[_FOLD]
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def _below(x: np.ndarray) -> np.ndarray:
    """Numbers modulo the prime."""
    x = (x & np.uint64(_PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(_PRIME), x - np.uint64(_PRIME), x)


def _times(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """Products modulo the prime, of factors below it, by halves of 32 bits."""
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    cross, least = a1 * b0 + a0 * b1, a0 * b0
    total = (a1 * b1 << np.uint64(3)) + (cross >> np.uint64(29))
    total += (cross & np.uint64((1 << 29) - 1)) << half
    total += (least >> np.uint64(61)) + (least & np.uint64(_PRIME))
    return _below(total)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK + 4096)
        for i, base in enumerate((_BASE, _INVERSE)):
            known = _powers[i]
            while len(known) < size:
                step = np.uint64(pow(base, len(known), _PRIME))
                known = np.concatenate([known, _times(known[: size - len(known)], step)])
            _powers[i] = known
    return _powers[0], _powers[1]


def prefix(symbols: np.ndarray) -> np.ndarray:
    n = len(symbols)
    terms = _times(_below(symbols), _power(n + 1)[0][:n])
    # Sums of the upper and of the lower bits cannot overflow below 2**32 symbols.
    upper, lower = np.cumsum(terms >> np.uint64(32)), np.cumsum(terms & np.uint64(0xFFFFFFFF))
    sums = np.zeros(n + 1, np.uint64)
    sums[1:] = _below(
        (upper >> np.uint64(29)) + ((upper & np.uint64((1 << 29) - 1)) << np.uint64(32)) + _below(lower)
    )
    return sums


def run_hash(sums: np.ndarray, start: np.ndarray, length: np.ndarray | int, salt: int = 0) -> np.ndarray:
    """Hashes of the runs ``[start, start + length)``."""
    parts = _below(sums[start + length] + np.uint64(_PRIME) - sums[start])
    return mix(_times(parts, _power(len(sums))[1][start]) + np.uint64(salt))


def all_runs(sums: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the runs of one length at every place."""
    n = len(sums) - length
    parts = _below(sums[length:] + np.uint64(_PRIME) - sums[:n])
    return mix(_times(parts, _power(len(sums))[1][:n]))


class Symbols(NamedTuple):
    """The symbols of some texts one after the other; text i has ``[bounds[i], bounds[i+1])``."""

    values: np.ndarray
    bounds: np.ndarray


def byte_symbols(texts: list[bytes], table: np.ndarray = BYTES) -> Symbols:
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return Symbols(table[buffer], bounds)


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined bytes, begins and ends of words in them, and word bounds of texts."""
    buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    gap = SPACE[buffer]
    edge = np.flatnonzero(np.diff(gap.astype(np.int8), prepend=1))
    begins, ends = edge[0::2], edge[1::2]
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return buffer, begins, ends, np.searchsorted(begins, at)


def word_symbols(texts: list[bytes], table: np.ndarray = BYTES) -> Symbols:
    """A 64-bit hash for each word, ``run_hash`` of its bytes.

    A word's sum begins with the power 0, so products of all bytes with the first
    powers are looked up: no prefix sums over the text. Only words longer than that
    go through ``prefix``, on their own.
    """
    buffer, begins, ends, bounds = word_spans(texts)
    sizes = ends - begins
    order = np.argsort(-np.minimum(sizes, LOOKED_UP + 1).astype(np.int8), kind="stable")  # the longest first
    # So many words, in this order, have a byte at each place.
    alive = len(sizes) - np.cumsum(np.bincount(np.minimum(sizes, LOOKED_UP), minlength=LOOKED_UP + 1))
    products, at, sums = _products(table), begins[order], np.zeros(len(sizes), np.uint64)
    for i, n in enumerate(alive[:LOOKED_UP].tolist()):
        if not n:
            break
        sums[:n] += products[i][buffer[at[:n]]]
        at[:n] += 1
        if i % 6 == 5:  # seven numbers below the prime stay below 2**64
            sums[:n] = _below(sums[:n])
    values = np.empty_like(sums)
    values[order] = mix(_below(sums))
    long = np.flatnonzero(sizes > LOOKED_UP)
    if len(long):
        some = byte_symbols([buffer[x:y].tobytes() for x, y in zip(begins[long].tolist(), ends[long].tolist())], table)
        values[long] = run_hash(prefix(some.values), some.bounds[:-1], sizes[long])
    return Symbols(values, bounds)


def _products(table: np.ndarray) -> np.ndarray:
    """The products of every byte's symbol with the first powers."""
    key = table.tobytes()
    if key not in _tables:
        symbols = _below(table)
        _tables[key] = np.stack([_times(symbols, p) for p in _power(LOOKED_UP)[0][:LOOKED_UP]])
    return _tables[key]


def kept_words(text: bytes, keep: np.ndarray) -> bytes:
    """The words of a text for which ``keep`` holds, joined by one space."""
    return b" ".join([w for w, k in zip(text.split(), keep.tolist()) if k])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Anchors(NamedTuple):
    """Marks in texts such that equal windows of ``n`` symbols have equal marks.

    ``place`` is where a mark's run of ``k`` symbols begins (counted through all
    texts), ``text`` the number of its text; the ``count`` windows that chose it
    begin at ``first`` and after.
    """

    text: np.ndarray
    place: np.ndarray
    first: np.ndarray
    count: np.ndarray


def anchors(symbols: Symbols, sums: np.ndarray, n: int, k: int) -> tuple[Anchors, np.ndarray]:
    """The marks of all windows of ``n`` symbols, and the hash of each run of ``k``.

    Every window chooses the run of ``k`` symbols in it with the smallest hash,
    the leftmost of equal ones, which depends on nothing but its content.
    """
    total, bounds = len(symbols.values), symbols.bounds
    none = np.zeros(0, np.int64)
    if total < n:
        return Anchors(none, none, none, none), np.zeros(0, np.uint64)
    runs = all_runs(sums, k)
    packed = (runs & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(runs), dtype=np.uint64)
    chosen = (sliding_min(packed, n - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    starts = np.flatnonzero(ends[: len(chosen)] >= np.arange(n, len(chosen) + n))
    chosen = chosen[starts]
    if not len(starts):
        return Anchors(none, none, none, none), runs
    # A new mark begins where the choice or (by a jump of starts) the text changes.
    new = np.flatnonzero(np.r_[True, (np.diff(chosen) != 0) | (np.diff(starts) != 1)])
    place, first = chosen[new], starts[new]
    count = np.diff(np.r_[new, len(chosen)])
    return Anchors(np.searchsorted(bounds, first, side="right") - 1, place, first, count), runs


def text_chunks(texts: list[bytes], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together."""
    return _chunks([len(t) for t in texts], most)


def column_chunks(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """The same ranges for a column of strings, of which none is unpacked."""
    return _chunks(pc.fill_null(pc.binary_length(column), 0).to_pylist(), most)


def _chunks(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, n in enumerate(sizes):
        if i > at and size + n > most:
            yield at, i
            at, size = i, 0
        size += n + 1
    if at < len(sizes):
        yield at, len(sizes)


def parts(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that fewer texts are unpacked at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of the texts; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from values that lie in order, ``counts`` of them a row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    if values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def covered(length: int, starts: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Which of ``length`` symbols lie in windows of ``n`` beginning in these ranges."""
    edge = np.zeros(length + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + counts + n - 1, length), -1)
    return np.cumsum(edge[:-1]) > 0
