"""BPE encoding and decoding with a given vocabulary.

A text is cut wherever no vocabulary token can reach across: between pieces of
the tokenizer's pattern, and inside a piece between any two bytes that stand
next to each other in no token. Fragments between cuts are merged on their own
and their ids put together again, so work is bounded by the longest fragment
and equal fragments are merged once.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

CACHE = 120_000  # chunks a worker remembers in each of two generations

# White space and letter pattern of the tokenizer.
SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _printable() -> dict[int, str]:
    """The character that stands for each byte in vocabulary files.

    Printable bytes of Latin-1 stand for themselves, the others in turn for the
    characters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class Vocabulary:
    """Ids, merge ranks and byte pairs of a vocabulary file, small enough to send along."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.of_byte = _printable()
        self.to_byte = {c: b for b, c in self.of_byte.items()}
        # Neighbours inside some token. Any other two bytes are a certain cut.
        self.pairs = {bare[i : i + 2] for bare in map(self.bare, self.ids) for i in range(len(bare) - 1)}
        self.texts = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}

    def bare(self, token: str) -> str:
        return token[: -len(self.end)] if token.endswith(self.end) else token


class Encoder:
    """Encodes and decodes texts; remembers pieces it has met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.known: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}
        self.known_pieces: dict[str, list[str]] = {}
        self.piece = regex.compile(PIECE)
        self.spaces = regex.compile(f"[{SPACE}]+")
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in vocabulary.special) + ")")
        # str.split() also splits at these four, which the tokenizer does not.
        self.odd = regex.compile("[\x1c-\x1f]")

    def fragments(self, piece: str) -> list[list[str]]:
        """The symbols of a piece, cut where no token holds both neighbours."""
        symbols = [self.v.of_byte[b] for b in piece.encode()]
        cut, out = 0, []
        for i in range(1, len(symbols)):
            if symbols[i - 1] + symbols[i] not in self.v.pairs:
                out.append(symbols[cut:i])
                cut = i
        out.append(symbols[cut:])
        out[-1][-1] += self.v.end
        return out

    def merged(self, symbols: list[str]) -> list[str]:
        """Join the pair of the lowest rank, the leftmost first, until none is left."""
        if len(symbols) > 64:
            return self._merged_long(symbols)
        rank, none = self.v.ranks.get, 1 << 60
        ranks = [rank(pair, none) for pair in zip(symbols, symbols[1:])]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank((symbols[at], symbols[at + 1]), none)
            if at:
                ranks[at - 1] = rank((symbols[at - 1], symbols[at]), none)
        return symbols

    def _merged_long(self, symbols: list[str]) -> list[str]:
        """The same with a heap of pairs, for fragments of any length."""
        import heapq

        rank, n = self.v.ranks.get, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := rank((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], alive[j], after[i] = left + right, False, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank((symbols[a], symbols[b]))) is not None:
                    heapq.heappush(heap, (r, a, symbols[a], symbols[b]))
        return [s for s, a in zip(symbols, alive) if a]

    def pieces(self, chunk: str) -> tuple[bytes, str]:
        """Ids (as bytes) and decoded tokens of a lower-case text without white space."""
        ids, texts = array("I"), []
        for piece in self.piece.findall(chunk):
            found = self.known_pieces.get(piece)
            if found is None:
                found = [token for fragment in self.fragments(piece) for token in self.merged(fragment)]
                if len(piece) <= 50:
                    self.known_pieces[piece] = found
            texts += found
        for token in texts:
            ids.append(self.v.ids[token])
        # Without a decoder the library joins tokens by blanks.
        return ids.tobytes(), " ".join(texts)

    def chunk(self, chunk: str) -> tuple[bytes, str]:
        """The same by way of what is remembered."""
        found = self.older.get(chunk) or self.pieces(chunk)
        if len(self.known) >= CACHE:
            self.known, self.older = {}, self.known
        if len(self.known_pieces) >= CACHE:
            self.known_pieces = {}
        if len(chunk) <= 100:
            self.known[chunk] = found
        return found

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit numbers, and the decoded text."""
        if "<|" in text and self.special.search(text):
            found = []
            for i, part in enumerate(self.special.split(text)):
                if i % 2:
                    found.append((array("I", [self.v.special[part]]).tobytes(), part))
                elif part:
                    found.append(self._plain(part))
            found = [f for f in found if f[0]]
            return b"".join(f[0] for f in found), " ".join(f[1] for f in found)
        return self._plain(text)

    def _plain(self, text: str) -> tuple[bytes, str]:
        text = unicodedata.normalize("NFC", text)
        # A sigma at a word's end stays plain, as lower case goes by characters.
        text = text.replace("\u03a3", "\u03c3").lower() if "\u03a3" in text else text.lower()
        words = self.spaces.split(text) if self.odd.search(text) else text.split()
        found = []
        for word in words:
            known = self.known.get(word) or (self.chunk(word) if word else None)
            if known and known[0]:
                found.append(known)
        return b"".join([f[0] for f in found]), " ".join([f[1] for f in found])


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text of ids: the tokens as they stand, joined by blanks.

    The tokenizer file names no decoder, so word ends stay marked and bytes stay
    written as their printable characters; unknown ids are left out.
    """
    return " ".join(vocabulary.texts[i] for i in ids if i in vocabulary.texts)


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def encode_documents(docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` and the decoded text of every document.

    ``path`` names the vocabulary file on the driver; the vocabulary (a fixed
    size, some MB) is broadcast. ``digests`` gives SHA-256 sums instead of ids
    and text. Null texts count as empty and give no tokens; repeated rows give
    repeated rows; further columns are left out. Nothing is shuffled, and a
    lost executor's splits are simply encoded again.
    """
    spark: SparkSession = docs.sparkSession
    sent = spark.sparkContext.broadcast(load_vocabulary(path))
    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")
    kinds = (pa.string(), pa.string()) if digests else (pa.list_(pa.int32()), pa.string())
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        sha = hashlib.sha256
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts, left, right = [], [], []
                for text in part.column(1).to_pylist():
                    ids, decoded = encoder.encode(text or "")
                    counts.append(len(ids) // 4)
                    left.append(sha(ids).hexdigest() if digests else array("i", ids))
                    right.append(sha(decoded.encode()).hexdigest() if digests else decoded)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(left, kinds[0]), pa.array(right, kinds[1])],
                    ["doc_id", "n_tokens", *names],
                )

    schema = f"doc_id {id_type}, n_tokens long, {names[0]} {'string' if digests else 'array<int>'}, {names[1]} string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
