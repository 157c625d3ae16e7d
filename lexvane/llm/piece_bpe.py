"""SentencePiece BPE by merge rounds over flat numpy arrays.

The text is cut before every run of blank marks, which no piece reaches across
from the left, so each word can be merged alone. All words a worker has not met
yet lie in one flat array of symbols. A round finds, with one segmented minimum,
the best pair of each word, joins all its places from the left at once, and
compacts the array; words without a pair leave it. Joining at once equals joining
one by one as long as no new pair is as good as the joined one; a word where that
would happen joins its leftmost place only in that round.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

REMEMBERED = 120_000  # words a worker remembers in each of two generations
CHUNK = 1 << 20  # characters of text whose new words are merged together
BLANK = "▁"
_NONE = np.int32(2**31 - 1)

# Kinds of pieces in a model file, and the text of an unknown piece.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_TEXT = " ⁇ "


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Numbers and contents of the fields of a serialized message."""
    at = 0

    def number() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = number() if kind == 2 else 4 if kind == 5 else 8
        yield tag >> 3, data[at : at + size]
        at += size


class PieceModel:
    """Pieces, pairs that join, and bytes of a model file; a fixed size, some MB."""

    def __init__(self, data: bytes) -> None:
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        for field, value in _fields(data):
            if field == 1:
                piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0])
                self.kinds.append(piece[3])
        ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, USER_DEFINED, UNUSED)}
        if any(BLANK in p.lstrip(BLANK) for p in ids):
            raise ValueError("a piece reaches across a word's end")
        order = {s: r for r, s in enumerate(sorted({-scores[i] for i in ids.values()}))}
        # Equal scores share a rank, the best has rank 0.
        self.rank = np.array([order.get(-s, 0) for s in scores], np.int32)
        self.of_byte = {int(self.pieces[i][3:5], 16): i for i, k in enumerate(self.kinds) if k == BYTE}
        self.byte_of = {i: b for b, i in self.of_byte.items()}
        self.digits = [str(i) for i in range(len(self.pieces))]
        texts = {CONTROL: "", UNKNOWN: UNKNOWN_TEXT}
        spaced = (texts.get(k, p.replace(BLANK, " ")) for p, k in zip(self.pieces, self.kinds))
        self.texts = {i: t for i, t in enumerate(spaced) if self.kinds[i] != BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        self.symbol = np.full(0x110000, -1, np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        joins = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    joins[left << 32 | right] = i
        if any(c not in ids for p in ids for c in p):
            raise ValueError("a piece holds a character that is no piece")
        self.keys = np.array(sorted(joins), np.int64)
        self.joined = np.array([joins[k] for k in sorted(joins)], np.int32)
        self.words = re.compile(f"{BLANK}+[^{BLANK}]*")
        longest = max((len(p) for p in ids if not p.strip(BLANK)), default=1)
        if longest > 1 and self._runs_split(longest):
            self.words = re.compile(f"{BLANK}{{{longest}}}(?={BLANK})|{BLANK}+[^{BLANK}]*")

    def _runs_split(self, n: int) -> bool:
        """Whether runs of blank marks may be cut every ``n`` marks from the left.

        They may if blanks join each other later than all else, all equally
        late, and runs cut that way give what whole runs give.
        """
        own = [i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if len(p) > 1 and not p.strip(BLANK) and k == NORMAL]
        if {int(self.rank[i]) for i in own} != {int(self.rank.max())}:
            return False
        if any(p.startswith(BLANK * 2) and p.strip(BLANK) for p in self.pieces):
            return False
        whole = self.merged([BLANK * (n * c + r) for c in (1, 2) for r in range(n + 1)])
        rest = self.merged([BLANK * max(r, 1) for r in range(n + 1)])
        first = self.merged([BLANK * n])[0]
        at = [(c, r) for c in (1, 2) for r in range(n + 1)]
        return all(w == first * c + (rest[r] if r else []) for w, (c, r) in zip(whole, at))

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols join to, -1 for none."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.joined[at], np.int32(-1))

    def rank_of(self, piece: np.ndarray) -> np.ndarray:
        return np.where(piece >= 0, self.rank[piece], _NONE)

    def merged(self, words: list[str]) -> list[list[int]]:
        """Ids of each word; characters without a piece become their bytes."""
        symbol, sizes = self.symbols(words)
        listed, ends = symbol.tolist(), np.cumsum(sizes).tolist()
        parts = [listed[a:b] for a, b in zip([0, *ends], ends)]
        return [self.with_bytes(p) for p in parts] if (symbol < 0).any() else parts

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all words one after the other, and how many each word has; ``-1 - c``: character ``c`` has none."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        known = self.symbol[points]
        symbol = np.where(known >= 0, known, -1 - points.astype(np.int32))
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        to = np.full(len(symbol), -1, np.int32)
        if len(symbol) > 1:
            to[:-1] = np.where(word[1:] == word[:-1], self.join(symbol[:-1], symbol[1:]), np.int32(-1))
        rank = self.rank_of(to)
        done_words, done_symbols = [], []
        while len(symbol):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(word)]))
            finished = best == _NONE
            if finished.any():
                done_words.append(word[finished])
                done_symbols.append(symbol[finished])
            chosen = self._leftmost(symbol, word, to, rank, best)
            symbol[chosen] = to[chosen]
            keep = ~finished
            keep[chosen + 1] = False
            place = np.cumsum(keep) - 1
            symbol, word, to, rank = symbol[keep], word[keep], to[keep], rank[keep]
            touched = np.zeros(len(symbol) + 1, bool)
            touched[place[chosen]] = touched[place[chosen] - 1] = True
            changed = np.flatnonzero(touched[:-1])
            after = np.minimum(changed + 1, len(symbol) - 1)
            same = (after > changed) & (word[after] == word[changed])
            to[changed] = np.where(same, self.join(symbol[changed], symbol[after]), np.int32(-1))
            rank[changed] = self.rank_of(to[changed])
        if not done_words:
            return symbol, np.zeros(len(words), np.int64)
        word, symbol = np.concatenate(done_words), np.concatenate(done_symbols)
        return symbol[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def _leftmost(self, symbol, word, to, rank, best) -> np.ndarray:
        """Places of the best pair of each word that are joined in this round."""
        hits = np.flatnonzero((rank == best) & (rank != _NONE))
        if not len(hits):
            return hits
        # Of places that overlap, every second one from the left.
        number = np.arange(len(hits))
        first = np.maximum.accumulate(np.where(np.diff(hits, prepend=-2) > 1, number, 0))
        chosen = hits[(number - first) % 2 == 0]
        owner = word[chosen]
        again = owner[1:] == owner[:-1]
        if not again.any():
            return chosen
        new, here = to[chosen], rank[chosen]
        last = len(symbol) - 1
        before, after = np.maximum(chosen - 1, 0), np.minimum(chosen + 2, last)
        left = np.where((chosen > 0) & (word[before] == owner), self.join(symbol[before], new), np.int32(-1))
        right = np.where((chosen + 2 <= last) & (word[after] == owner), self.join(new, symbol[after]), np.int32(-1))
        early = (self.rank_of(left) <= here) | (self.rank_of(right) <= here)
        touching = again & (np.diff(chosen) == 2)
        early[1:] |= touching & (self.rank_of(self.join(new[:-1], new[1:])) <= here[1:])
        early[1:] |= again & (new[1:] != new[:-1])
        if early.any():
            later = np.r_[False, again]
            chosen = chosen[~(later & np.isin(owner, owner[early]))]
        return chosen

    def with_bytes(self, symbols: list[int]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            out += [s] if s >= 0 else [self.of_byte.get(b, self.unknown) for b in chr(-1 - s).encode()]
        return out

    def surface(self, ids: list[int]) -> str:
        """The text of ids with the first blank left in; runs of bytes are read as UTF-8."""
        texts = self.texts
        try:
            return "".join([texts[i] for i in ids])
        except KeyError:
            return self._surface_with_bytes(ids)

    def _surface_with_bytes(self, ids: list[int]) -> str:
        out, waiting = [], bytearray()

        def flush() -> None:
            # Bytes that are no UTF-8 become one replacement character each.
            text = waiting.decode("utf-8", "surrogateescape")
            out.append(re.sub("[\udc80-\udcff]", "�", text))
            waiting.clear()

        for i in ids:
            if i in self.byte_of:
                waiting.append(self.byte_of[i])
                continue
            flush()
            out.append(self.texts[i])
        flush()
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the blank that encoding puts in front."""
        marked = next((i for i in ids if self.kinds[i] != CONTROL), None)
        text = self.surface(ids)
        begins = marked is not None and self.kinds[marked] != BYTE and self.pieces[marked].startswith(BLANK)
        return text[1:] if begins else text


class PieceEncoder:
    """Encodes texts; remembers the ids (as decimal text) of words it has met.

    Words are named without the blank mark in front. ``other`` has the texts of
    the words that are not decoded to themselves.
    """

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.other: dict[str, str] = {}
        # Decimal ids as they stand inside a word, then as they end one; texts of pieces and their lengths.
        self.ended = np.array([d + "," for d in model.digits] + [d + "\n" for d in model.digits], object)
        self.texts = np.array([model.texts.get(i, "") for i in range(len(model.digits))], object)
        self.lengths = np.fromiter(map(len, self.texts), np.int64, len(self.texts))

    def encode(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """Number of ids, ids joined by commas, and decoded text of each text."""
        at, size = 0, 0
        for i, text in enumerate(texts):
            if i > at and size + len(text) > CHUNK:
                yield from self._chunk(texts[at:i])
                at, size = i, 0
            size += len(text)
        yield from self._chunk(texts[at:])

    def _words(self, text: str) -> list[str]:
        """Single blanks part words; runs of blanks, a blank in front and blank marks are parted by the model."""
        if not text:
            return []
        if text[0] == " " or "  " in text or BLANK in text:
            return [w[1:] for w in self.model.words.findall(BLANK + text.replace(" ", BLANK))]
        return text.split(" ")

    def _learn(self, met: set[str]) -> list[str]:
        """Ids of all these words are known afterwards; the words not to be remembered."""
        new = []
        for w in met.difference(self.known):
            ids = self.older.get(w)
            if ids is None:
                new.append(w)
            else:
                self.known[w] = ids
        if not new:
            return []
        symbol, sizes = self.model.symbols([BLANK + w for w in new])
        last = np.cumsum(sizes) - 1
        bare = symbol < 0
        piece = np.where(bare, 0, symbol)
        texts, lengths = self.texts[piece], self.lengths[piece]
        piece[last] += len(self.lengths)
        self.known.update(zip(new, "".join(self.ended[piece].tolist()).split("\n")))
        # All texts at once: equal as a whole and of equal lengths, each is equal to its word.
        texts[bare] = [chr(-1 - s) for s in symbol[bare].tolist()]
        lengths[bare] = 1
        odd = np.add.reduceat(bare, last - sizes + 1) > 0
        if "".join(texts.tolist()) != (" " + " ".join(new)).replace(BLANK, " "):
            odd[:] = True
        odd |= np.add.reduceat(lengths, last - sizes + 1) != np.fromiter(map(len, new), np.int64, len(new)) + 1
        for i in np.flatnonzero(odd).tolist():
            ids = self.model.with_bytes(symbol[last[i] - sizes[i] + 1 : last[i] + 1].tolist())
            self.known[new[i]] = ",".join([self.model.digits[s] for s in ids])
            text = self.model.surface(ids)
            if text != " " + new[i].replace(BLANK, " "):
                self.other[new[i]] = text
        return [w for w in new if len(w) >= 64]

    def _chunk(self, texts: list[str]) -> list[tuple[int, str, str]]:
        cut = [self._words(t) for t in texts]
        met = set().union(*cut)
        long = self._learn(met)
        ids_of, other = self.known.__getitem__, self.other
        same = not other or met.isdisjoint(other)
        out = []
        for text, words in zip(texts, cut):
            ids = ",".join(map(ids_of, words))
            if same:
                text = text.replace(BLANK, " ")
            else:
                text = "".join([other[w] if w in other else " " + w.replace(BLANK, " ") for w in words])[1:]
            out.append((ids.count(",") + 1 if ids else 0, ids, text))
        for w in long:
            del self.known[w]
            other.pop(w, None)
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
            self.other = {w: t for w, t in other.items() if w in self.older}
        return out


def load_model(path: str) -> PieceModel:
    with open(path, "rb") as file:
        return PieceModel(file.read())


def encode_documents(docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` and the decoded text of every document.

    ``path`` names the model file on the driver; the tables made of it (a fixed
    size, some MB) are broadcast. ``digests`` gives SHA-256 sums
    (of the decimal ids joined by commas, and of the text) instead of ids and
    text. Null texts count as empty and give no ids; blanks and very long words
    are encoded like all else; repeated rows give repeated rows; further columns
    are left out; an empty table stays empty. Nothing is shuffled, and a lost
    executor's splits are simply encoded again.
    """
    spark: SparkSession = docs.sparkSession
    sent = spark.sparkContext.broadcast(load_model(path))
    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")
    kind = pa.string() if digests else pa.list_(pa.int32())
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def listed(ids: str) -> list[int]:
        return list(map(int, ids.split(","))) if ids else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sha = PieceEncoder(sent.value), hashlib.sha256
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                counts, left, right = [], [], []
                for n, ids, decoded in encoder.encode([t or "" for t in part.column(1).to_pylist()]):
                    counts.append(n)
                    left.append(sha(ids.encode()).hexdigest() if digests else listed(ids))
                    right.append(sha(decoded.encode()).hexdigest() if digests else decoded)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(left, kind), pa.array(right, pa.string())],
                    ["doc_id", "n_tokens", *names],
                )

    schema = f"doc_id {id_type}, n_tokens long, {names[0]} {'string' if digests else 'array<int>'}, {names[1]} string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_documents(tokens: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids``; null lists give an empty text."""
    spark: SparkSession = tokens.sparkSession
    sent = spark.sparkContext.broadcast(load_model(path))
    id_type = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = [model.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {id_type}, text string")
