"""SentencePiece encoding, ranked search and the Merkle manifest against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexvane.llm import merkle, piece_bpe, ranked_search

# -- pieces ----------------------------------------------------------------------

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piece_bpe.load_model(PATH)


def odd_texts():
    r = random.Random(11)
    letters = "aaabbeeinothrst   ▁\t\n\x00é日本語𝔘�ABC.,'<s>0019"
    parts = ["the", "an", "in", "ing", "tion", "th", "yo", "you", "that", "▁", "  ", "at", "hat"]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 120))) for _ in range(3000)]
    texts += ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    texts += [" " * n + w for n in range(70) for w in ("", "a", "日", "𝔘x")]
    texts += ["a" * n for n in range(100)] + ["the" * n for n in range(60)]
    texts += [" " * 5000, "ab" * 3000, "".join(r.choice("abcdefgh0123ABCD") for _ in range(5000)), "日本" * 2000]
    return texts


def test_pieces_equal_the_library(model, library):
    texts = odd_texts()
    for text, want, got in zip(texts, library.encode(texts), piece_bpe.PieceEncoder(model).encode(texts)):
        assert got == (len(want), ",".join(map(str, want)), library.decode(want))
        assert model.decode(want) == got[2]


def test_every_character(model, library):
    texts = [f"x{chr(c)}y" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 13 == 0)]
    want = [",".join(map(str, ids)) for ids in library.encode(texts)]
    assert [g[1] for g in piece_bpe.PieceEncoder(model).encode(texts)] == want


def test_any_ids_decode_like_the_library(model, library):
    r = random.Random(5)
    for _ in range(2000):
        ids = [r.choice([0, 1, 2, 3, 200, 250, 190, 191, 259, 260, 264, 300, 28705]) for _ in range(6)]
        assert model.decode(ids) == library.decode(ids)


def test_plain_words_are_not_decoded_one_by_one(model, library, monkeypatch):
    texts = ["plain words, again\nand more words ", "Wörter  mit 𝔘 \x00", "words"]
    decoded, surface = [], model.surface
    monkeypatch.setattr(model, "surface", lambda ids: decoded.append(ids) or surface(ids))
    got = list(piece_bpe.PieceEncoder(model).encode(texts))
    assert [g[1:] for g in got] == [(",".join(map(str, i)), library.decode(i)) for i in library.encode(texts)]
    assert len(decoded) == 3  # the words with characters that have no piece


def test_small_memory_changes_nothing(model, library, monkeypatch):
    monkeypatch.setattr(piece_bpe, "REMEMBERED", 3)
    monkeypatch.setattr(piece_bpe, "CHUNK", 10)
    texts = odd_texts()[:500]
    assert [g[1] for g in piece_bpe.PieceEncoder(model).encode(texts)] == [",".join(map(str, i)) for i in library.encode(texts)]


def test_piece_documents(docs, corpus, library, empty):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for i, text, *_ in corpus:
        ids = library.encode(text or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    got = piece_bpe.encode_documents(docs, PATH, digests=True).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    plain = piece_bpe.encode_documents(docs, PATH)
    assert all(library.encode(r["decoded"]) == r["ids"] and r["n_tokens"] == len(r["ids"]) for r in plain.collect())
    back = piece_bpe.decode_documents(plain, PATH)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted([(i, t or "") for i, t, *_ in corpus], key=repr)
    assert piece_bpe.encode_documents(empty, PATH).collect() == []


# -- ranked search -----------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def ranked(items, docs, best=20):
    found = [(d, TERM.findall(folded(t))) for d, t in docs]
    n_docs, total = sum(1 for _, t in found if t), sum(len(t) for _, t in found)
    df = Counter(x for _, t in found for x in set(t))
    out = []
    for item, text in items:
        asked, scores = Counter(TERM.findall(folded(text))), []
        for doc, terms in found:
            score, tf = 0, Counter(terms)
            longer = 75 + 25 * len(terms) * n_docs // total
            for x, k in asked.items():
                if tf[x]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    score += k * weight * (10**9 * tf[x] // (1000 * tf[x] + 12 * longer))
            if score:
                scores.append((-score, doc is None, doc))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:best], 1)]
    return out


ITEMS = [
    (1, "w1 w2 w3 W4 w4"),
    (2, None),
    (3, ""),
    (4, "nothing-like-this"),
    (5, "one TWO three ... ünïcödé 中文 ÜNÏ"),
    (6, "ha ha"),
    (7, "w5 nobody"),
    (None, "w7 w8"),
    (7, "w9"),
]


@pytest.mark.parametrize("block, bundle, sent", [(4096, 64, 1 << 24), (7, 2, 1 << 24), (16, 3, 0)])
def test_search(spark, docs, corpus, monkeypatch, block, bundle, sent):
    for name, value in (("BLOCK", block), ("BUNDLE", bundle), ("SENT_BYTES", sent)):
        monkeypatch.setattr(ranked_search, name, value)
    items = spark.createDataFrame([(*i, 1, "x") for i in ITEMS], "item_id long, text string, item long, term string")
    got = ranked_search.search(items, docs, 10)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(ranked(ITEMS, [c[:2] for c in corpus], 10), key=repr)


def test_search_of_nothing(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search.search(items, empty).collect() == []
    assert ranked_search.search(items, docs.filter("text is null")).collect() == []
    assert ranked_search.search(items.limit(0), docs).collect() == []
    assert ranked_search.search(items.filter("item_id = 4"), docs).collect() == []


def test_a_term_of_all_documents_is_spread(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK", 50)
    rows = [(i, "common " + "x " * (i % 7) + ("rare" if i % 400 == 3 else "")) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(1, "common rare"), (2, "common")], "item_id long, text string")
    got = sorted(map(tuple, ranked_search.search(items, docs).collect()))
    assert got == sorted(ranked([(1, "common rare"), (2, "common")], rows))


# -- Merkle manifest --------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + arity]) for i in range(0, len(below), arity)])
    return levels


def path_of(levels, i, arity):
    path = []
    for level in levels[:-1]:
        run = level[i // arity * arity :][:arity]
        path.append((run[: i % arity], run[i % arity + 1 :]))
        i //= arity
    return path


def manifest_of(rows, change, arity):
    """Plain version over rows ``(doc_id, source, lang, n_chars, text)``."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees[name] = ordered, levels_of([leaf_of(*r) for r in ordered], arity)
    top = levels_of([trees[n][1][-1][0] for n in names], arity)
    out = []
    for j, name in enumerate(names):
        ordered, levels = trees[name]
        for i, r in enumerate(ordered):
            path = path_of(levels, i, arity) + path_of(top, j, arity)
            node = leaf_of(*r[:4], change(r))
            for before, after in path:
                node = h(*before, node, *after)
            proof = "".join(d for before, after in path for d in before + after)
            out.append((r[0], leaf_of(*r), levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


@pytest.mark.parametrize("arity", [2, 16])
def test_manifest(docs, corpus, arity):
    def change(row):
        chosen = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
        return row[4].upper() if chosen and row[4] is not None else row[4]

    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.verify(docs, {"text": F.when(chosen, F.upper("text")).otherwise(F.col("text"))}, arity)
    rows = [(i, source, lang, len(text or ""), text) for i, text, lang, source in corpus]
    # Python and Spark agree on upper case but for a few letters.
    want = manifest_of([(*r[:4], r[4]) for r in rows], change, arity)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_trees_of_all_sizes(spark):
    sizes = [1, 2, 15, 16, 17, 256, 257, 300]
    rows = [(i * 1000 + j, f"s{i}", None, j, "") for i, n in enumerate(sizes) for j in range(n)]
    rows += [(5, None, "", None, "A"), (5, "", "", None, "A"), (5, "", "", None, "A")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    got = merkle.verify(docs)
    want = manifest_of(rows, lambda r: r[4], 16)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert all(r["verified"] for r in got.select("verified").collect())


def test_one_row_and_none(docs, empty):
    one = merkle.verify(docs.filter("doc_id = 300")).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["proof"] == ""
    assert merkle.verify(empty).collect() == []


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_a_level_is_joined_once_for_each_doubling(spark, arity):
    """A level was joined with itself once for each slot, fifteen times at once, all sent through the driver."""
    rows = [("a", i, n, f"{n}-{i}") for n in (40,) for i in range(n)] + [("b", i, 3, f"b{i}") for i in range(3)]
    nodes = spark.createDataFrame(rows, "tree string, idx long, n long, digest string")
    runs = merkle._runs(nodes, arity)
    assert runs._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    got = {(r["tree"], r["idx"]): (r["n"], list(r["digests"])) for r in runs.collect()}
    want = {}
    for tree, i, n, d in rows:
        want.setdefault((tree, i // arity), (-(-n // arity), []))[1].append(d)
    assert got == want
