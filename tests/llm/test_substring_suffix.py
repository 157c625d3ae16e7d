"""Removed words and bytes against brute force."""

import hashlib
from collections import Counter

import numpy as np

from lexvane.llm import sequences as seq
from lexvane.llm import substring_dedup, suffix_dedup
from lexvane.llm.suffix_dedup import Columns, insert_columns

LAST = (1 << 63) - 1


def expected_words(rows, n=50):
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    first = {}
    for i, w in split:
        for p in range(len(w) - n + 1):
            key = b" ".join(w[p : p + n])
            first[key] = min(first.get(key, LAST), LAST if i is None else i)
    out = []
    for i, w in split:
        gone = bytearray(len(w))
        for p in range(len(w) - n + 1):
            if first[b" ".join(w[p : p + n])] < (LAST if i is None else i):
                gone[p : p + n] = b"\1" * n
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def expected_bytes(rows, n=200):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    times = Counter(t[p : p + n] for _, t in texts for p in range(len(t) - n + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - n + 1):
            if times[t[p : p + n]] > 1:
                gone[p : p + n] = b"\1" * n
        kept = bytes(x for x, g in zip(t, gone) if not g)
        spans = sum(1 for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1]))
        out.append((i, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_words_equal_brute_force(docs, corpus):
    got = substring_dedup.remove_repeats(docs)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = expected_words(corpus)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(r[2] > 0 for r in want) > 15


def regular_words():
    """Two different long words of a kind that sums modulo a power of two take for equal."""
    places = [bin(i).count("1") % 2 for i in range(2048)]
    return "".join("ab"[p] for p in places), "".join("ba"[p] for p in places)


def test_regular_long_words_are_told_apart(spark):
    one, other = regular_words()
    common = [f"w{i}" for i in range(49)]
    rows = [(1, " ".join([*common, one])), (2, " ".join([*common, other])), (3, " ".join([*common, one]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, substring_dedup.remove_repeats(frame).collect()), key=repr) == expected_words(rows)
    assert sorted(map(tuple, suffix_dedup.remove_repeats(frame).collect()), key=repr) == expected_bytes(rows)
    held = seq.word_symbols([one.encode(), other.encode()]).values
    assert held[0] != held[1]


def test_hash_sums_are_exact():
    r = np.random.default_rng(4)
    symbols = r.integers(0, 1 << 63, 700).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    total, sums = 0, seq.prefix(symbols)
    for i, x in enumerate(symbols.tolist()):
        total = (total + x * pow(seq._BASE, i, seq._PRIME)) % seq._PRIME
        assert int(sums[i + 1]) == total


def test_bytes_equal_brute_force(docs, corpus):
    got = suffix_dedup.remove_repeats(docs)
    want = expected_bytes(corpus)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(r[2] > 0 for r in want) > 15


def test_kept_texts(docs, corpus):
    for r in substring_dedup.remove_repeats(docs, texts=True).collect():
        assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]
    for r in suffix_dedup.remove_repeats(docs, texts=True).collect():
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"]


def test_cut_texts_keeps_columns_and_clean_rows(docs, corpus):
    cut = substring_dedup.cut_texts(docs)
    assert cut.columns == docs.columns
    want = Counter()
    for i, t, *_ in corpus:
        n, removed = next((r[1], r[2]) for r in expected_words(corpus) if r[0] == i and r[1] == len((t or "").split()))
        if removed == 0:
            want[(i, t)] += 1
    got = Counter((r["doc_id"], r["text"]) for r in cut.collect())
    assert all(got[k] == v for k, v in want.items())
    assert not any(k[0] == 101 for k in got)


def test_cut_texts_needs_one_worker_in_a_task(docs):
    plan = substring_dedup.cut_texts(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("MapInArrow") == 1


def test_words_are_hashed_without_prefix_sums(monkeypatch):
    texts = [b"", b" a b\tlonger\x0b", b"x" * 32 + b" " + b"y" * 33, "Ünïcödé 中文".encode() + b"\xff", b"Z" * 9000 + b" end"]
    for table in (seq.BYTES, seq.LOWER_BYTES):
        buffer, begins, ends, bounds = seq.word_spans(texts)
        want = seq.run_hash(seq.prefix(table[buffer]), begins, ends - begins)
        got = seq.word_symbols(texts, table)
        assert (got.values == want).all() and (got.bounds == bounds).all()
    monkeypatch.setattr(seq, "prefix", None)  # of bytes; only words longer than LOOKED_UP need it
    assert len(seq.word_symbols(texts[:2]).values) == 3


def test_empty_tables(empty):
    assert substring_dedup.remove_repeats(empty).collect() == []
    assert suffix_dedup.remove_repeats(empty).collect() == []
    assert substring_dedup.cut_texts(empty).collect() == []


def test_column_insertion_finds_common_windows():
    r = np.random.default_rng(1)
    pieces = [r.integers(97, 99, 30, dtype=np.uint8) for _ in range(40)]
    for i in range(0, 40, 4):
        pieces[i + 1][5:25] = pieces[i][5:25]
    columns = Columns(30)
    columns.add([p.tobytes() for p in pieces[:25]], np.zeros(25, np.int64))
    columns.add([p.tobytes() for p in pieces[25:]], np.zeros(15, np.int64))
    found = insert_columns(columns, np.zeros(40, np.int64), 8, 23)
    for c in range(23):
        times = Counter(p[c : c + 8].tobytes() for p in pieces)
        assert [times[p[c : c + 8].tobytes()] > 1 for p in pieces] == found[:, c].tolist()


def test_run_hashes_depend_on_content_only():
    one, two = seq.byte_symbols([b"xxabcdefyy"]), seq.byte_symbols([b"abcdef", b"zabcdef"])
    a = seq.run_hash(seq.prefix(one.values), np.array([2]), np.array([6]))
    b = seq.run_hash(seq.prefix(two.values), np.array([0, 7]), np.array([6, 6]))
    assert a[0] == b[0] == b[1]


def test_anchors_are_shared_by_equal_windows():
    r = np.random.default_rng(2)
    shared = bytes(r.integers(97, 122, 80, dtype=np.uint8))
    texts = [bytes(r.integers(97, 122, n, dtype=np.uint8)) for n in (50, 61, 7)]
    some = seq.byte_symbols([texts[0] + shared, texts[1] + shared + texts[2]])
    found, _ = seq.anchors(some, seq.prefix(some.values), 40, 10)
    places = [set((found.place - some.bounds[found.text])[found.text == t].tolist()) for t in (0, 1)]
    inside = [{p - len(texts[t]) for p in places[t] if len(texts[t]) + 30 <= p <= len(texts[t]) + 40} for t in (0, 1)]
    assert inside[0] == inside[1]
    assert found.count.sum() == sum(max(0, int(b - a) - 39) for a, b in zip(some.bounds, some.bounds[1:]))
