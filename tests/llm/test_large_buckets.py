"""Buckets of many near copies that no hub ties together."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexvane.llm import minhash


def variants(count, words=120, most=6, seed=5):
    """One text, in every copy of which some words are others."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    rows = []
    for d in range(count):
        text = list(base)
        for at in rng.choice(words, rng.integers(2, most + 1), replace=False):
            text[at] = f"x{rng.integers(40)}"
        rows.append((d, " ".join(text)))
    return rows


def shingles(text, n=5):
    w = text.split(" ")
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def true_classes(rows, least):
    sets = [shingles(t) for _, t in rows]
    end = list(range(len(rows)))

    def root(i):
        while end[i] != i:
            i = end[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                end[b] = a
    return {rows[i][0]: rows[root(i)][0] for i in range(len(rows))}


@pytest.mark.parametrize("block", [1 << 18, 4096])
def test_large_buckets_make_no_pairs_and_lose_no_link(spark, monkeypatch, block):
    """All members of a bucket used to be joined with one another."""
    monkeypatch.setattr(minhash, "BLOCK", block, raising=False)
    rows, made, asked, across = variants(150), [], [], minhash._across

    def counted(open_):
        pairs = across(open_)
        made.append(pairs.count())
        asked.append(open_.count())
        return pairs

    monkeypatch.setattr(minhash, "_across", counted)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bands=60, rows=2).collect()
    want = true_classes(rows, minhash.SIMILARITY)
    assert 1 < len(set(want.values())) < len(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert made and all(m <= 4 * n for m, n in zip(made, asked))


def test_links_of_blocks_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    sets = [rng.choice(60, rng.integers(0, 40), replace=False) for _ in range(70)] + [np.arange(5000), np.arange(4500)]
    sets += [sets[0], np.array([], int)]
    group = rng.integers(0, 30, len(sets))
    flat, sizes = np.concatenate(sets).astype(np.int64), np.array([len(s) for s in sets])
    for least in (0.3, 0.5, 0.9):
        a, b = minhash.linked(flat, sizes, group, least)
        want = {
            (group[i], group[j])
            for i, x in enumerate(sets)
            for j, y in enumerate(sets)
            if group[i] < group[j] and len(set(x) & set(y)) >= least * len(set(x) | set(y))
        }
        assert set(zip(a.tolist(), b.tolist())) == want and want
    assert minhash.joined(np.array([4, 3, 1]), np.array([3, 2, 0]), 6).tolist() == [0, 0, 2, 2, 2, 5]


def test_block_comparison_is_exact_and_holds_little():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**62, 400)

    def drawn(count, shared, own):
        return [np.r_[rng.choice(common[:shared], shared - 9, replace=False), rng.integers(0, 2**62, own)] for _ in range(count)]

    few = drawn(300, 60, 3)
    sizes, group = np.array([len(x) for x in few]), np.arange(300)
    got = set(zip(*(x.tolist() for x in minhash.linked(np.concatenate(few), sizes, group, 0.7))))
    want = set()
    for i in range(300):
        for j in range(i + 1, 300):
            both = len(np.intersect1d(few[i], few[j]))
            if both >= 0.7 * (sizes[i] + sizes[j] - both):
                want.add((i, j))
    assert got == want and 0 < len(want) < 300 * 299 / 2

    many = drawn(2048, 209, 56)
    sets, sizes = np.concatenate(many), np.array([len(x) for x in many])
    tracemalloc.start()
    minhash.linked(sets, sizes, np.arange(2048), 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
