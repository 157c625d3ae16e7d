"""Near-duplicate operators against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from lexvane.llm import embedding_dedup, minhash
from lexvane.llm import sequences as seq
from lexvane.llm.components import components


def classes_of(links, nodes):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text, n=5):
    w = (text or "").split()
    return Counter(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else Counter()


def similarity(a, b):
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared) if shared else 0.0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 102), (7, 7), (200, 300), (250, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for link in links for n in link}
    assert got == classes_of(links, nodes)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_documents_equal_brute_force(docs, corpus):
    sets = defaultdict(list)
    for i, text, *_ in corpus:
        if i is not None:
            sets[i].append(shingles(text))
    ids = sorted(sets)
    links = [
        (a, b)
        for x, a in enumerate(ids)
        for b in ids[x + 1 :]
        if any(similarity(p, q) >= 0.8 for p in sets[a] for q in sets[b])
    ]
    want = classes_of(links, ids)
    assert len(set(want.values())) < len(want) - 10
    rows = minhash.near_duplicates(docs).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        assert r["class_id"] == want.get(r["doc_id"]) and r["kept"] == (r["class_id"] == r["doc_id"] or r["doc_id"] is None)


def test_large_group_without_all_pairs(spark):
    """Copies that are near one original but not near each other make one class."""
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in range(3):
            w[(i * 3 + j) % 60 * 3 + 5] = f"x{i}"
        rows.append((i + 1, " ".join(w)))
    rows.append((0, " ".join(base)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in got} == {0}


def test_no_documents(empty):
    assert minhash.near_duplicates(empty).collect() == []


def test_dart_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(3)
    k = 512
    element = seq.mix(np.arange(300, dtype=np.uint64))
    a, b = r.uniform(0.2, 3.0, 300), r.uniform(0.2, 3.0, 300)
    b[:150] = a[:150]
    text = np.repeat([0, 1], 300)
    sig = minhash.dart_signatures(text, np.r_[element, element], np.r_[a, b], 2, k)
    assert (sig != 0).all()
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / k)


def test_dart_signatures_of_different_sizes():
    element = seq.mix(np.arange(2000, dtype=np.uint64))
    text = np.r_[np.zeros(2000, int), np.ones(1000, int)]
    sig = minhash.dart_signatures(text, np.r_[element, element[:1000]], np.ones(3000), 3, 256)
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.13
    assert (sig[2] == 0).all()


def vectors():
    r = np.random.default_rng(5)
    rows, number = [], 0
    for label in (0, 1, 2):
        for _ in range(25):
            centre = r.normal(size=24)
            for _ in range(r.integers(1, 5)):
                noise = centre + r.normal(size=24) * r.choice([0.05, 0.2, 0.28])
                rows.append((number, [float(np.float32(x)) for x in noise], label))
                number += 1
    rows += [(number + i, rows[0][1], 0) for i in range(30)]  # a hot vector
    number += 30
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [None] * 24, [float("inf")] * 24, rows[0][1]]
    rows += [(number + i, v, 0 if i < 6 else None) for i, v in enumerate(odd)]
    rows += [(number + 20, rows[1][1][:12], 0), (None, rows[0][1], 0), (3, rows[3][1], rows[3][2])]
    return rows


def test_vectors_equal_brute_force(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame = frame.selectExpr("*", "1 as node", "2 as component", "3 as rep")

    def usable(row):
        i, v, label = row
        return i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, np.float64), label) for i, v, label in filter(usable, rows)]
    links, counts = [], Counter()
    for x, (i, v, label) in enumerate(good):
        for j, w, other in good[x + 1 :]:
            if label == other and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                counts[x] += 1
                links.append((i, j))
    degree = Counter()
    for i, v, label in good:
        degree[i] = sum(
            1
            for j, w, other in good
            if label == other and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93
        ) - 1
    want = classes_of(links, {r[0] for r in rows if r[0] is not None})
    got = embedding_dedup.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    found = sum(r["n_links"] for r in got)
    assert found >= 0.97 * sum(degree[i] for i, *_ in good)
    for r in got:
        assert r["n_links"] <= degree[r["vec_id"]]
    same = sum(r["component_id"] == want.get(r["vec_id"]) for r in got)
    assert same >= 0.97 * len(got)
    for r in got:
        assert r["kept"] == (r["component_id"] == r["vec_id"] or r["vec_id"] is None)


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(frame).collect() == []


def test_recall_on_given_vectors(spark):
    """Links found against all pairs of the given table."""
    path = "/root/testdata/sf0.1/embeddings.parquet"
    try:
        rows = spark.read.parquet(path).collect()
    except Exception:
        pytest.skip("no given tables here")
    ids = [r["vec_id"] for r in rows]
    x = np.array([r["embedding"] for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r["label"] for r in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label)
    want = dict(zip(ids, near.sum(axis=1) - 1))
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(spark.read.parquet(path)).collect()}
    assert sum(got.values()) >= 0.9 * sum(want.values())
    assert all(got[i] <= want[i] for i in ids)


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 32))
    y = embedding_dedup.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
    assert np.allclose(embedding_dedup.hadamard(y), x)
