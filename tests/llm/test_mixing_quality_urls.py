"""Source mixing, quality rules and URL filters."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexvane.llm import mixing, quality, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """The sharing rule, step by step."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, open_, target = sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    while open_:
        rest = total - sum(target[s] for s in names if s not in open_)
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        for s in over or open_:
            target[s] = 3.0 * sizes[s] if s in over else share[s]
        if not over:
            break
        open_ -= over
    return target


def test_targets_and_takes(docs, corpus):
    sizes = Counter()
    for _, text, _, source in corpus:
        sizes[source] += len(WORD.findall(text or ""))
    want = targets(sizes)
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(corpus)
    taken = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == sum(t["words"] for t in r["takes"])
        taken[r["source"]] += r["taken"]
    for source, words in taken.items():
        assert abs(words - want[source]) < 1.001
    assert Counter((r["doc_id"], r["taken"]) for r in rows) == Counter(
        (r["doc_id"], r["taken"]) for r in mixing.mix_sources(docs.repartition(5)).collect()
    )


def test_some_targets_are_capped(spark):
    rows = [(i, "a b c d", "big") for i in range(100)] + [(200, "x y", "a"), (201, "", "c"), (202, "z " * 9, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {"a": 2, "big": 400, "c": 0, None: 9}
    want = targets(sizes)
    got = {r["source"]: r["target"] for r in mixing.mix_sources(frame).collect()}
    assert got == pytest.approx(want)
    assert got["a"] == 6 and got[None] == 27


def test_positions_follow_the_schedule(spark):
    rows = [(i, "w " * 10, f"s{i % 3}") for i in range(3000)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    positions = [r["position"] for r in got if r["taken"]]
    assert positions == sorted(positions)
    by_source = defaultdict(list)
    for r in got:
        by_source[r["source"]] += [t["position"] for t in r["takes"]]
    for i, schedule in enumerate(mixing.CURRICULUM):
        t, w = np.array(schedule).T
        grid = np.linspace(0, 1, 2001)
        density = np.interp(grid, t, w)
        share = np.cumsum(density) / density.sum()
        for part in (0.25, 0.5, 0.75):
            want = np.interp(part, grid, share)
            assert abs(np.mean(np.array(by_source[f"s{i}"]) <= part) - want) < 0.01


def test_stream_has_the_columns_and_words(docs):
    stream = mixing.training_stream(docs)
    assert stream.columns == docs.columns
    rows = stream.collect()
    plan = mixing.mix_sources(docs).collect()
    assert sum(len(WORD.findall(r["text"])) for r in rows) == sum(r["taken"] for r in plan)
    assert len(rows) == sum(len(r["takes"]) for r in plan)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_main_path_of_mixing_has_no_python(docs):
    plan = mixing.training_stream(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_tables(empty, spark):
    assert mixing.mix_sources(empty).collect() == []
    assert mixing.training_stream(empty).collect() == []
    assert quality.judge_quality(empty).collect() == []
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(pages, url_filter.listed_hosts(pages)).collect() == []


# -- quality ---------------------------------------------------------------------


def base_figures(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    inside = set()
    for i, x in enumerate(zip(w, w[1:], w[2:])):
        if windows[x] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(inside),
        len(w) < 50 or 100 * len(inside) > 50 * len(w),
    )


def test_base_figures(docs, corpus, spark):
    more = [(900, "a b a b a b\na b\n\n \na b\nx# y$", "en", "s"), (901, "x y z\nx y z\r\nx y z\n", "en", "s")]
    frame = docs.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame([r[:3] for r in more], "doc_id long, text string, lang string")
    )
    got = quality.judge_quality(frame)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = got.collect()
    assert Counter((r["doc_id"], *[r[c] for c in names]) for r in rows) == Counter(
        (i, *base_figures(t)) for i, t, *_ in [*corpus, *more]
    )
    assert not any(r["kept"] for r in rows if r["base_failed"])


def test_odd_histograms_are_rejected(spark):
    common = quality.COMMON["en"].split()
    rows = []
    for i in range(60):
        w = [common[j % 20] if j % 2 else f"Word{i}x{j}" for j in range(300)]
        np.random.default_rng(i).shuffle(w)
        rows.append((i, " ".join(w), "en"))
    rows.append((100, " ".join(f"W{j}###" for j in range(300)), "en"))
    rows.append((101, " ".join(f"uncommon{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(300)), "en"))
    rows.append((102, " ".join(f"SHORT{j}" for j in range(60)), "other"))
    got = {r["doc_id"]: r["kept"] for r in quality.judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i] for i in range(60)) and not got[100] and not got[101] and got[102]


def test_distance_is_jensen_shannon(spark):
    p, q = [0.1, 0.4, 0.5, 0.0], [0.3, 0.3, 0.0, 0.4]
    m = [(a + b) / 2 for a, b in zip(p, q)]

    def divergence(x):
        return sum(a * np.log2(a / b) for a, b in zip(x, m) if a)

    frame = spark.createDataFrame([(p, q)], "p array<double>, q array<double>")
    got = frame.select(quality.distance(F.col("p"), F.col("q")).alias("d")).first()["d"]
    assert got == pytest.approx(np.sqrt((divergence(p) + divergence(q)) / 2))


def test_null_language_is_its_own(spark):
    letters, digits = " ".join(["plain words here"] * 1 + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)]), " ".join(str(i * 7919) for i in range(150))
    rows = [(i, letters, None) for i in range(2)] + [(10 + i, digits, "") for i in range(9)]
    got = quality.judge_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == 11
    assert all(r["kept"] and r["class_distance"] < 1e-6 for r in got)


def test_main_path_of_quality_has_no_python(docs):
    plan = quality.document_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- urls --------------------------------------------------------------------------

URLS = [
    "http://A.Example.NET/en/1?x", "https://example.net/en", "https://x.net", "x.net/", "ftp://net/a", "http://b.org/fr/",
    "http://b.org/fr", "http://borg/fr/x", "https://example.com/de/9#t", "https://cheap-pills.example.com/de/9",
    "https://www.cheap-pills.example.com/en/9", "https://spam-farm.org/fr/9", "a://b://c/d", "http://#", "http://h?a/b", None, "",
    "http://é.Ä/x\ny", "http://cheap-pillsx.example.com/en", "https://casino-win.example.org/x?q",
    "https://xn--a-b.example.com/", "https://-a.example.com/", "https://a-.example.com/", "https://B-2-c/", "http://a-b\n/x",
    "https://plain.example.com/" + "long-path/" * 20000,
]


def judged(url):
    host, path = "", ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
        host = re.sub("[A-Z]", lambda c: c[0].lower(), m[1])
        path = m[2]
    best = None
    for rule, said in url_filter.RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            best = max(best or ("", ""), (rule, said), key=lambda r: len(r[0]))
    listed = any(re.fullmatch(r"[a-z0-9]+(-[a-z0-9]+)+", label) for label in host.split("."))
    return host, path, best[0] if best else None, best[1] if best else ("block" if listed else "allow")


def test_urls(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0]), (None, URLS[4])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "'x' as rule")
    got = url_filter.judge_urls(pages, url_filter.listed_hosts(pages)).collect()
    key = lambda r: repr(r)
    assert sorted([(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got], key=key) == sorted(
        [(i, *judged(u)) for i, u in rows], key=key
    )


def test_cascade_is_exact_in_one_block_and_in_many(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "SHARD_KEYS", 300)
    keys = spark.range(3000).selectExpr("concat('host', id) as key", "id % 7 = 0 as listed")
    cascade = url_filter.build_cascade(keys)
    rows = keys.withColumn("key_hash", url_filter._key_hash(F.col("key"))).withColumnRenamed("listed", "want")
    for limit in (1 << 20, 200):
        got = url_filter.in_cascade(rows, cascade, limit)
        assert got.count() == 3000 and got.filter("listed != want").count() == 0
    assert len(url_filter.blocks_of(cascade, 200)) > 3


def test_listed_table_of_thousands_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "SHARD_KEYS", 500)
    pages = spark.range(9000).selectExpr("id as page_id", "concat('https://h', id % 6000, '.test/p') as url")
    pages = pages.unionByName(spark.createDataFrame([(9000, None), (9001, "")], "page_id long, url string"))
    listed = spark.range(0, 12000, 2).selectExpr("concat('h', id, '.test') as host", "id as page_id")
    listed = listed.unionByName(listed.limit(5)).unionByName(spark.createDataFrame([(None, None)], "host string, page_id long"))
    sent = []
    original = url_filter.blocks_of
    monkeypatch.setattr(url_filter, "blocks_of", lambda *a: sent.append(original(*a)) or sent[-1])
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages, listed, limit=800).collect()}
    assert len(sent[0]) > 3 and len(got) == 9002
    assert all(got[i] == ("block" if i % 6000 % 2 == 0 else "allow") for i in range(9000))
    assert got[9000] == got[9001] == "block"  # the null name lists the empty host


def test_an_empty_list_and_an_empty_table(spark):
    pages = spark.createDataFrame([(1, "https://a-b.test/x"), (2, "https://x.net/")], "page_id long, url string")
    nothing = spark.createDataFrame([], "host string")
    assert {(r["page_id"], r["verdict"]) for r in url_filter.judge_urls(pages, nothing).collect()} == {(1, "allow"), (2, "block")}
    empty = pages.limit(0)
    assert url_filter.judge_urls(empty, url_filter.listed_hosts(empty)).count() == 0


def test_levels_end_for_any_sets():
    r = np.random.default_rng(0)
    keys = r.choice(1 << 62, 5000, replace=False)
    for n in (0, 1, 10, 4990, 5000):
        levels = url_filter.build_levels(keys[:n], keys[n:])
        assert (url_filter.ask_levels(levels, keys) == (np.arange(5000) < n)).all()
