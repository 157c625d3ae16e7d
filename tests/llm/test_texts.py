"""BPE, language model and toxicity."""

import hashlib
import math
import random
import zlib
from array import array
from collections import Counter

import numpy as np
import pytest

from lexvane.llm import bpe, language_model, toxicity

# -- BPE -----------------------------------------------------------------------

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    found = tokenizers.Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def random_texts():
    r = random.Random(4)
    letters = "abc'sStTΣσ İé é 1234567890\x1c\x1d\x85 !?.<|endoftext|> 中文字 ÀÉ  ﬁ 🎉 ___ don't I'LL\n\t\x00"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 80))) for _ in range(1500)]
    return texts + ["<|endoftext|>", "a<|startoftext|>b", "ΑΣ ΑΣ", "x" * 3000, "ab" * 1500, "1" * 500, "!?" * 700, ""]


def test_encoding_equals_the_library(library):
    encoder = bpe.Encoder(bpe.load_vocabulary(PATH))
    for text in random_texts():
        ids, decoded = encoder.encode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert list(array("I", ids)) == want
        assert decoded == library.decode(want, skip_special_tokens=False)
        assert bpe.decode(want, encoder.v) == decoded


def test_cuts_never_cross_a_token():
    vocabulary = bpe.load_vocabulary(PATH)
    encoder = bpe.Encoder(vocabulary)
    assert len(encoder.fragments("qzxjq")) > 1
    joined = [s for f in encoder.fragments("strength") for s in f]
    assert "".join(joined) == "strength" + vocabulary.end


def test_documents(docs, corpus, library):
    got = bpe.encode_documents(docs, PATH, digests=True).collect()
    want = []
    for i, text, *_ in corpus:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_ids_and_texts(docs, library):
    for r in bpe.encode_documents(docs, PATH).collect():
        assert r["n_tokens"] == len(r["ids"])
        assert r["decoded"] == library.decode(r["ids"], skip_special_tokens=False)


def test_no_texts(empty):
    assert bpe.encode_documents(empty, PATH).collect() == []
    assert language_model.score_documents(empty).collect() == []


# -- language model ---------------------------------------------------------------


def lm_tokens(text):
    fold = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return [*fold.split(), None]


def is_held_out(i, folds):
    return zlib.crc32(("" if i is None else str(i)).encode()) % folds == 0


def test_scores(docs, corpus):
    words, two = Counter(), Counter()
    for i, text, *_ in corpus:
        if not is_held_out(i, 10):
            w = lm_tokens(text)
            words.update(w)
            two.update(zip([None, *w], w))
    n, v = sum(words.values()), len(words)

    def alone(w):
        return (words[w] + 0.1) / (n + 0.1 * (v + 1))

    want = {}
    for i, text, *_ in corpus:
        w = lm_tokens(text)
        base = sum(math.log10(alone(x)) for x in w)
        model = sum(math.log10((two[u, x] + 1000 * alone(x)) / (words[u] + 1000)) for u, x in zip([None, *w], w))
        want[(i, len(w))] = (is_held_out(i, 10), sum(words[x] > 0 for x in w), base, model)
    for limit in (64 << 20, 4000):  # in one pass and in many
        rows = language_model.score_documents(docs, limit).collect()
        assert len(rows) == len(corpus)
        for r in rows:
            held, known, base, model = want[(r["doc_id"], r["n_tokens"])]
            assert (r["held_out"], r["n_known"], r["train_tokens"]) == (held, known, n)
            assert r["base_score"] == pytest.approx(base)
            # Counts are quantised and some answers of the filter are false.
            assert abs(r["score"] - model) < 0.35 * r["n_tokens"]
        average = np.mean([(r["score"] - want[(r["doc_id"], r["n_tokens"])][3]) / r["n_tokens"] for r in rows])
        assert abs(average) < 0.1


def test_no_training_rows(spark):
    held = next(i for i in range(1000) if is_held_out(i, 10))
    frame = spark.createDataFrame([(held, "a b"), (held, "a b"), (held, None)], "doc_id long, text string")
    rows = language_model.score_documents(frame).collect()
    assert sorted(r["n_tokens"] for r in rows) == [1, 3, 3]
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in rows)
    assert {round(r["base_score"], 9) for r in rows} == {0.0}


def test_regular_long_words_are_two_words(spark):
    places = [bin(i).count("1") % 2 for i in range(2048)]
    one, other = "".join("ab"[p] for p in places), "".join("ba"[p] for p in places)
    kept = [i for i in range(50) if not is_held_out(i, 10)][:2]
    rows = [(kept[0], one), (kept[1], other)]
    got = language_model.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # Training tokens: each word once, the end twice; three different ones.
    want = math.log10(1.1 / (4 + 0.1 * 4)) + math.log10(2.1 / (4 + 0.1 * 4))
    assert [r["base_score"] for r in got] == pytest.approx([want, want])


def test_texts_are_read_in_one_pass(docs):
    plan = language_model.score_documents(docs, 4000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan and "hashpartitioning" not in plan


def test_filter_answers():
    r = np.random.default_rng(2)
    h = r.integers(0, 1 << 63, 4000).astype(np.uint64)
    counts = r.integers(1, 200, 4000)
    bits = language_model.bucket_bits(h, counts)
    found = language_model.Filter(0, 64, np.array([0, len(bits)]), bits).counts(h)
    exact = language_model.count_of(language_model.level_of(counts))
    assert (found >= exact).all()  # never too low
    assert (found == exact).mean() > 0.97
    other = r.integers(0, 1 << 63, 4000).astype(np.uint64)
    assert (language_model.Filter(0, 64, np.array([0, len(bits)]), bits).counts(other) > 0).mean() < 0.03
    middle = language_model.count_of(language_model.level_of(np.array([1, 2, 3, 10, 100])))
    assert (np.abs(middle / [1, 2, 3, 10, 100] - 1) < 0.35).all()


# -- toxicity ------------------------------------------------------------------------

INSULTS = ("blockhead", "nitwit", "rotter")


def test_automaton_and_trie_equal_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(new[j] + 1, row[j + 1] + 1, row[j] + (x != y)))
            row = new
        return row[-1]

    r = random.Random(6)
    terms = {"".join(r.choice("abc") for _ in range(r.randint(1, 7))): 1.0 for _ in range(60)}
    trie = toxicity.build_trie(terms)
    for _ in range(200):
        word = "".join(r.choice("abcd") for _ in range(r.randint(0, 8)))
        for edits in (0, 1, 2):
            want = sorted((d, t) for t in terms if (d := distance(word, t)) <= edits)
            assert toxicity.near_terms(trie, word, edits) == want


def test_near_words_pass_the_halves():
    finder = toxicity.Finder(toxicity.Lexicon(dict.fromkeys(INSULTS, 5.0), {}))
    for term in INSULTS:
        for i in range(len(term)):
            assert finder.near(term[:i] + term[i + 1 :])
            assert finder.near(term[:i] + "z" + term[i:])
            assert finder.near(term[:i] + "z" + term[i + 1 :])


def test_quotations_weigh_less():
    finder = toxicity.Finder(toxicity.Lexicon({"nitwit": 5.0}, {}))
    meant = finder.features("you are a nitwit and everybody around here knows it well")
    quoted = finder.features("the report says that “nitwit” was heard around here")
    marked = finder.features('a sign with "nitwit" on it hung over the door here')
    misspelled = finder.features("you are a nitwid and everybody around here knows it well")
    assert meant[0] > misspelled[0] > 0 and meant[0] > quoted[0] > 0 and meant[0] > marked[0] > 0
    assert finder.features("") == [0.0, 0.0] == finder.features("nothing of that kind")


def toxic_corpus():
    r = random.Random(8)
    common = [f"plain{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        w = [r.choice(common) for _ in range(r.randint(20, 90))]
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                w[r.randrange(len(w))] = r.choice(INSULTS)
            if i % 12 == 0:
                w.append("zork" + r.choice("abcdefgh") * 3)  # a family of words
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = toxic_corpus()
    rows += [(5000, None), (5001, ""), (None, "plain1 nitwit rotter nitwit"), (5002, "plain2 nitwjt rottter blockhed plain3")]
    rows += [(7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as x", "2 as toxic", "3 as score")
    truth = spark.createDataFrame(labels + [(8, None), (None, 1), (99999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, truth)
    assert set(INSULTS) <= set(model.lexicon.terms)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    wrong = sum(by_id[i]["predicted"] != y for i, y in labels if is_held_out(i, 5))
    assert wrong <= 2
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == is_held_out(r["doc_id"], 5)
    assert by_id[5000]["predicted"] == by_id[5001]["predicted"] == 0
    assert by_id[None]["predicted"] == 1 and by_id[5002]["predicted"] == 1
    kept = toxicity.without_toxic(docs, model).count()
    assert kept == sum(1 - r["predicted"] for r in got)


def test_nothing_to_learn_from(spark, empty):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert [r["predicted"] for r in toxicity.score(docs, model).collect()] == [0, 0]
    assert toxicity.score(empty, model).collect() == []
