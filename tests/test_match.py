import random

import pytest
from pyspark.sql import functions as F

from lexvane.functions.text import clean_text
from lexvane.operators import match as M
from lexvane.operators.dictionary import minimal_terms
from lexvane.operators.recognizer import recognizer_flag

ALL_PLANS = ("scan", "indexed", "shuffled")


def frames(spark, texts, terms):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return docs, spark.createDataFrame([(t,) for t in terms], "term string")


def brute(texts, terms, whole_word=False):
    def hit(text, term):
        text = text or ""
        return f" {term} " in f" {text} " if whole_word else term in text

    return {i for i, t in enumerate(texts) if any(hit(t, term) for term in terms)}


def ids(df):
    return {r[0] for r in df.collect()}


def random_case(seed):
    rnd = random.Random(seed)
    letters = "abé"

    def word(n):
        return "".join(rnd.choice(letters) for _ in range(rnd.randint(1, n)))

    texts = [" ".join(word(9) for _ in range(rnd.randint(0, 14))) for _ in range(80)] + [None, "", "a" * 70]
    terms = set()
    for _ in range(25):
        source = rnd.choice([t for t in texts if t])
        start = rnd.randrange(len(source))
        terms.add(source[start : start + rnd.randint(5, 14)].strip())
        terms.add(" ".join(word(7) for _ in range(rnd.randint(1, 4))))
    return texts, sorted(t for t in terms if len(t) > 3)


@pytest.mark.parametrize("plan", ALL_PLANS)
@pytest.mark.parametrize("whole_word", [False, True])
def test_plans_equal_brute_force(spark, plan, whole_word):
    texts, terms = random_case(11)
    docs, frame = frames(spark, texts, terms)
    got = ids(M.matching_ids(docs, frame, "doc_id", "text", plan, whole_word, True))
    assert got == brute(texts, terms, whole_word)


@pytest.mark.parametrize("plan", ALL_PLANS)
def test_known_answers(spark, plan):
    texts = ["general note", "w32 virlock", "", None, "x poison ivy v2 y", "ransomwares", "c++ and .exe"]
    for terms, want in [
        (["nera"], {0}),
        (["w32/virlock"], set()),
        (["son ivy v", "zzzz"], {4}),
        (["somware"], {5}),
        (["poison ivy", "general"], {0, 4}),
        ([".exe"], {6}),
        (["++"], {6}),
        (["c++ an"], {6}),
    ]:
        docs, frame = frames(spark, texts, terms)
        assert ids(M.matching_ids(docs, frame, "doc_id", "text", plan)) == want, terms


@pytest.mark.parametrize("plan", ("indexed", "shuffled"))
def test_many_short_terms_use_the_index(spark, plan, monkeypatch):
    monkeypatch.setattr(M, "SCAN_TERMS", 1)
    texts = ["ab cd", "xx yy", "abc", "", "q ab"]
    docs, frame = frames(spark, texts, ["ab", "cd", "b c", "zz z"])
    assert ids(M.matching_ids(docs, frame, "doc_id", "text", plan)) == {0, 2, 4}


def test_long_words_are_searched_to_their_end(spark):
    word = "".join(chr(97 + i % 26) for i in range(100))
    places = range(0, 96)
    docs, frame = frames(spark, [word[:i] + "QRST" + word[i:] for i in places], ["QRST", "zzzzz"])
    for plan in ("indexed", "shuffled"):
        assert ids(M.matching_ids(docs, frame, "doc_id", "text", plan)) == set(places)


def test_minimal_dictionary_gives_the_same_flags(spark):
    texts, terms = random_case(5)
    docs, frame = frames(spark, texts, terms + [terms[0] + " x", "no/match", " "])
    small = minimal_terms(frame)
    assert small.count() < len(terms)
    cleaned = docs.select("doc_id", clean_text(F.col("text")).alias("clean"))
    flagged = M.dictionary_flag(cleaned, frame, "doc_id", "clean")
    rows = {r["doc_id"]: r["malware_flag"] for r in flagged.collect()}
    assert len(rows) == len(texts)
    assert {i for i, f in rows.items() if f} == brute(texts, terms)


def test_choice_of_plan(spark, monkeypatch):
    few = spark.createDataFrame([("abcd",)], "term string")
    assert M.choose_plan(few) == "scan"
    monkeypatch.setattr(M, "SCAN_TERMS", 0)
    assert M.choose_plan(few) == "indexed"
    monkeypatch.setattr(M, "BROADCAST_BYTES", 3)
    assert M.choose_plan(few) == "shuffled"
    with pytest.raises(ValueError):
        M.matching_ids(few, few, "term", "term", "other")


def test_gazetteer_minds_case_and_type(spark):
    docs, _ = frames(spark, ["in Paris", "in paris", "Acme", None], [])
    names = spark.createDataFrame([("Paris", "GPE"), ("Acme", "TOOL")], "name string, type string")
    got = M.gazetteer_flag(docs, names, ("GPE", "ORG"), "doc_id", "text")
    assert {r["doc_id"]: r["has_info_entities"] for r in got.collect()} == {0: 1, 1: 0, 2: 0, 3: 0}


def test_recognizer_hook(spark):
    docs, _ = frames(spark, ["Acme Corp", "nothing", None, "boom"], [])

    def load():
        def recognize(text):
            if text == "boom":
                raise RuntimeError("no answer")
            return ["ORG"] if "Corp" in text else ["DATE"]

        return recognize

    got = docs.select("doc_id", recognizer_flag(F.col("text"), load, ("ORG",)).alias("f")).collect()
    assert {r["doc_id"]: r["f"] for r in got} == {0: 1, 1: 0, 2: 0, 3: 0}


def test_scan_plan_has_no_shuffle(spark):
    docs, frame = frames(spark, ["abcd"], ["abcd"])
    plan = M.flag_in_place(docs, frame, "text")._jdf.queryExecution().executedPlan().toString()
    assert "ExistenceJoin" in plan and "Exchange hashpartitioning" not in plan


def test_scan_files_terms_of_several_words(spark):
    terms = ["a b c d", "z b c y", "b", "b c", "x, y; z", "p q r", "p q r s t"]
    filed = M._scan_groups(spark.createDataFrame([(t,) for t in terms], "term string"), False).collect()
    assert sorted(len(r["_keys"]) for r in filed if not r["_keys"]) == [0, 0]  # the terms of one and of two words
    assert sum(len(r["_keys"]) for r in filed) == 4  # the first two have their inner words in common
    held = sorted(t for r in filed for some in r["_filed"] for t in some)
    assert held == sorted(terms)


@pytest.mark.parametrize("whole_word", [False, True])
def test_scan_equals_brute_force_on_texts_as_they_are(spark, whole_word):
    rnd = random.Random(3)
    marks = [" ", ", ", "-", "  ", "_", "; "]

    def run(n):
        return "".join(rnd.choice("abé") * rnd.randint(1, 2) + rnd.choice(marks) for _ in range(n))

    texts = [run(rnd.randint(0, 20)) for _ in range(150)] + [None, "", "-", " a-b "]
    terms = []
    for _ in range(40):
        source = rnd.choice([t for t in texts if t])
        start = rnd.randrange(len(source))
        terms += [source[start : start + rnd.randint(6, 16)], run(rnd.randint(3, 5))]
    terms = [t for t in terms if len(t) > 5]
    docs, frame = frames(spark, texts, [*terms, *terms[:5], None])
    got = M.flag_in_place(docs, frame, "text", "flag", whole_word)
    assert got.columns == ["doc_id", "text", "flag"]
    assert ids(got.filter("flag = 1").select("doc_id")) == brute(texts, terms, whole_word)
    assert got.count() == len(texts)
