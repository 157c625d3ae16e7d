"""Words that occur often meet the index once; terms around a common word meet few of its places."""

import random

import pytest

from lexvane.operators import match as M

MARKS = [" ", ", ", "-", "  ", "; "]


def terms_of(spark, terms):
    return spark.createDataFrame([(t,) for t in terms], "term string")


def test_terms_around_a_common_word_are_filed_by_what_is_beside_it(spark):
    """All of them used to be compared at each place of the word."""
    terms = [f"{a}{b} de x" for a in "abcdefgh" for b in "klmnopqr"]
    filed = M.anchored_terms(terms_of(spark, terms)).collect()
    assert {r["anchor"] for r in filed} == {"=de"}
    assert {r["side"] for r in filed} == {f"<{t[:2]}" for t in terms}


@pytest.mark.parametrize("known", [40, 1000])
@pytest.mark.parametrize("whole_word", [False, True])
@pytest.mark.parametrize("clean", [False, True])
def test_known_and_other_words_give_the_same_flags(spark, monkeypatch, clean, whole_word, known):
    monkeypatch.setattr(M, "KNOWN_OFTEN", 2)
    monkeypatch.setattr(M, "KNOWN_WORDS", known)
    monkeypatch.setattr(M, "TELLING_WORDS", 3)
    monkeypatch.setattr(M, "WORDS_ALONG", 3)
    rnd = random.Random(7)
    marks = [" "] if clean else MARKS

    def run(n):
        return "".join(rnd.choice("abé") * rnd.randint(1, 5) + rnd.choice(marks) for _ in range(n))

    texts = [run(rnd.randint(0, 25)).strip() for _ in range(200)] + ["", None, "a" * 90]
    terms = []
    for _ in range(30):
        source = rnd.choice([t for t in texts if t])
        start = rnd.randrange(len(source))
        terms += [source[start : start + rnd.randint(8, 18)].strip(), run(rnd.randint(3, 4)).strip()]
    terms = [t for t in terms if len(t) > 7] + ["a" * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = M.flag_sets(docs, [M.TermSet("hit", terms_of(spark, terms), "text", whole_word, clean, "indexed")], ["id"])
    want = {i: int(any(f" {x} " in f" {t or ''} " if whole_word else x in (t or "") for x in terms)) for i, t in enumerate(texts)}
    assert 0 < sum(want.values()) < len(texts)
    assert dict(map(tuple, got.collect())) == want


def test_text_with_a_telling_word_is_decided_before_its_words_are_split_off(spark):
    """Its words used to be looked up one by one, also after the first that told."""
    texts = ["telling words", "x telling", "other words here", "a tellings", None] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    flagged = M.flag_sets(docs, [M.TermSet("hit", terms_of(spark, ["tell", "two here"]), "text", False, True, "indexed")], ["id"])
    assert "IN (telling,tellings)" in flagged._jdf.queryExecution().optimizedPlan().toString().replace("tellings,telling", "telling,tellings")
    assert [r["hit"] for r in flagged.orderBy("id").collect()] == [1, 1, 0, 1, 0] * 5
