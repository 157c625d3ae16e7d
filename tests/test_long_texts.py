"""Matching in texts of many words, and terms of many words, through the index."""

import re

import pytest
from pyspark.sql import functions as F

from lexvane.operators.match import REACH, TermSet, flag_sets

LONG = [f"w{i}" for i in range(REACH + 8)]


def terms_of(spark, terms):
    return spark.createDataFrame([(t,) for t in terms], "term string")


@pytest.mark.parametrize("clean", [True, False])
def test_words_take_no_whole_text_along(spark, clean):
    """A word of a text used to carry all of its words: 20 000 words made gigabytes of one row."""
    docs = spark.createDataFrame([(1, "some words " * 50)], "id long, text string")
    one = TermSet("hit", terms_of(spark, ["two words here", "other thing"]), "text", False, clean, "indexed")
    carry = {"n": F.size(F.filter(F.split("text", " "), lambda w: w != ""))}
    plan = flag_sets(docs, [one], ["id"], carry)._jdf.queryExecution().executedPlan().toString()
    along = [re.search(r"\), \[([^\]]*)\], false, \[_p#", line) for line in plan.splitlines() if "posexplode" in line]
    assert along and all(m for m in along)
    for m in along:
        assert {c.strip().split("#")[0] for c in m.group(1).split(",")} <= {"_row", "id", "_scan0", "n", "_set"}


@pytest.mark.parametrize("whole_word", [False, True])
@pytest.mark.parametrize("clean", [True, False])
@pytest.mark.parametrize("plan", ["indexed", "shuffled"])
def test_terms_longer_than_what_goes_along(spark, plan, clean, whole_word):
    glue = " " if clean else "; "
    whole = glue.join(LONG)
    texts = [
        whole, f"x {whole} y", f"x{whole}y", glue.join(LONG[:-1]), glue.join(LONG[:9] + ["no"] + LONG[9:]),
        "alpha beta", "the alpha beta gamma", "alphabeta", "alpha, beta", "", None, "beta alpha", "xalpha betax",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    terms = [whole, "alpha beta"]
    got = flag_sets(docs, [TermSet("hit", terms_of(spark, terms), "text", whole_word, clean, plan)], ["id"])

    def held(text):
        text = text or ""
        text = " ".join(re.split(r"[^\w]+", text.lower())).strip() if clean else text
        return int(any(f" {t} " in f" {text} " if whole_word else t in text for t in terms))

    assert dict(map(tuple, got.collect())) == {i: held(t) for i, t in enumerate(texts)}


def test_gaps_of_raw_texts_decide(spark):
    texts = ["-abc", "abc", "x-abcd", " abc", "a - b", "a-b", "ab - b", "see a - b.", "abc-", "foo abc- bar"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    terms = ["-abc", "a - b", " abc- "]
    for whole_word in (False, True):
        got = flag_sets(docs, [TermSet("hit", terms_of(spark, terms), "text", whole_word, False, "indexed")], ["id"])
        want = {i: int(any(f" {x} " in f" {t} " if whole_word else x in t for x in terms)) for i, t in enumerate(texts)}
        assert dict(map(tuple, got.collect())) == want
