"""Dictionaries made smaller: the same answer as brute force, in work that follows the terms."""

import random

import pytest

from lexvane.operators.dictionary import _holding_candidates, minimal_terms


@pytest.mark.parametrize("whole_word", [False, True])
def test_minimal_terms_equal_brute_force(spark, whole_word):
    r = random.Random(5)
    terms = {"".join(r.choice("ab ") for _ in range(r.randint(1, 40))).strip() for _ in range(250)}
    terms |= {"a" * n for n in (3, 33, 70)} | {"", "x", "common beginning " * 4 + "end"}
    frame = spark.createDataFrame([(t,) for t in sorted(terms)] + [("x",), (None,)], "term string")

    def holds(term, part):
        return f" {part} " in f" {term} " if whole_word else part in term

    wanted = {t for t in terms if t and not any(p and p != t and holds(t, p) for p in terms)}
    got = [r["term"] for r in minimal_terms(frame, False, whole_word).collect()]
    assert sorted(got) == sorted(wanted)


def test_terms_that_begin_and_end_alike_do_not_meet_as_pairs(spark):
    same = "/usr/share/applications/local/packages/x/"
    terms = spark.range(100_000).selectExpr(f"concat('{same}', lpad(id, 6, '0'), '/bin/run') as term")
    assert _holding_candidates(terms).count() <= 20 * 100_000
    assert minimal_terms(terms, on_clean_text=False).count() == 100_000


def test_empty_dictionary(spark):
    assert minimal_terms(spark.createDataFrame([], "term string")).count() == 0
