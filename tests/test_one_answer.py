"""Answers that depend neither on the plan nor on the size of the input."""

import pytest

from lexvane.functions.relations import with_relations
from lexvane.operators.dictionary import minimal_terms
from lexvane.operators.graph import total_edges
from lexvane.operators.match import flag_matches
from lexvane.operators.profile import value_shares
from pyspark.sql import functions as F

PLANS = ("scan", "indexed", "shuffled")


@pytest.mark.parametrize("plan", PLANS)
def test_raw_whole_words(spark, plan):
    texts = ["foo,barrel baz", "a barrel b", "barrel", None, "", "x,y z", "ax,y z", "?? !!", "barrel,"]
    terms = ["barrel", "x,y", "!!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    given = spark.createDataFrame([(t,) for t in terms], "term string")
    flagged = flag_matches(docs, given, "id", "text", "hit", plan, whole_word=True)
    expected = [int(any(f" {term} " in f" {text or ''} " for term in terms)) for text in texts]
    assert [r["hit"] for r in flagged.orderBy("id").collect()] == expected


@pytest.mark.parametrize("plan", PLANS)
def test_rows_without_an_id_keep_their_flag(spark, plan):
    docs = spark.createDataFrame([(None, "a barrel b"), (None, "nothing"), (1, "barrels")], "id long, text string")
    terms = spark.createDataFrame([("barrel",)], "term string")
    flagged = flag_matches(docs, terms, "id", "text", "hit", plan)
    assert {r["text"]: r["hit"] for r in flagged.collect()} == {"a barrel b": 1, "nothing": 0, "barrels": 1}


def test_long_terms_are_minimized(spark):
    long = "word " * 60 + "end"
    terms = spark.createDataFrame([(long,), ("more " + long,)], "term string")
    assert [r["term"] for r in minimal_terms(terms, on_clean_text=False).collect()] == [long]


def test_wide_ids_count_and_quoted_exponents_do_not(spark):
    rows = [(0, "[{'from_id': 123456789012345678901234567890, 'to_id': 2}]"), (1, "[{'from_id': '1E5', 'to_id': 2}]")]
    read = with_relations(spark.createDataFrame(rows, "id long, relations string"), "relations", "pairs")
    counted = read.select("id", total_edges(F.col("pairs")).alias("n"))
    assert dict(counted.collect()) == {0: 1, 1: 0}


def test_nan_is_no_value(spark):
    rows = spark.createDataFrame([(1.0,), (float("nan"),), (1.0,), (None,)], "v double")
    assert [tuple(r) for r in value_shares(rows, "v").collect()] == [(1.0, 2, 1.0)]
