import ast

import pytest
from pyspark.sql import functions as F

from lexvane.functions.relations import with_plain_relations, with_relations

CASES = {
    "[{'from_id': 1, 'to_id': 2}]": [(1, 2)],
    "[{'from_id': '1', 'to_id': 2.7}]": [(1, 2)],
    "[{'from_id': '2.7', 'to_id': 2}]": [],
    "[{'from_id': None, 'to_id': 2}, {'from_id': 5, 'to_id': 6}]": [(5, 6)],
    "[1, {'from_id': 5, 'to_id': 6}]": [(5, 6)],
    "[{'from_id': True, 'to_id': 2}]": [(1, 2)],
    "[{'from_id': null, 'to_id': 2}, {'from_id': 5, 'to_id': 6}]": [],
    "[{'from_id': 5, 'to_id': 6},]": [(5, 6)],
    "[{'from_id': 5, 'to_id': 6}] junk": [],
    "[{'from_id': 5, 'from_id': 7, 'to_id': 6}]": [(7, 6)],
    "[{'from_id': 1e999, 'to_id': 6}, {'from_id': 5, 'to_id': 6}]": [],
    "{'from_id': 5, 'to_id': 6}": [],
    "({'from_id': 5, 'to_id': 6},)": [],
    "": [],
    None: [],
    "not a list": [],
    "[]": [],
    " [ ] ": [],
    "[{}]": [],
    "[{'x': 'a, b', 'from_id': ' 5 ', 'to_id': 6}, {\"from_id\": -3, \"to_id\": \"+4\"}]": [(5, 6), (-3, 4)],
    "[{'From_id': 5, 'to_id': 6}]": [],
    "[{'from_id': '1_0', 'to_id': 6}]": [(10, 6)],
    "[{'from_id': '٣', 'to_id': 6}]": [(3, 6)],
    "[,{'from_id': 5, 'to_id': 6}]": [],
    "[x,{'from_id': 5, 'to_id': 6}]": [],
    "[{'from_id': 5, 'to_id': 6}{'from_id': 5, 'to_id': 6}]": [],
    "[{'from_id': 05, 'to_id': 6}]": [],
    "[{'from_id': 3.9, 'to_id': -0.5}]": [(3, 0)],
    "[{'from_id': '2.5', 'to_id': 1}, {'from_id': 2.5, 'to_id': 1}]": [(2, 1)],
    "[{'from_id': 12.5.6, 'to_id': 1}]": [],
    "[{'from_id': 1, 'to_id': 2}, {'from_id': 1, 'to_id': 2}]": [(1, 2), (1, 2)],
    "[{'from_id': [1], 'to_id': 2}]": [],
    "[{'a': {'from_id': 9}, 'from_id': 1, 'to_id': 2}]": [(1, 2)],
    "[" + ", ".join(f"{{'from_id': {i}, 'to_id': {i + 1}}}" for i in range(20000)) + "]": [
        (i, i + 1) for i in range(20000)
    ],
}


def brute(text):
    """What reading the whole text as a literal gives."""
    pairs = []
    try:
        value = ast.literal_eval(text)
        for item in value if isinstance(value, list) else []:
            if isinstance(item, dict):
                try:
                    pairs.append((int(item["from_id"]), int(item["to_id"])))
                except (KeyError, TypeError, ValueError):
                    pass
    except Exception:
        return []
    return pairs


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "i int, r string")
    both = with_relations(with_plain_relations(df, "r", "p"), "r", "q")
    return {r["i"]: r for r in both.select("i", "p", "q").collect()}


def test_every_case(parsed):
    for i, (text, want) in enumerate(CASES.items()):
        got = [tuple(e) for e in parsed[i]["q"]]
        assert got == want, text
        assert text is None or got == brute(text), text


def test_plain_path_agrees_where_it_answers(parsed):
    answered = 0
    for i, want in enumerate(CASES.values()):
        if parsed[i]["p"] is not None:
            answered += 1
            assert [tuple(e) for e in parsed[i]["p"]] == want
    assert answered >= 8
    assert parsed[len(CASES) - 1]["p"] is not None  # a long list stays in the JVM


def test_null_and_text_only(spark):
    df = spark.range(3).select(F.lit(None).cast("string").alias("r"))
    assert [r["q"] for r in with_relations(df, "r", "q").collect()] == [[], [], []]
