import pytest
from pyspark.sql import functions as F

from lexvane.operators import dictionary as D
from lexvane.operators import entities as E
from lexvane.sources.reports import nested_mentions

WIDE = "row_id long, text string, id_1 string, label_1 string, start_offset_1 string, end_offset_1 string, label_3 string"


def reports(spark, rows):
    return spark.createDataFrame(rows, WIDE)


def spans(spark):
    text = "0123456789"
    offsets = [("0", "10"), ("3", "3"), ("-1", "2"), ("5", "11"), ("x", "4"), ("3.7", "6.2"), (None, "4")]
    return reports(spark, [(i, text, "1", "MALWARE", s, e, None) for i, (s, e) in enumerate(offsets)])


def test_group_width():
    assert E.group_width(["label_1", "label_12", "label_7_old"]) == 12
    with pytest.raises(ValueError):
        E.group_width(["text"])


def test_span_validity(spark):
    mentions = E.unpivot_entities(spans(spark), "row_id", ("label", "start", "end"), ("text",))
    got = {r["row_id"]: r["name"] for r in E.malware_spans(mentions).collect()}
    assert got == {0: "0123456789", 1: None, 2: None, 3: None, 4: None, 5: "345", 6: None}


def test_span_quality(spark):
    blank = reports(spark, [(9, "ab   cd", "1", "malware", "2", "5", None), (10, None, "1", "TOOL", "0", "1", "malware")])
    row = E.span_quality(spans(spark).union(blank), "row_id").first()
    # a span of blanks is valid, but gives no name; group 3 has no offsets
    assert row.asDict() == {"rows_processed": 9, "malware_mentions": 8, "invalid_spans": 5, "distinct_names": 2}


def test_labels(spark):
    rows = [(0, "", None, None, None, None, "MALWARE"), (1, "", None, None, None, None, None), (2, "", None, " malware", None, None, "TOOL")]
    got = E.derive_label(reports(spark, rows)).select("row_id", "true_label").collect()
    assert {tuple(r) for r in got} == {(0, 1), (1, 0), (2, 0)}


def test_malware_ids_skip_unreadable_ones(spark):
    rows = [(0, "", "7.0", "malware", None, None, None), (1, "", None, "malware", None, None, None), (2, "", "x", "malware", None, None, None)]
    df = reports(spark, rows)
    got = df.select("row_id", E.malware_ids(E.entity_array(df, ("label", "id")))).collect()
    assert [tuple(r) for r in sorted(got)] == [(0, [7]), (1, []), (2, [])]


def test_dictionary_with_aliases(spark):
    names = spark.createDataFrame([("Wanna-Cry",), ("wanna cry",), ("abc",), ("Ivy_v2",)], "name string")
    answers = spark.createDataFrame([("Wanna-Cry", "WCry, Wanna.Cry"), ("Ivy_v2", "No known aliases"), ("abc", "Long Name")], "name string, content string")
    assert {r[0] for r in D.build_terms(names).collect()} == {"wanna cry", "ivy v2"}
    assert {r[0] for r in D.build_terms(names, answers).collect()} == {"wanna cry", "ivy v2", "wcry"}
    assert D.alias_quality(names, answers).first().asDict() == {"asked": 3, "successful": 2, "failed": 1, "newly_added": 1}


def test_term_counters(spark):
    terms = spark.createDataFrame([("a",), (" a ",), (" ",), (None,), ("b",)], "term string")
    assert tuple(D.term_counters(terms).first()) == (3, 2, 2)


def test_minimal_terms(spark):
    terms = spark.createDataFrame([(t,) for t in ["mega", "omega x", "w32/virlock", "rat", "strategy", "a  b", "omega x"]], "term string")
    assert {r[0] for r in D.minimal_terms(terms).collect()} == {"mega", "rat"}
    raw = {r[0] for r in D.minimal_terms(terms, on_clean_text=False).collect()}
    assert raw == {"mega", "rat", "w32/virlock", "a  b"}
    words = spark.createDataFrame([("rat",), ("strategy",), ("big rat",)], "term string")
    assert {r[0] for r in D.minimal_terms(words, True, True).collect()} == {"rat", "strategy"}


def test_nested_entities(spark):
    text = "[{'id': 4, 'label': 'malware', 'start_offset': 1, 'end_offset': 3}, {'id': 5, 'label': 'TOOL'}]"
    df = spark.createDataFrame([(1, "xabz", text), (2, "t", None)], "row_id int, text string, entities string")
    got = nested_mentions(df, "row_id", keep=("text",))
    assert [tuple(r) for r in got.orderBy("idx").collect()] == [(1, "xabz", 1, 4, "malware", 1, 3), (1, "xabz", 2, 5, "TOOL", None, None)]
    assert [r[0] for r in D.names_of_mentions(got).collect()] == ["ab"]
    assert got.filter(F.col("row_id") == 2).count() == 0
