import re

from pyspark.sql import functions as F

from lexvane.config import INFO_KEYWORDS
from lexvane.functions import text as X
from lexvane.functions.aliases import alias_terms


def one(spark, column, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("c"))).collect()]


def test_clean_text(spark):
    given = ["W32/Virlock, É_x!", None, "", "!!!", "a b\x1cc\n d", "x²y", "ÀB–C"]
    assert one(spark, X.clean_text, given) == ["w32 virlock é_x", "", "", "", "a b c d", "x²y", "àb c"]


def test_clean_text_equals_a_two_step_cleaning(spark):
    given = ["A.b,,c  d", " -x- ", "tab\tnew\nline", "_a_ b", "100%-ok", "naïve café—bar"]
    want = [re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", t.lower())).strip() for t in given]
    assert one(spark, X.clean_text, given) == want


def test_normalize_name(spark):
    given = ["  Poison-Ivy_v2.0 ", "W32/Virlock", "a \t.b"]
    assert one(spark, X.normalize_name, given) == ["poison ivy v2 0", "w32/virlock", "a b"]


def test_strip_all_blanks(spark):
    given = ["  x y　\n", "   ", "a"]
    assert one(spark, X.strip, given) == ["x y", "", "a"]


def test_whole_number(spark):
    given = ["3.7", "6", "x", "", None, "NaN", "1e3", "12d", "0x1f", " 5 ", "-2.9", "9007199254740993", "1e999"]
    want = [3, 6, None, None, None, None, 1000, None, None, 5, -2, 9007199254740993, None]
    assert one(spark, X.whole_number, given) == want


def test_malware_label(spark):
    assert one(spark, X.is_malware_label, ["Malware", " malware", None, "TOOL"]) == [True, False, False, False]


def test_contains_any_is_a_substring_test(spark):
    given = ["strategy", "", None, "a used car", "zzz"]
    assert one(spark, lambda c: X.contains_any(c, ["rat", "use", "used", ""]), given) == [1, 0, 0, 1, 0]
    every = one(spark, lambda c: X.contains_any(c, INFO_KEYWORDS), [f"zq {k} zq" for k in INFO_KEYWORDS])
    assert every == [1] * len(INFO_KEYWORDS)
    assert one(spark, lambda c: X.contains_any(c, []), ["x"]) == [0]


def test_alias_answers(spark):
    given = [
        "WCry, Wanna-Cry , ab",
        "No known aliases",
        "No known aliases, WCry",
        "  ",
        None,
        "I don't know, Real Name",
    ]
    assert one(spark, alias_terms, given) == [
        ["wcry", "wanna cry"],
        [],
        ["no known aliases", "wcry"],
        [],
        None,
        ["real name"],
    ]
