"""The hook for a user's recognizer, in batches."""

from pyspark.sql import functions as F

from lexvane.operators.recognizer import recognizer_flag


def test_a_failing_row_voids_itself_only(spark):
    def load():
        def recognize(text):
            if "broken" in text:
                raise ValueError(text[:20])
            return ["ORG"] if "Acme" in text else ["DATE"]

        return recognize

    rows = [(i, t) for i, t in enumerate(["Acme", "broken Acme", None, "", "day", "x " * 100_000 + "Acme"] * 40)]
    docs = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    want = {i: int(bool(t) and "Acme" in t and "broken" not in t) for i, t in rows}
    for size in (1, 7, 256):
        got = docs.select("id", recognizer_flag(F.col("text"), load, ("ORG",), size).alias("flag"))
        assert {r["id"]: r["flag"] for r in got.collect()} == want
    assert docs.limit(0).select(recognizer_flag(F.col("text"), load, ("ORG",))).count() == 0
