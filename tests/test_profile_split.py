import numpy as np
import pytest
from pyspark.sql import functions as F

from lexvane.operators import profile as P
from lexvane.operators.split import can_stratify, stratified_split
from lexvane.operators.split import test_sizes as sizes_of


def test_summary_equals_numpy(spark):
    values = np.random.default_rng(1).normal(size=3001).round(2)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double")
    row = P.numeric_summary(df, ["x"]).first()
    want = [np.mean(values), np.std(values, ddof=1), values.min(), *np.quantile(values, P.QUARTILES), values.max()]
    assert row["count"] == 3001
    assert np.allclose(row[2:], want, atol=1e-12)
    near = P.numeric_summary(df, ["x"], approx=True).first()
    assert np.allclose(near[2:], want, atol=0.01)


@pytest.mark.parametrize("kind", ["spread", "one hot value", "far outliers"])
def test_quantiles_search_in_ranges(spark, monkeypatch, kind):
    monkeypatch.setattr(P, "ORDERED_VALUES", 5)
    rnd = np.random.default_rng(2)
    values = {
        "spread": rnd.normal(size=1500),
        "one hot value": np.concatenate([np.full(900, 7.0), rnd.integers(0, 500, 600)]).astype(float),
        "far outliers": np.concatenate([rnd.normal(size=700), 10.0 ** rnd.integers(1, 200, 100)]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = P.exact_quantiles(df, "x", (0.0, 0.25, 0.5, 0.9, 1.0), len(values))
    assert np.allclose(got, np.quantile(values, (0.0, 0.25, 0.5, 0.9, 1.0)), rtol=1e-12)


def test_summary_of_nothing(spark):
    row = P.numeric_summary(spark.createDataFrame([(None,)], "x double"), ["x"]).first()
    assert row["count"] == 0 and row["p50"] is None


def test_value_shares(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("c",)], "v string")
    assert [tuple(r) for r in P.value_shares(df, "v").collect()] == [("a", 2, 0.5), ("b", 1, 0.25), ("c", 1, 0.25)]
    assert {tuple(r) for r in P.class_counts(df, "v").collect()} == {("a", 2, 3), ("b", 1, 3), ("c", 1, 3)}


def labelled(spark, zeros, ones):
    return spark.range(zeros + ones).select("id", (F.col("id") >= zeros).cast("int").alias("y"))


def test_published_sizes():
    assert sizes_of({0: 251, 1: 225}, 0.2) == {0: 51, 1: 45}
    assert sizes_of({0: 15}, 0.2) == {0: 3}


def test_split_is_exact_and_stable(spark):
    df = labelled(spark, 251, 225)
    first = {r["id"]: r["is_test"] for r in stratified_split(df, "id", "y").collect()}
    again = {r["id"]: r["is_test"] for r in stratified_split(df.repartition(5), "id", "y").collect()}
    assert first == again and len(first) == 476
    assert sum(t for i, t in first.items() if i < 251) == 51
    assert sum(t for i, t in first.items() if i >= 251) == 45
    other = {r["id"]: r["is_test"] for r in stratified_split(df, "id", "y", seed=7).collect()}
    assert other != first and sum(other.values()) == 96


def test_split_with_equal_positions(spark):
    df = labelled(spark, 30, 20)
    got = stratified_split(df, "id", "y", order=F.lit(5).cast("bigint"), order_bits=32).collect()
    assert {r["id"] for r in got if r["is_test"]} == {*range(6), *range(30, 34)}


@pytest.mark.parametrize("zeros,ones", [(40, 1), (40, 0), (3, 0)])
def test_plain_split_where_classes_do_not_allow(spark, zeros, ones):
    rows = zeros + ones
    assert not can_stratify({k: n for k, n in ((0, zeros), (1, ones)) if n}, 0.2)
    got = stratified_split(labelled(spark, zeros, ones), "id", "y").collect()
    assert sum(r["is_test"] for r in got) == -(-rows // 5) and len(got) == rows


def test_split_needs_no_join_of_the_rows(spark):
    plan = stratified_split(labelled(spark, 50, 50), "id", "y")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
