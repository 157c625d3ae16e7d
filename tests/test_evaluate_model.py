import numpy as np
import pytest
from pyspark.sql import functions as F

from lexvane.operators import evaluate as V
from lexvane.operators import model as L


def scored(spark, tn, fp, fn, tp):
    rows = spark.createDataFrame([(0, 0, tn), (0, 1, fp), (1, 0, fn), (1, 1, tp)], "y int, p int, n int")
    return rows.filter("n > 0").select("y", "p", F.explode(F.sequence(F.lit(1), "n")))


def report(spark, *cells):
    rows = V.classification_report(scored(spark, *cells), "y", "p").collect()
    return {r["class"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in rows}


def test_first_published_report(spark):
    r = report(spark, 30, 21, 1, 44)
    assert r["Malware (1)"] == pytest.approx((0.676923076923077, 0.9777777777777777, 0.8, 45), abs=1e-12)
    assert r["Not Malware (0)"] == pytest.approx((0.967741935483871, 0.5882352941176471, 0.7317073170731707, 51), abs=1e-12)
    assert r["accuracy"][0] == pytest.approx(0.7708333333333334, abs=1e-12)
    assert r["macro avg"] == pytest.approx((0.822332506203474, 0.7830065359477124, 0.7658536585365854, 96), abs=1e-12)
    assert r["weighted avg"] == pytest.approx((0.8314205955334989, 0.7708333333333334, 0.7637195121951219, 96), abs=1e-12)


def test_second_published_report(spark):
    r = report(spark, 51, 0, 1, 44)
    assert r["Malware (1)"][:3] == pytest.approx((1.0, 0.9777777777777777, 0.9887640449438202), abs=1e-12)
    assert r["macro avg"][2] == pytest.approx(0.9895276535398713, abs=1e-12)


def test_older_published_report(spark):
    r = report(spark, 2581, 1025, 2, 380)
    assert [round(x, 2) for x in r["Malware (1)"][:3]] == [0.27, 0.99, 0.43]
    assert round(r["accuracy"][0], 2) == 0.74


def test_divisions_by_zero_count_as_zero(spark):
    assert report(spark, 5, 0, 3, 0)["Malware (1)"] == (0.0, 0.0, 0.0, 3)


def test_grid_is_always_full(spark):
    grid = V.confusion_grid(scored(spark, 4, 0, 0, 0), "y", "p").collect()
    assert [tuple(r) for r in grid] == [(0, 4, 0), (1, 0, 0)]


def test_leakage_check(spark):
    df = spark.createDataFrame([(2, 1), (0, 1), (0, 0), (None, 0)], "d int, y int")
    assert tuple(V.leakage_check(df, "d", "y").first()) == (2, 0, 1, 1)


def newton(x, y, weights, c=1.0):
    """Minimum of the penalized loss, intercept penalized as well."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = c * x.T @ (weights * (p - y)) + w
        curvature = c * (x.T * (weights * p * (1 - p))) @ x + np.eye(len(w))
        w -= np.linalg.solve(curvature, gradient)
    return w


def test_fit_equals_newton(spark):
    rnd = np.random.default_rng(4)
    x = np.column_stack([rnd.integers(0, 2, 400), rnd.integers(0, 6, 400), np.full(400, 3.0)]).astype(float)
    y = (rnd.random(400) < 1 / (1 + np.exp(1.5 - 0.8 * x[:, 1]))).astype(int)
    df = spark.createDataFrame([(float(a), float(b), float(c), int(t)) for (a, b, c), t in zip(x, y)], "a double, b double, c double, y int")
    fit = L.fit_logistic(df, ["a", "b", "c"], "y")
    spread = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    counts = np.bincount(y)
    want = newton((x - x.mean(axis=0)) / spread, y, (len(y) / (2 * counts))[y])
    assert np.allclose([*fit.coefficients, fit.intercept], want, atol=1e-6)
    assert np.allclose(fit.scaling.deviations, spread)
    score = ((x - x.mean(axis=0)) / spread) @ want[:-1] + want[-1]
    got = [r["prediction"] for r in fit.predict(df).select("a", "b", "prediction").collect()]
    assert got == [int(s > 0) for s in score]


def test_one_class_gives_no_model(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1)], "a double, y int")
    assert L.fit_logistic(df, ["a"], "y") is None


def test_weights_and_scaling(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (6.0, 1), (None, 0)], "a double, y int")
    assert {tuple(r) for r in L.class_weights(df, "y").collect()} == {(0, 3, 4 / 6), (1, 1, 2.0)}
    scaling = L.fit_scaling(df, ["a"])
    values = np.array([1.0, 2.0, 6.0, 0.0])
    got = [r["a"] for r in scaling.apply(df).collect()]
    assert np.allclose(got, (values - values.mean()) / values.std())
