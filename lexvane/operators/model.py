"""Scaling, class weights and a penalized, class-weighted logistic model.

The model minimizes ``c * sum(weight * loss) + (|w|^2 + b^2) / 2``: the
intercept ``b`` is penalized like every other coefficient.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaling:
    """Mean and population deviation per feature; a constant feature has deviation 1."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def columns(self) -> list[Column]:
        """Scaled features; missing values count as 0 before scaling."""
        return [
            ((F.coalesce(F.col(f).cast("double"), F.lit(0.0)) - m) / d).alias(f)
            for f, m, d in zip(self.features, self.means, self.deviations)
        ]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(dict(zip(self.features, self.columns())))


def fit_scaling(df: DataFrame, features: list[str]) -> Scaling:
    """Scaling of the given rows, in one aggregation."""
    values = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]
    row = df.agg(*(F.avg(v) for v in values), *(F.stddev_pop(v) for v in values)).first()
    k = len(features)
    return Scaling(
        tuple(features), tuple(m or 0.0 for m in row[:k]), tuple(d or 1.0 for d in row[k:])
    )


def class_weights(df: DataFrame, label_col: str) -> DataFrame:
    """``(label, n, weight)`` with weight ``rows / (classes * n)``."""
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.agg(F.sum("n")).scalar()
    classes = counts.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", rows.cast("double") / (classes * F.col("n")))


@dataclass(frozen=True)
class LogisticFit:
    """A fitted model over unscaled features."""

    scaling: Scaling
    coefficients: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for column, weight in zip(self.scaling.columns(), self.coefficients):
            total = total + column * F.lit(weight)
        return total

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Add the 0/1 prediction (score above 0) as a plain projection."""
        return df.withColumn(name, (self.score() > 0).cast("int"))


def fit_logistic(
    train: DataFrame,
    features: list[str],
    label_col: str,
    c: float = 1.0,
    max_iter: int = 1000,
    tol: float = 1e-10,
) -> LogisticFit | None:
    """Fit on the training rows; None if they hold fewer than two classes.

    Rows with equal features and label are merged first, weighted by their
    number, which leaves the objective as it is and makes the fit independent
    of the number of rows for discrete features.
    """
    filled = train.select(
        F.col(label_col).cast("int").alias("_y"),
        *(F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features),
    )
    merged = filled.groupBy("_y", *features).agg(F.count(F.lit(1)).alias("_n"))
    merged = merged.persist()
    try:
        counts = dict(merged.groupBy("_y").agg(F.sum("_n")).collect())  # one row per class
        if len(counts) < 2:
            return None
        rows = sum(counts.values())
        scaling = _scaling_of_merged(merged, features, rows)
        weight = F.lit(0.0)
        for y, n in counts.items():
            weight = F.when(F.col("_y") == y, rows / (len(counts) * n)).otherwise(weight)
        return _fit_merged(merged, scaling, weight * F.col("_n"), c, max_iter, tol)
    finally:
        merged.unpersist()


def _scaling_of_merged(merged: DataFrame, features: list[str], rows: int) -> Scaling:
    """Weighted mean first, then the deviation around it (stable for large means)."""
    means = merged.agg(*(F.sum(F.col(f) * F.col("_n")) / rows for f in features)).first()
    spread = merged.agg(
        *(F.sqrt(F.sum((F.col(f) - m) * (F.col(f) - m) * F.col("_n")) / rows) for f, m in zip(features, means))
    ).first()
    return Scaling(tuple(features), tuple(means), tuple(d or 1.0 for d in spread))


def _fit_merged(merged, scaling, weight, c, max_iter, tol) -> LogisticFit:
    """Newton steps; gradient and curvature of a step are one aggregate over the merged rows.

    What reaches the driver is one row of numbers, about half the square of the
    number of features. A step that does not lower the objective is halved.
    """
    x = [*scaling.columns(), F.lit(1.0)]
    k = len(x)
    points = merged.select(*(v.alias(f"x{i}") for i, v in enumerate(x)), F.col("_y").cast("double").alias("y"), weight.alias("w"))
    cells = [(i, j) for i in range(k) for j in range(i, k)]

    def measured(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z = sum((F.col(f"x{i}") * float(b) for i, b in enumerate(beta)), F.lit(0.0))
        p = F.lit(1.0) / (1 + F.exp(-F.col("z")))
        # log(1 + exp(z)) - y z, without overflow
        loss = F.greatest(F.col("z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z")
        scored = points.withColumn("z", z).withColumn("p", p)
        sums = [F.sum(F.col("w") * loss)]
        sums += [F.sum(F.col("w") * (F.col("p") - F.col("y")) * F.col(f"x{i}")) for i in range(k)]
        sums += [F.sum(F.col("w") * F.col("p") * (1 - F.col("p")) * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in cells]
        row = list(scored.agg(*sums).first())
        curve = np.eye(k)
        for (i, j), value in zip(cells, row[1 + k :]):
            curve[i, j] += c * value
            curve[j, i] = curve[i, j]
        return c * row[0] + float(beta @ beta) / 2, c * np.array(row[1 : 1 + k]) + beta, curve

    beta = np.zeros(k)
    value, slope, curve = measured(beta)
    for _ in range(max_iter):
        step = np.linalg.solve(curve, slope)
        for _ in range(30):
            new = measured(beta - step)
            if new[0] <= value + 1e-12 * abs(value):
                break
            step = step / 2
        beta, (value, slope, curve) = beta - step, new
        if np.abs(step).max() <= tol * max(1.0, np.abs(beta).max()):
            break
    return LogisticFit(scaling, tuple(map(float, beta[:-1])), float(beta[-1]))
