"""Evaluating 0/1 predictions against 0/1 labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexvane.config import CLASS_NAMES


def confusion(df: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """One row ``(tn, fp, fn, tp)``; always all four, whatever classes occur."""
    t, p = F.col(true_col), F.col(pred_col)
    return df.agg(
        F.count_if((t == 0) & (p == 0)).alias("tn"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 1) & (p == 1)).alias("tp"),
    )


def confusion_grid(df: DataFrame, true_col: str, pred_col: str) -> DataFrame:
    """Two rows ``(true_label, pred_0, pred_1)``."""
    m = confusion(df, true_col, pred_col)
    rows = F.array(
        F.struct(F.lit(0).alias("true_label"), F.col("tn").alias("pred_0"), F.col("fp").alias("pred_1")),
        F.struct(F.lit(1).alias("true_label"), F.col("fn").alias("pred_0"), F.col("tp").alias("pred_1")),
    )
    return m.select(F.inline(rows))


def _ratio(part: Column, whole: Column) -> Column:
    """Quotient; a division by zero counts as 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _f1(hits: Column, false_pos: Column, false_neg: Column) -> Column:
    return _ratio(2 * hits, 2 * hits + false_pos + false_neg)


def report_of(matrix: DataFrame, names: tuple[str, str] = CLASS_NAMES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Report rows ``(*keep, class, precision, recall, f1, support)`` for each ``(tn, fp, fn, tp)`` row.

    Classes first, then ``accuracy`` (its value in all three measures),
    ``macro avg`` and ``weighted avg``.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    per_class = matrix.select(
        *keep,
        (tn + fp).alias("s0"),
        (fn + tp).alias("s1"),
        (tn + fp + fn + tp).alias("n"),
        _ratio(tn + tp, tn + fp + fn + tp).alias("acc"),
        _ratio(tn, tn + fn).alias("p0"),
        _ratio(tn, tn + fp).alias("r0"),
        _f1(tn, fn, fp).alias("f0"),
        _ratio(tp, tp + fp).alias("p1"),
        _ratio(tp, tp + fn).alias("r1"),
        _f1(tp, fp, fn).alias("f1_"),
    )

    def line(name: str, p: Column, r: Column, f: Column, support: str) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            F.col(support).alias("support"),
        )

    def macro(a: str, b: str) -> Column:
        return (F.col(a) + F.col(b)) / 2

    def weighted(a: str, b: str) -> Column:
        return _ratio(F.col(a) * F.col("s0") + F.col(b) * F.col("s1"), F.col("n"))

    acc = F.col("acc")
    lines = F.array(
        line(names[0], F.col("p0"), F.col("r0"), F.col("f0"), "s0"),
        line(names[1], F.col("p1"), F.col("r1"), F.col("f1_"), "s1"),
        line("accuracy", acc, acc, acc, "n"),
        line("macro avg", macro("p0", "p1"), macro("r0", "r1"), macro("f0", "f1_"), "n"),
        line("weighted avg", weighted("p0", "p1"), weighted("r0", "r1"), weighted("f0", "f1_"), "n"),
    )
    return per_class.select(*keep, F.inline(lines))


def classification_report(
    df: DataFrame, true_col: str, pred_col: str, names: tuple[str, str] = CLASS_NAMES
) -> DataFrame:
    """Per-class and averaged precision, recall and F1."""
    return report_of(confusion(df, true_col, pred_col), names)


def leakage_check(df: DataFrame, degree_col: str, true_col: str) -> DataFrame:
    """Confusion of "a malware node has a relation" with the target.

    Both come from the same labels: a non-zero degree implies the target, so
    ``fp`` is 0 on real reports and the graph model's score is inflated by it.
    """
    flagged = df.withColumn("_degree_flag", (F.coalesce(degree_col, F.lit(0)) > 0).cast("int"))
    return confusion(flagged, true_col, "_degree_flag")
