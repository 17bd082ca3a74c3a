"""Evaluation tables for binary predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesieve.operators.ranking import running_totals


def ratio(top: str, bottom: str) -> str:
    """Quotient that is 0 where the denominator is 0."""
    return f"coalesce(try_divide({top}, {bottom}), 0D)"


def score_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score, best first: positives and negatives at and above it.

    Columns: threshold, here_pos, here_neg, tp, fp (both include the score), positives, negatives.
    """
    labelled = df.where(f"{label} IS NOT NULL")
    totals = running_totals(
        labelled, score, {"pos": f"CAST({label} = 1 AS BIGINT)", "neg": f"CAST({label} <> 1 AS BIGINT)"}, by, descending=True
    )
    return totals.selectExpr(
        *by,
        f"{score} AS threshold",
        "pos AS here_pos",
        "neg AS here_neg",
        "pos_before + pos AS tp",
        "neg_before + neg AS fp",
        "pos_all AS positives",
        "neg_all AS negatives",
    )


def ranking_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """``roc_auc`` (ties count half; null with one class) and ``pr_auc`` (average precision) per group."""
    curve = score_curve(df, label, score, by)
    # Negatives at this score lose against all positives above it and half of those level with it.
    cells = "(max(positives) * max(negatives))"
    return curve.groupBy(*by).agg(
        F.expr(f"CASE WHEN {cells} > 0 THEN sum(here_neg * (tp - here_pos / 2)) / {cells} END AS roc_auc"),
        F.expr(f"{ratio('sum(here_pos * tp / (tp + fp))', 'max(positives)')} AS pr_auc"),
    )


def roc_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at each threshold."""
    curve = score_curve(df, label, score, by)
    return curve.selectExpr(*by, "threshold", "try_divide(fp, negatives) AS fpr", "try_divide(tp, positives) AS tpr")


def pr_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at each threshold, with the base rate of the group."""
    curve = score_curve(df, label, score, by)
    return curve.selectExpr(
        *by,
        "threshold",
        "tp / (tp + fp) AS precision",
        "try_divide(tp, positives) AS recall",
        "positives / (positives + negatives) AS base_rate",
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per (true, predicted) class, in class order."""
    keys = [*by, label, prediction]
    return df.groupBy(*keys).agg(F.expr("count(*) AS count")).orderBy(*keys)


def class_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1, unrounded; 0 where undefined."""
    counts = df.groupBy(*by).agg(
        F.expr(f"count_if({label} = 1 AND {prediction} = 1) AS tp"),
        F.expr(f"count_if({label} <> 1 AND {prediction} = 1) AS fp"),
        F.expr(f"count_if({label} = 1 AND {prediction} <> 1) AS fn"),
        F.expr(f"count_if({label} = {prediction}) AS correct"),
        F.expr("count(*) AS n"),
    )
    return counts.selectExpr(
        *by,
        f"{ratio('correct', 'n')} AS accuracy",
        f"{ratio('tp', 'tp + fp')} AS precision",
        f"{ratio('tp', 'tp + fn')} AS recall_pos",
        f"{ratio('2 * tp', '2 * tp + fp + fn')} AS f1",
    )


METRICS = ("accuracy", "precision", "recall_pos", "f1", "roc_auc", "pr_auc")


def quality(df: DataFrame, label: str, prediction: str, score: str, by: Sequence[str], digits: int = 4) -> DataFrame:
    """All six metrics per group, rounded."""
    both = class_metrics(df, label, prediction, by).join(ranking_metrics(df, label, score, by), list(by), "left")
    return both.selectExpr(*by, *[f"round({n}, {digits}) AS {n}" for n in METRICS])
