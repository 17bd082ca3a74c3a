"""Comparing, judging and choosing models from metric tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesieve.operators.ranking import one_row

# Limits of the baseline check, the fit diagnosis and the acceptance framework.
BASELINE_MINIMUM = {"recall_pos": 0.70, "pr_auc": 0.60, "f1": 0.55}
OVERFIT_GAP = 0.10
UNDERFIT_GAP = -0.03
ACCEPT_RECALL = 0.70
ACCEPT_PRECISION = 0.40
TUNED_GAIN = 1e-8
FIT_TEXTS = {
    "over": ("sobreajuste probable", "reducir complejidad (menor profundidad o mayor regularización)"),
    "under": ("subajuste probable", "incrementar capacidad de modelo o mejorar features"),
    "stable": ("ajuste estable", "conservar configuración y validar en test"),
}
CONCLUSIONS = ("cumple umbrales baseline", "no cumple todos los umbrales baseline")
REASONS = (
    "Cumple marco mínimo y lidera PR-AUC/F1 entre elegibles",
    "No hay cumplimiento total; se selecciona mejor candidato actual y se sugiere iterar",
)


def metrics_pivot(quality: DataFrame, metrics: Sequence[str], splits: Sequence[str]) -> DataFrame:
    """One row per model, one column per metric and split. The splits are given, so no pass looks for them."""
    values = [F.first(m).alias(m) for m in metrics]
    return quality.groupBy("model").pivot("split", list(splits)).agg(*values)


def metrics_long(quality: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row per model, split and metric."""
    return quality.unpivot(["model", "split"], list(metrics), "metric", "score")


def threshold_flags(quality: DataFrame, split: str = "validation") -> DataFrame:
    """Which models reach the baseline minima."""
    flags = [f"{m} >= {limit}D AS meets_{m.removesuffix('_pos')}" for m, limit in BASELINE_MINIMUM.items()]
    every = " AND ".join(f"{m} >= {limit}D" for m, limit in BASELINE_MINIMUM.items())
    return quality.where(f"split = '{split}'").selectExpr("model", *BASELINE_MINIMUM, *flags, f"{every} AS meets_all")


def fit_diagnosis(quality: DataFrame) -> DataFrame:
    """Gap between training and validation F1, what it suggests, and whether the minima are met."""
    train = quality.where("split = 'train'").selectExpr("model", "f1 AS train_f1")
    flags = threshold_flags(quality).selectExpr("model", "f1 AS val_f1", "meets_all")
    joined = train.join(flags, "model").selectExpr("*", "round(train_f1 - val_f1, 4) AS f1_gap_train_val")
    return joined.selectExpr(
        "model", "train_f1", "val_f1", "f1_gap_train_val", *_diagnosis("f1_gap_train_val"),
        f"CASE WHEN meets_all THEN '{CONCLUSIONS[0]}' ELSE '{CONCLUSIONS[1]}' END AS validation_conclusion",
    )


def _diagnosis(gap: str) -> list[str]:
    def text(i: int) -> str:
        return (
            f"CASE WHEN {gap} > {OVERFIT_GAP}D THEN '{FIT_TEXTS['over'][i]}' WHEN {gap} < {UNDERFIT_GAP}D "
            f"THEN '{FIT_TEXTS['under'][i]}' ELSE '{FIT_TEXTS['stable'][i]}' END"
        )

    return [f"{text(0)} AS fit_diagnosis", f"{text(1)} AS suggested_action"]


def with_diagnosis(df: DataFrame, gap: str = "f1_gap_train_val") -> DataFrame:
    return df.selectExpr("*", *_diagnosis(gap))


def acceptance(quality: DataFrame, baseline: str, split: str = "validation") -> DataFrame:
    """Business minima, and better than the baseline model in PR-AUC and F1."""
    rows = quality.where(f"split = '{split}'")
    floor = one_row(rows.where(f"model = '{baseline}'").agg(F.expr("max(pr_auc) AS pr_auc"), F.expr("max(f1) AS f1")))
    checks = {
        "meets_recall": f"recall_pos >= {ACCEPT_RECALL}D",
        "meets_precision": f"precision >= {ACCEPT_PRECISION}D",
        "better_than_dummy_pr_auc": "pr_auc > _floor.pr_auc",
        "better_than_dummy_f1": "f1 > _floor.f1",
    }
    judged = rows.withColumn("_floor", floor).selectExpr(
        "model",
        *[f"round({m}, 4) AS val_{m}" for m in ("recall_pos", "precision", "f1", "pr_auc")],
        *[f"coalesce({c}, false) AS {n}" for n, c in checks.items()],
    )
    return judged.selectExpr("*", f"{' AND '.join(checks)} AS meets_minimum_business_framework").orderBy(
        F.desc("meets_minimum_business_framework"), "model"
    )


def recommend_baseline(accepted: DataFrame) -> DataFrame:
    """The best accepted model, or the best of all with another reason."""
    best = accepted.orderBy(
        F.desc("meets_minimum_business_framework"), *[F.desc(f"val_{m}") for m in ("pr_auc", "f1", "recall_pos")], "model"
    ).limit(1)
    reason = f"CASE WHEN meets_minimum_business_framework THEN '{REASONS[0]}' ELSE '{REASONS[1]}' END"
    return best.selectExpr("model AS recommended_baseline_model", f"{reason} AS reason")


def best_by_pr_auc(comparison: DataFrame) -> DataFrame:
    """The row with the largest PR-AUC."""
    return comparison.orderBy(F.desc_nulls_last("pr_auc"), "model").limit(1)


def select_model(baselines: DataFrame, tuned: DataFrame) -> DataFrame:
    """Best baseline by PR-AUC and recall; a tuned model replaces it only with a larger F1."""
    top = baselines.orderBy(F.desc_nulls_last("pr_auc"), F.desc_nulls_last("recall_pos"), "model").limit(1)
    rival = tuned.orderBy(F.desc_nulls_last("f1"), "model").limit(1)
    both = top.selectExpr("model AS baseline", "f1 AS baseline_f1").join(
        rival.selectExpr("model AS tuned", "f1 AS tuned_f1"), F.lit(True), "left"
    )
    better = f"coalesce(tuned_f1 > baseline_f1 + {TUNED_GAIN:.10f}D, false)"
    return both.selectExpr("*", f"{better} AS tuned_is_better", f"if({better}, tuned, baseline) AS selected_model")
