"""Registered queries over prediction and metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namesieve.operators import importance, metrics, models, selection
from namesieve.registry import views
from namesieve.registry.views import ctes, with_ctes

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def register(fn):
        name = fn.__name__.removesuffix("_query")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


BY = ["model", "split"]
CURVE = [
    *ctes("pred"),
    ("per_score", "SELECT model, split, y_score AS threshold, sum(y_true) AS p, sum(1 - y_true) AS q FROM pred GROUP BY ALL"),
    (
        "curve",
        "SELECT *, sum(p) OVER w AS tp, sum(q) OVER w AS fp, sum(p) OVER g AS pos, sum(q) OVER g AS neg FROM per_score "
        "WINDOW w AS (PARTITION BY model, split ORDER BY threshold DESC), g AS (PARTITION BY model, split)",
    ),
]
MM = [
    *CURVE,
    (
        "auc",
        "SELECT a.model, a.split, avg(CASE WHEN a.y_score > b.y_score THEN 1.0::DOUBLE WHEN a.y_score = b.y_score THEN 0.5::DOUBLE "
        "ELSE 0.0::DOUBLE END) AS roc_auc FROM pred a JOIN pred b ON a.model = b.model AND a.split = b.split AND a.y_true = 1 AND b.y_true = 0 "
        "GROUP BY a.model, a.split",
    ),
    ("ap", "SELECT model, split, coalesce(sum(p * tp / (tp + fp)) / nullif(max(pos), 0), 0) AS pr_auc FROM curve GROUP BY model, split"),
    (
        "counts",
        "SELECT model, split, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp, "
        "count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn, avg(CAST(y_true = y_pred AS INT)) AS accuracy FROM pred GROUP BY model, split",
    ),
    (
        "mm",
        "SELECT model, split, round(accuracy, 4) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision, "
        "round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS recall_pos, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS f1, "
        "round(roc_auc, 4) AS roc_auc, round(pr_auc, 4) AS pr_auc FROM counts LEFT JOIN auc USING (model, split) LEFT JOIN ap USING (model, split)",
    ),
]


def model_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.quality(views.predictions(spark, folder), "y_true", "y_pred", "y_score", BY)


@query(with_ctes("SELECT model, split, y_true, y_pred, count(*) AS count FROM pred GROUP BY ALL", *ctes("pred")))
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(views.predictions(spark, folder), "y_true", "y_pred", BY)


@query(with_ctes("SELECT model, split, accuracy, precision, recall_pos, f1 FROM mm", *MM))
def class_metrics(spark, folder):
    out = metrics.class_metrics(views.predictions(spark, folder), "y_true", "y_pred", BY)
    return out.selectExpr(*BY, *[f"round({c}, 4) AS {c}" for c in ("accuracy", "precision", "recall_pos", "f1")])


@query(with_ctes("SELECT model, split, roc_auc FROM mm", *MM))
def roc_auc(spark, folder):
    out = metrics.ranking_metrics(views.predictions(spark, folder), "y_true", "y_score", BY)
    return out.selectExpr(*BY, "round(roc_auc, 4) AS roc_auc")


@query(with_ctes("SELECT model, split, pr_auc FROM mm", *MM))
def average_precision(spark, folder):
    out = metrics.ranking_metrics(views.predictions(spark, folder), "y_true", "y_score", BY)
    return out.selectExpr(*BY, "round(pr_auc, 4) AS pr_auc")


@query(
    with_ctes("SELECT model, split, threshold, round(fp / nullif(neg, 0), 6) AS fpr, round(tp / nullif(pos, 0), 6) AS tpr FROM curve", *CURVE)
)
def roc_curve(spark, folder):
    out = metrics.roc_curve(views.predictions(spark, folder), "y_true", "y_score", BY)
    return out.selectExpr(*BY, "threshold", "round(fpr, 6) AS fpr", "round(tpr, 6) AS tpr")


@query(
    with_ctes(
        "SELECT model, split, threshold, round(tp / (tp + fp), 6) AS precision, round(tp / nullif(pos, 0), 6) AS recall, "
        "round(pos / (pos + neg), 6) AS base_rate FROM curve",
        *CURVE,
    )
)
def pr_curve(spark, folder):
    out = metrics.pr_curve(views.predictions(spark, folder), "y_true", "y_score", BY)
    return out.selectExpr(*BY, "threshold", *[f"round({c}, 6) AS {c}" for c in ("precision", "recall", "base_rate")])


@query(with_ctes("SELECT * FROM mm", *MM))
def quality_by_split(spark, folder):
    return model_metrics(spark, folder)


_SHOWN = ("accuracy", "precision", "recall_pos", "f1", "roc_auc", "pr_auc")


@query(
    with_ctes(
        "SELECT model, "
        + ", ".join(f"max({m}) FILTER (split = '{s}') AS {s}_{m}" for s in ("train", "validation") for m in _SHOWN)
        + " FROM mm GROUP BY model",
        *MM,
    )
)
def metrics_pivot(spark, folder):
    return selection.metrics_pivot(model_metrics(spark, folder), _SHOWN, ["train", "validation"])


@query(
    with_ctes("\nUNION ALL\n".join(f"SELECT model, split, '{m}' AS metric, {m} AS score FROM mm" for m in _SHOWN), *MM)
)
def metrics_long(spark, folder):
    return selection.metrics_long(model_metrics(spark, folder), _SHOWN)


_FLAGS = (
    "flags",
    "SELECT *, recall_pos >= 0.70::DOUBLE AS meets_recall, pr_auc >= 0.60::DOUBLE AS meets_pr_auc, f1 >= 0.55::DOUBLE AS meets_f1, "
    "recall_pos >= 0.70::DOUBLE AND pr_auc >= 0.60::DOUBLE AND f1 >= 0.55::DOUBLE AS meets_all FROM mm WHERE split = 'validation'",
)


@query(
    with_ctes("SELECT model, recall_pos, pr_auc, f1, meets_recall, meets_pr_auc, meets_f1, meets_all FROM flags", *MM, _FLAGS)
)
def threshold_flags(spark, folder):
    return selection.threshold_flags(model_metrics(spark, folder))


@query(
    with_ctes(
        "SELECT model, train_f1, val_f1, gap AS f1_gap_train_val, "
        + ", ".join(
            f"CASE WHEN gap > 0.10::DOUBLE THEN '{selection.FIT_TEXTS['over'][i]}' WHEN gap < -0.03::DOUBLE THEN "
            f"'{selection.FIT_TEXTS['under'][i]}' ELSE '{selection.FIT_TEXTS['stable'][i]}' END AS {n}"
            for i, n in enumerate(("fit_diagnosis", "suggested_action"))
        )
        + f", CASE WHEN meets_all THEN '{selection.CONCLUSIONS[0]}' ELSE '{selection.CONCLUSIONS[1]}' END AS validation_conclusion "
        "FROM (SELECT t.model, t.f1 AS train_f1, v.f1 AS val_f1, round(t.f1 - v.f1, 4) AS gap, meets_all FROM mm t JOIN flags v USING (model) "
        "WHERE t.split = 'train')",
        *MM,
        _FLAGS,
    )
)
def fit_diagnosis(spark, folder):
    return selection.fit_diagnosis(model_metrics(spark, folder))


_ACCEPTED = (
    "accepted",
    "SELECT *, meets_recall AND meets_precision AND better_than_dummy_pr_auc AND better_than_dummy_f1 AS meets_minimum_business_framework "
    "FROM (SELECT m.model, m.recall_pos AS val_recall_pos, m.precision AS val_precision, m.f1 AS val_f1, m.pr_auc AS val_pr_auc, "
    "m.recall_pos >= 0.70::DOUBLE AS meets_recall, m.precision >= 0.40::DOUBLE AS meets_precision, "
    "m.pr_auc > d.pr_auc AS better_than_dummy_pr_auc, m.f1 > d.f1 AS better_than_dummy_f1 "
    "FROM mm m, mm d WHERE m.split = 'validation' AND d.split = 'validation' AND d.model = 'de')",
)


@query(with_ctes("SELECT * FROM accepted", *MM, _ACCEPTED))
def acceptance(spark, folder):
    return selection.acceptance(model_metrics(spark, folder), "de")


@query(
    with_ctes(
        f"SELECT model AS recommended_baseline_model, CASE WHEN meets_minimum_business_framework THEN '{selection.REASONS[0]}' "
        f"ELSE '{selection.REASONS[1]}' END AS reason FROM accepted ORDER BY meets_minimum_business_framework DESC, val_pr_auc DESC, "
        "val_f1 DESC, val_recall_pos DESC, model LIMIT 1",
        *MM,
        _ACCEPTED,
    )
)
def recommend_baseline(spark, folder):
    return selection.recommend_baseline(selection.acceptance(model_metrics(spark, folder), "de"))


@query(
    with_ctes(
        "SELECT b.model AS baseline, b.f1 AS baseline_f1, t.model AS tuned, t.f1 AS tuned_f1, t.f1 > b.f1 + 1e-8::DOUBLE AS tuned_is_better, "
        "CASE WHEN t.f1 > b.f1 + 1e-8::DOUBLE THEN t.model ELSE b.model END AS selected_model FROM "
        "(SELECT * FROM mm WHERE split = 'train' ORDER BY pr_auc DESC, recall_pos DESC, model LIMIT 1) b, "
        "(SELECT * FROM mm WHERE split = 'validation' ORDER BY f1 DESC, model LIMIT 1) t",
        *MM,
    )
)
def select_model(spark, folder):
    quality = model_metrics(spark, folder)
    return selection.select_model(quality.where("split = 'train'"), quality.where("split = 'validation'"))


@query(
    with_ctes(
        "SELECT id, round((y_score + (0.5::DOUBLE + y_pred) / 2 + sqrt(y_score)) / 3, 6) AS y_score, "
        "CAST(round((y_score + (0.5::DOUBLE + y_pred) / 2 + sqrt(y_score)) / 3, 9) > 0.5::DOUBLE AS INT) AS y_pred FROM pred",
        *ctes("pred"),
    )
)
def soft_vote(spark, folder):
    """Mean of three probability columns."""
    base = views.predictions(spark, folder).selectExpr("id", "y_score AS p1", "(0.5D + y_pred) / 2 AS p2", "sqrt(y_score) AS p3")
    voted = models.soft_vote(base, ["p1", "p2", "p3"])
    return voted.selectExpr("id", "round(y_score, 6) AS y_score", "y_pred")


# ---- feature importance --------------------------------------------------------------------

_SUPPLIERS = (
    "per_supplier",
    "SELECT l_suppkey, CASE WHEN l_suppkey % 2 = 0 THEN 'num__' ELSE 'cat__' END || 's' || (l_suppkey // 3) || '_' || l_suppkey AS feature, "
    "CASE WHEN l_suppkey % 6 = 0 THEN 0.0::DOUBLE ELSE round(abs(avg(l_discount) - 0.05::DOUBLE), 6) END AS abs_coef, "
    "CASE WHEN l_suppkey % 6 = 0 THEN 0.0::DOUBLE ELSE round(sum(l_tax), 4) END AS tree_importance, "
    "CASE WHEN l_suppkey % 12 = 0 THEN 0.0::DOUBLE ELSE round(avg(l_quantity) / 100, 6) END AS perm_importance_mean FROM lineitem GROUP BY l_suppkey",
)


def importances(spark: SparkSession, folder: str) -> DataFrame:
    """Three importance columns per supplier, standing for the features of a wide model."""
    return (
        views.table(spark, folder, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.expr("avg(l_discount) AS d"), F.expr("sum(l_tax) AS t"), F.expr("avg(l_quantity) AS q"))
        .selectExpr(
            "concat(if(l_suppkey % 2 = 0, 'num__', 'cat__'), 's', l_suppkey div 3, '_', l_suppkey) AS feature",
            "if(l_suppkey % 6 = 0, 0D, round(abs(d - 0.05D), 6)) AS abs_coef",
            "if(l_suppkey % 6 = 0, 0D, round(t, 4)) AS tree_importance",
            "if(l_suppkey % 12 = 0, 0D, round(q / 100, 6)) AS perm_importance_mean",
        )
    )


_SHORT = (
    "CASE WHEN starts_with(feature, 'num__') THEN substr(feature, 6) WHEN starts_with(feature, 'cat__') "
    "THEN split_part(substr(feature, 6), '_', 1) ELSE feature END"
)


@query(
    with_ctes(f"SELECT feature, split_part(feature, '__', -1) AS base, {_SHORT} AS short_base FROM per_supplier", _SUPPLIERS)
)
def base_feature_name(spark, folder):
    long, short = importance.base_feature_name("feature"), importance.base_feature_name("feature", short=True)
    return importances(spark, folder).selectExpr("feature", f"{long} AS base", f"{short} AS short_base")


@query(
    with_ctes(
        "SELECT *, CAST(in_logreg_top20 AS INT) + CAST(in_tree_top20 AS INT) + CAST(in_perm_top20 AS INT) AS votes FROM (SELECT feature, "
        "feature IN (SELECT f FROM a) AS in_logreg_top20, feature IN (SELECT f FROM b) AS in_tree_top20, "
        "feature IN (SELECT f FROM c) AS in_perm_top20 FROM (SELECT f AS feature FROM a UNION SELECT f FROM b UNION SELECT f FROM c))",
        _SUPPLIERS,
        ("a", f"SELECT {_SHORT} AS f FROM (SELECT feature FROM per_supplier ORDER BY abs_coef DESC, feature LIMIT 20)"),
        ("b", f"SELECT {_SHORT} AS f FROM (SELECT feature FROM per_supplier ORDER BY tree_importance DESC, feature LIMIT 20)"),
        ("c", "SELECT feature AS f FROM per_supplier ORDER BY perm_importance_mean DESC, feature LIMIT 20"),
    )
)
def importance_consensus(spark, folder):
    table = importances(spark, folder)
    return importance.importance_consensus(table, table, table)


@query(
    with_ctes(
        "SELECT feature FROM per_supplier WHERE perm_importance_mean <= 0 AND tree_importance = 0 AND abs_coef < 1e-6::DOUBLE", _SUPPLIERS
    )
)
def irrelevant_features(spark, folder):
    table = importances(spark, folder)
    return importance.irrelevant_features(table, table, table)
