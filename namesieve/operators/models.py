"""Classifiers: fitting, prediction, grid search, stacking and voting on MLlib."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from namesieve.operators import knn
from namesieve.operators.facts import LABEL
from namesieve.operators.features import feature_pipeline
from namesieve.operators.kernel import SIZE, RandomFourierFeatures, scaled_gamma
from namesieve.operators.metrics import class_metrics, quality, ranking_metrics
from namesieve.operators.ranking import one_row, shuffled_rank
from namesieve.operators.splits import class_weights, stratified_folds
from namesieve.plans.storage import written

SEED = 42
# Trees grow as deep as the library allows unless told otherwise, on that many candidate splits of a feature.
DEEPEST, MAX_BINS = 30, 128
ID = "entity_id"

# Names, default parameters and parameter grids of the compared models.
DEFAULTS = {
    "baseline_0_dummy": {},
    "baseline_1_logreg": {"C": 1.0},
    "baseline_2_tree": {"max_depth": 3, "min_leaf": 50},
    "baseline_3_rf": {"trees": 100},
    "baseline_4_gb": {"rounds": 100},
    "baseline_5_svm": {"C": 1.0, "size": SIZE},
    "baseline_6_knn": {"k": 5},
}
GRIDS = {
    "baseline_1_logreg": {"C": [0.01, 0.1, 1.0]},
    "baseline_2_tree": {"max_depth": [3, 5, 7]},
    "baseline_3_rf": {"trees": [50, 100]},
    "baseline_4_gb": {"rounds": [50, 100]},
    "baseline_5_svm": {"C": [0.1, 1.0]},
    "baseline_6_knn": {"k": [3, 5, 7]},
}
LINEAR_MARGIN = "linear_svm"
MARGIN = ("baseline_5_svm", LINEAR_MARGIN)
ENSEMBLE = ("baseline_1_logreg", "baseline_2_tree", "baseline_3_rf")
STACKING, VOTING = "ensemble_stacking", "ensemble_voting"

Predictor = Callable[[DataFrame], DataFrame]


def in_parallel(tasks: Sequence[Callable], threads: int = 8) -> list:
    """Run independent fits at the same time; each is a series of Spark jobs with little work on the driver."""
    with ThreadPool(min(threads, max(1, len(tasks)))) as pool:
        return pool.map(lambda task: task(), [inheritable_thread_target(SparkSession.active())(t) for t in tasks])


def with_class_weight(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Add the balanced weight of each row's class; the weight table has one row per class."""
    weights = class_weights(train, label).selectExpr(label, "weight AS class_weight")
    return train.join(F.broadcast(weights), label)


def majority_model(train: DataFrame, label: str = LABEL) -> Predictor:
    """Always the most frequent class (the smallest of several) with a constant score."""
    counts = train.groupBy(label).agg(F.expr("count(*) AS n"))
    usual = one_row(counts.agg(F.expr(f"min_by({label}, struct(-n, {label})) AS y")))
    return lambda df: df.withColumn("_usual", usual).selectExpr(
        *df.columns, "CAST(_usual.y AS DOUBLE) AS y_score", "CAST(_usual.y AS INT) AS y_pred"
    )


def _estimator(kind: str, params: dict, rows: int, label: str):
    common = {"featuresCol": "features", "labelCol": label}
    if kind == "baseline_1_logreg":
        # Sum of weighted losses times C equals the mean loss with this penalty.
        penalty = 1.0 / (params["C"] * max(rows, 1))
        return LogisticRegression(**common, weightCol="class_weight", maxIter=1000, regParam=penalty, standardization=False)
    if kind == "baseline_2_tree":
        return DecisionTreeClassifier(**common, maxDepth=params["max_depth"], minInstancesPerNode=params["min_leaf"], maxBins=MAX_BINS, seed=SEED)
    if kind == "baseline_3_rf":
        return RandomForestClassifier(**common, numTrees=params["trees"], maxDepth=params.get("max_depth", DEEPEST), maxBins=MAX_BINS, seed=SEED)
    if kind == "baseline_4_gb":
        return GBTClassifier(**common, maxIter=params["rounds"], stepSize=0.1, maxDepth=3, maxBins=MAX_BINS, seed=SEED)
    if kind in MARGIN:
        return LinearSVC(**common, maxIter=100, regParam=1.0 / (params["C"] * max(rows, 1)), standardization=False)
    raise ValueError(f"unknown model: {kind}")


def predictor(model, score_column: str = "probability") -> Predictor:
    """Prediction of a fitted MLlib classifier as ``y_score`` and ``y_pred``."""

    def predict(df: DataFrame) -> DataFrame:
        out = model.transform(df).withColumn("y_score", vector_to_array(score_column)[1])
        return out.withColumn("y_pred", F.col("prediction").cast("int")).select(*df.columns, "y_score", "y_pred")

    return predict


def fit_model(kind: str, train: DataFrame, params: dict | None = None, label: str = LABEL, rows: int | None = None):
    """Fit one kind of classifier on ``train`` (features, label, class_weight); returns (predictor, MLlib model or None)."""
    params = {**DEFAULTS["baseline_5_svm" if kind == LINEAR_MARGIN else kind], **(params or {})}
    if kind == "baseline_0_dummy":
        return majority_model(train, label), None
    if kind == "baseline_6_knn":
        points = knn_points(train, label)

        def predict(df: DataFrame) -> DataFrame:
            asked = df.select(F.col(ID).alias("query_id"), vector_to_array("features").alias("vector"))
            votes = knn.vote(knn.neighbours(points, asked, params["k"])).withColumnRenamed("query_id", ID)
            return df.join(votes, ID)

        return predict, None
    rows = train.count() if rows is None else rows
    if kind == "baseline_5_svm":
        gamma, inputs = scaled_gamma(train)
        kernel = RandomFourierFeatures(inputs=inputs, gamma=gamma, size=params["size"], seed=SEED)
        margin = _estimator(kind, params, rows, label).setFeaturesCol(kernel.getOutputCol()).fit(kernel.transform(train))
        model = PipelineModel(stages=[kernel, margin])
    else:
        model = _estimator(kind, params, rows, label).fit(train)
    return predictor(model, "rawPrediction" if kind in MARGIN else "probability"), model


def soft_vote(df: DataFrame, scores: Sequence[str]) -> DataFrame:
    """Mean of probability columns; class 1 above one half."""
    mean = f"({' + '.join(scores)}) / {len(scores)}"
    kept = [c for c in df.columns if c not in scores]
    return df.selectExpr(*kept, f"{mean} AS y_score", f"CAST(round({mean}, 9) > 0.5D AS INT) AS y_pred")


def _base_scores(df: DataFrame, fitted: dict[str, Predictor]) -> DataFrame:
    for name, predict in fitted.items():
        df = predict(df).withColumnRenamed("y_score", f"p_{name}").drop("y_pred")
    return df


def voting_model(train: DataFrame, params: dict[str, dict], label: str = LABEL, rows: int | None = None) -> Predictor:
    """Mean probability of the base models."""
    fits = in_parallel([lambda n=n: fit_model(n, train, params.get(n), label, rows)[0] for n in ENSEMBLE])
    fitted = dict(zip(ENSEMBLE, fits))
    return lambda df: soft_vote(_base_scores(df, fitted), [f"p_{n}" for n in ENSEMBLE])


def stacking_model(train: DataFrame, params: dict[str, dict], label: str = LABEL, folds: int = 3, rows: int | None = None) -> Predictor:
    """Balanced logistic regression over out-of-fold probabilities of the base models."""
    folded = written(stratified_folds(train, folds, label, ID), "folds")
    rows = folded.count() if rows is None else rows
    part = rows * (folds - 1) // folds

    def held_out(fold: int, name: str) -> Predictor:
        return fit_model(name, folded.where(f"fold <> {fold}"), params.get(name), label, part)[0]

    cells = [(f, n) for f in range(folds) for n in ENSEMBLE]
    fits = dict(zip(cells, in_parallel([lambda f=f, n=n: held_out(f, n) for f, n in cells])))
    parts = [_base_scores(folded.where(f"fold = {f}"), {n: fits[f, n] for n in ENSEMBLE}) for f in range(folds)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    assembler = VectorAssembler(inputCols=[f"p_{n}" for n in ENSEMBLE], outputCol="stacked")
    final = _estimator("baseline_1_logreg", {"C": 1.0}, rows, label).setFeaturesCol("stacked").fit(assembler.transform(every))
    whole = dict(zip(ENSEMBLE, in_parallel([lambda n=n: fit_model(n, train, params.get(n), label, rows)[0] for n in ENSEMBLE])))
    last = predictor(final)

    def predict(df: DataFrame) -> DataFrame:
        return last(assembler.transform(_base_scores(df, whole))).select(*df.columns, "y_score", "y_pred")

    return predict


def knn_points(train: DataFrame, label: str) -> DataFrame:
    return train.select(F.col(ID).alias("id"), F.col(label).alias("label"), vector_to_array("features").alias("vector"))


def union_written(parts: Sequence[DataFrame]) -> DataFrame:
    """All predictions in one written table, so that metrics do not run the models again."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return written(every, "predictions")


def grid_points(grids: dict[str, dict[str, list]] = GRIDS) -> list[tuple[str, dict]]:
    return [(kind, {name: v}) for kind, grid in grids.items() for name, values in grid.items() for v in values]


def grid_search(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], grids=GRIDS, folds: int = 3, label: str = LABEL
) -> DataFrame:
    """Mean average precision of each grid point over stratified folds: ``model, params, cv_pr_auc``.

    The feature steps are fitted once per fold, not per point; the fits run at the same time; all
    predictions are scored by one job.
    """
    folded = written(stratified_folds(train, folds, label, ID), "folds")
    points = grid_points(grids)

    def prepare(fold: int) -> tuple[DataFrame, DataFrame, int]:
        seen = folded.where(f"fold <> {fold}")
        steps = feature_pipeline(seen, numeric, categorical)
        fitted = written(with_class_weight(steps.transform(seen), label).select(ID, label, "features", "class_weight"), "fold-fit")
        held = written(steps.transform(folded.where(f"fold = {fold}")).select(ID, label, "features"), "fold-held")
        return fitted, held, fitted.count()

    prepared = in_parallel([lambda f=f: prepare(f) for f in range(folds)])

    def scores(fold: int, kind: str, every: list[dict]) -> list[tuple[dict, DataFrame]]:
        fitted, held, rows = prepared[fold]
        if kind == "baseline_6_knn":
            # The nearest of the largest k contain those of every smaller one.
            asked = held.select(F.col(ID).alias("query_id"), vector_to_array("features").alias("vector"))
            found = knn.neighbours(knn_points(fitted, label), asked, max(p["k"] for p in every))
            found = written(found, "neighbours")
            votes = [knn.vote(found.where(f"rank <= {p['k']}")).withColumnRenamed("query_id", ID) for p in every]
            return [(p, held.join(v, ID)) for p, v in zip(every, votes)]
        return [(p, fit_model(kind, fitted, p, label, rows)[0](held)) for p in every]

    # A model with several points per fold is one task for nearest neighbours and one task per point otherwise.
    tasks = [(f, kind, [p]) for f in range(folds) for kind, p in points if kind != "baseline_6_knn"]
    neighbours = [p for kind, p in points if kind == "baseline_6_knn"]
    tasks += [(f, "baseline_6_knn", neighbours) for f in range(folds) if neighbours]
    tasks.sort(key=lambda t: t[1] != "baseline_4_gb")  # the longest first
    done = in_parallel([lambda t=t: scores(*t) for t in tasks])
    parts = [
        df.selectExpr(f"'{kind}' AS model", f"'{json.dumps(params)}' AS params", f"{fold} AS fold", label, "y_score")
        for (fold, kind, _), result in zip(tasks, done)
        for params, df in result
    ]
    every = union_written(parts)
    per_fold = ranking_metrics(every, label, "y_score", ["model", "params", "fold"])
    out = per_fold.groupBy("model", "params").agg(F.expr("round(avg(pr_auc), 4) AS cv_pr_auc"))
    return out.orderBy("model", F.desc("cv_pr_auc"), "params")


def best_params(grid: DataFrame) -> dict[str, tuple[dict, float]]:
    """Best point per model; one row per model reaches the driver."""
    best = grid.groupBy("model").agg(F.expr("min_by(struct(params, cv_pr_auc), struct(-cv_pr_auc, params)) AS b")).collect()
    return {r["model"]: (json.loads(r["b"]["params"]), r["b"]["cv_pr_auc"]) for r in best}


def prepared_rows(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = LABEL):
    """Feature steps fitted on the training split, and all rows with ``features`` and ``class_weight``."""
    steps = feature_pipeline(rows.where("split = 'train'"), numeric, categorical)
    weights = class_weights(rows.where("split = 'train'"), label).selectExpr(label, "weight AS class_weight")
    return steps, steps.transform(rows).join(F.broadcast(weights), label).select(ID, label, "split", "features", "class_weight")


def evaluate_models(
    prepared: DataFrame, kinds: Sequence[str] = tuple(DEFAULTS), label: str = LABEL, splits: Sequence[str] = ("validation", "test")
) -> DataFrame:
    """Fit each kind on the training split and score the others: one row per model and split."""
    data = written(prepared, "prepared")
    train = data.where("split = 'train'")
    rows = train.count()
    fits = in_parallel([lambda k=k: fit_model(k, train, None, label, rows)[0] for k in kinds])
    asked = data.where("split IN ({})".format(", ".join(f"'{s}'" for s in splits)))
    parts = [p(asked).selectExpr(f"'{k}' AS model", "split", label, "y_score", "y_pred") for k, p in zip(kinds, fits)]
    return quality(union_written(parts), label, "y_pred", "y_score", ["model", "split"])


def compare_models(
    rows: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    grids=GRIDS,
    label: str = LABEL,
    kinds: Sequence[str] = tuple(DEFAULTS),
) -> tuple[DataFrame, dict[str, Predictor], dict]:
    """Tune, refit and time the models of ``kinds`` and both ensembles; validation metrics, best PR-AUC first.

    Returns the table, the fitted predictors and the fitted MLlib models (with the feature steps as ``"features"``).
    """
    grids = {k: g for k, g in grids.items() if k in kinds}
    best = best_params(grid_search(rows.where("split = 'train'"), numeric, categorical, grids, label=label))
    steps, prepared = prepared_rows(rows, numeric, categorical, label)
    data = written(prepared, "prepared")
    train = data.where("split = 'train'")
    count = train.count()
    params = {name: best[name][0] for name in best}
    fitted, models, runs = {}, {"features": steps}, []
    for kind in kinds:
        start = time.perf_counter()
        fitted[kind], models[kind] = fit_model(kind, train, params.get(kind), label, count)
        runs.append((kind, best[kind][1] if kind in best else None, round(time.perf_counter() - start, 4)))
    for name, build in ((STACKING, stacking_model), (VOTING, voting_model)):
        start = time.perf_counter()
        fitted[name] = build(train, params, label, rows=count)
        runs.append((name, None, round(time.perf_counter() - start, 4)))
    asked = data.where("split = 'validation'")
    every = union_written([p(asked).selectExpr(f"'{n}' AS model", label, "y_score", "y_pred") for n, p in fitted.items()])
    times = rows.sparkSession.createDataFrame(runs, "model string, best_score_cv_pr_auc double, train_time_seconds double")
    metrics = quality(every, label, "y_pred", "y_score", ["model"])
    table = times.join(metrics, "model").select(
        "model", "best_score_cv_pr_auc", "accuracy", "precision", "recall_pos", "f1", "pr_auc", "roc_auc", "train_time_seconds"
    )
    return table.orderBy(F.desc_nulls_last("pr_auc"), "model"), fitted, models


def learning_curve(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], sizes=(0.2, 0.4, 0.6, 0.8, 1.0), folds: int = 3, label: str = LABEL
) -> DataFrame:
    """F1 of the logistic model on growing parts of the training folds and on the held-out folds."""
    folded = written(shuffled_rank(stratified_folds(train, folds, label, ID), SEED + 2, ID, ["fold"], "_place"), "folds")

    def cell(fold: int, size: float) -> DataFrame:
        part = folded.where(f"fold <> {fold} AND _place <= group_size * {size}")
        steps = feature_pipeline(part, numeric, categorical)
        fitted = with_class_weight(steps.transform(part), label)
        predict, _ = fit_model("baseline_1_logreg", fitted, None, label)
        both = part.withColumn("part", F.lit("train")).unionByName(folded.where(f"fold = {fold}").withColumn("part", F.lit("val")))
        scored = predict(steps.transform(both).select(ID, label, "part", "features"))
        return scored.selectExpr(f"{size}D AS share", f"{fold} AS fold", "part", label, "y_pred")

    every = union_written(in_parallel([lambda f=f, s=s: cell(f, s) for s in sizes for f in range(folds)]))
    by_fold = class_metrics(every, label, "y_pred", ["share", "fold", "part"])
    train_rows = every.where("part = 'train'").groupBy("share").agg(F.expr(f"CAST(count(*) / {folds} AS BIGINT) AS train_size"))
    means = by_fold.groupBy("share").pivot("part", ["train", "val"]).agg(F.avg("f1"))
    return (
        means.join(train_rows, "share")
        .selectExpr("train_size", "train AS train_f1_mean", "val AS val_f1_mean", "train - val AS gap_train_minus_val")
        .orderBy("train_size")
    )


# Simpler and richer variants tried against over-fitting.
VARIANTS = {
    "logreg_stronger_reg": ("baseline_1_logreg", {"C": 0.5}),
    "logreg_lighter_reg": ("baseline_1_logreg", {"C": 2.0}),
    "tree_shallow": ("baseline_2_tree", {"max_depth": 2, "min_leaf": 80}),
    "tree_deeper": ("baseline_2_tree", {"max_depth": 5, "min_leaf": 30}),
}


def complexity_check(prepared: DataFrame, label: str = LABEL) -> DataFrame:
    """Train and validation metrics of the variants and the gap between the F1 values."""
    data = written(prepared, "prepared")
    train = data.where("split = 'train'")
    rows = train.count()
    fits = in_parallel([lambda v=v: fit_model(*[v[0], train, v[1], label, rows])[0] for v in VARIANTS.values()])
    asked = data.where("split <> 'test'")
    parts = [p(asked).selectExpr(f"'{n}' AS model", "split", label, "y_score", "y_pred") for n, p in zip(VARIANTS, fits)]
    q = quality(union_written(parts), label, "y_pred", "y_score", ["model", "split"])
    at = {s: f"max(CASE WHEN split = '{s}' THEN {{0}} END)" for s in ("train", "validation")}
    out = q.groupBy("model").agg(
        F.expr(at["train"].format("f1") + " AS train_f1"),
        *[F.expr(at["validation"].format(m) + f" AS val_{m}") for m in ("f1", "recall_pos", "precision", "pr_auc")],
    )
    return out.selectExpr("*", "round(train_f1 - val_f1, 4) AS f1_gap_train_val").orderBy(F.desc("val_f1"), "model")
