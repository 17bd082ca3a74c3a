"""Fitted models against conditions that they must meet, and against loops over the same rows."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from namesieve.operators import facts, importance, models, risk
from namesieve.operators.facts import LABEL
from namesieve.operators.features import feature_names, feature_pipeline
from namesieve.operators.kernel import RandomFourierFeatures, directions, scaled_gamma
from namesieve.operators.metrics import ranking_metrics
from namesieve.operators.splits import stratified_folds
from namesieve.sources import tables


def vectors(spark, x, y, split="train"):
    rows = [(i, int(t), split, [float(v) for v in r]) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, f"entity_id long, {LABEL} int, split string, x array<double>")
    return models.with_class_weight(df.withColumn("features", array_to_vector("x")).drop("x")).cache()


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(240, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(scale=0.8, size=240) > 0.6).astype(int)
    return x, y, vectors(spark, x, y)


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(2)
    rows = []
    for i in range(150):
        a, kind = rng.gauss(0, 1), rng.choice(["p", "q", None])
        rows.append((i, int(a + (kind == "p") + rng.gauss(0, 0.7) > 0.5), ("train", "train", "validation", "test")[i % 4], a if i % 9 else None, kind))
    return spark.createDataFrame(rows, f"entity_id long, {LABEL} int, split string, a double, kind string").cache()


def test_logistic_gradient_is_zero(blobs):
    """At the fitted point the gradient of C times the weighted losses plus half the squared norm vanishes."""
    x, y, df = blobs
    for c in (0.1, 1.0):
        _, model = models.fit_model("baseline_1_logreg", df, {"C": c})
        w, b = model.coefficients.toArray(), model.intercept
        weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
        error = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
        assert np.abs(c * x.T @ error + w).max() < 2e-2 and abs(error.sum()) < 2e-2


def test_shallow_tree_equals_the_best_split(blobs):
    """With one level the tree makes the split with the smallest impurity among the candidate thresholds."""
    x, y, df = blobs
    predict, model = models.fit_model("baseline_2_tree", df, {"max_depth": 1, "min_leaf": 20})
    root = model._call_java("rootNode")
    feature, threshold = root.split().featureIndex(), root.split().threshold()

    def impurity(j, t):
        left = x[:, j] <= t
        if min(left.sum(), (~left).sum()) < 20:
            return math.inf
        return sum(len(p) / len(y) * 2 * p.mean() * (1 - p.mean()) for p in (y[left], y[~left]))

    best = min(impurity(j, t) for j in range(3) for t in x[:, j])
    assert impurity(feature, threshold) <= best + 0.01
    share = {side: y[(x[:, feature] <= threshold) == side].mean() for side in (True, False)}
    got = predict(df).select("entity_id", "y_score").collect()
    assert all(abs(r["y_score"] - share[bool(x[r["entity_id"], feature] <= threshold)]) < 1e-9 for r in got)


def test_boosting_fits_better_with_more_rounds(blobs):
    _, _, df = blobs
    def loss(rounds):
        scored = models.fit_model("baseline_4_gb", df, {"rounds": rounds})[0](df)
        p = F.greatest(F.least("y_score", F.lit(1 - 1e-9)), F.lit(1e-9))
        return scored.agg(-F.avg(F.when(F.col(LABEL) == 1, F.log(p)).otherwise(F.log(1 - p)))).first()[0]
    few, more = loss(1), loss(8)
    assert more < few < math.log(2)


def ring(n, seed):
    rng = np.random.default_rng(seed)
    angle, radius = rng.uniform(0, 2 * np.pi, n), np.where(np.arange(n) % 2, 1.0, 3.0) + rng.normal(scale=0.3, size=n)
    return np.column_stack([radius * np.cos(angle), radius * np.sin(angle)]), np.arange(n) % 2


def test_kernel_margin_separates_a_ring(spark, tmp_path):
    train, test = vectors(spark, *ring(300, 1)), vectors(spark, *ring(200, 2), split="test")
    right = {}
    for kind in ("baseline_5_svm", models.LINEAR_MARGIN):
        predict, model = models.fit_model(kind, train)
        right[kind] = predict(test).where(f"y_pred = {LABEL}").count() / 200
        if kind == "baseline_5_svm":
            tables.write_model(model, str(tmp_path / "kernel"))
            again = models.predictor(tables.read_model(str(tmp_path / "kernel")), "rawPrediction")(test)
            same = predict(test).select("entity_id", "y_score").join(again.select("entity_id", F.col("y_score").alias("s")), "entity_id")
            assert same.where("abs(y_score - s) > 1e-9").isEmpty()
    assert right["baseline_5_svm"] > 0.95 and right[models.LINEAR_MARGIN] < 0.75


def test_kernel_map_error_is_bounded(spark, blobs):
    x, _, df = blobs
    gamma, inputs = scaled_gamma(df)
    assert inputs == 3 and abs(gamma - 1 / (3 * x.var())) < 1e-9
    exact = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    errors = []
    for size in (64, 1024):
        w, b = directions(3, size, gamma, 42)
        z = np.sqrt(2 / size) * np.cos(x @ w.T + b)
        # Hoeffding with a union bound over all pairs, at one in a thousand: terms lie in [-2, 2] / size.
        assert np.abs(z @ z.T - exact).max() < math.sqrt(8 * math.log(2 * len(x) ** 2 / 1e-3) / size)
        errors.append(np.abs(z @ z.T - exact).mean())
    assert errors[1] < errors[0] / 2
    stage = RandomFourierFeatures(inputs=3, gamma=gamma, size=1024, seed=42)
    got = {r["entity_id"]: r["z"] for r in stage.transform(df).select("entity_id", vector_to_array("kernel_features").alias("z")).collect()}
    assert all(np.allclose(got[i], z[i]) for i in range(len(x)))


def test_voting_is_the_mean_of_its_models(blobs):
    _, _, df = blobs
    params = {"baseline_3_rf": {"trees": 5, "max_depth": 4}}
    voted = {r["entity_id"]: r["y_score"] for r in models.voting_model(df, params)(df).collect()}
    parts = [{r["entity_id"]: r["y_score"] for r in models.fit_model(n, df, params.get(n))[0](df).collect()} for n in models.ENSEMBLE]
    assert all(abs(voted[i] - sum(p[i] for p in parts) / 3) < 1e-9 for i in voted)


def test_stacking_uses_scores_of_held_out_folds(blobs):
    """The stacked model equals one fitted by hand on out-of-fold scores, up to the optimiser's tolerance."""
    _, _, df = blobs
    params = {"baseline_3_rf": {"trees": 5, "max_depth": 4}}
    got = {r["entity_id"]: r["y_score"] for r in models.stacking_model(df, params, folds=2)(df).collect()}
    folded = models.written(stratified_folds(df, 2, LABEL, "entity_id"), "folds")
    part = df.count() // 2
    stacked, truth, weight = [], [], []
    for f in (0, 1):
        held = folded.where(f"fold = {f}")
        cols = [{r["entity_id"]: r["y_score"] for r in models.fit_model(n, folded.where(f"fold <> {f}"), params.get(n), LABEL, part)[0](held).collect()} for n in models.ENSEMBLE]
        for r in held.collect():
            stacked.append([c[r["entity_id"]] for c in cols])
            truth.append(r[LABEL])
            weight.append(r["class_weight"])
    z, t, v = np.array(stacked), np.array(truth), np.array(weight)
    w, b = np.zeros(3), 0.0
    for _ in range(60):  # Newton steps on the balanced loss with C = 1
        p = 1 / (1 + np.exp(-(z @ w + b)))
        zb = np.column_stack([z, np.ones(len(z))])
        hessian = (zb * (v * p * (1 - p))[:, None]).T @ zb + np.diag([1, 1, 1, 0])
        step = np.linalg.solve(hessian, zb.T @ (v * (p - t)) + np.append(w, 0))
        w, b = w - step[:3], b - step[3]
    whole = [{r["entity_id"]: r["y_score"] for r in models.fit_model(n, df, params.get(n))[0](df).collect()} for n in models.ENSEMBLE]
    assert all(abs(got[i] - 1 / (1 + math.exp(-(sum(wk * c[i] for wk, c in zip(w, whole)) + b)))) < 5e-3 for i in got)


def test_grid_search_equals_a_fold_loop(mixed):
    train = mixed.where("split = 'train'")
    grids = {"baseline_2_tree": {"max_depth": [1, 3]}, "baseline_6_knn": {"k": [3, 5]}}
    got = {(r["model"], r["params"]): r["cv_pr_auc"] for r in models.grid_search(train, ["a"], ["kind"], grids, folds=2).collect()}
    folded = models.written(stratified_folds(train, 2, LABEL, "entity_id"), "folds")
    for kind, point in models.grid_points(grids):
        values = []
        for f in (0, 1):
            seen = folded.where(f"fold <> {f}")
            steps = feature_pipeline(seen, ["a"], ["kind"])
            predict, _ = models.fit_model(kind, models.with_class_weight(steps.transform(seen)), point)
            scored = predict(steps.transform(folded.where(f"fold = {f}")))
            values.append(ranking_metrics(scored, LABEL, "y_score").first()["pr_auc"])
        assert abs(got[kind, models.json.dumps(point)] - sum(values) / 2) < 1e-4
    assert len(got) == 4


def test_features_equal_numpy(mixed):
    train = mixed.where("split = 'train'").collect()
    a = [r["a"] for r in train if r["a"] is not None]
    filled = np.array([np.median(a) if r["a"] is None else r["a"] for r in train])
    kinds = [r["kind"] for r in train if r["kind"]]
    usual = min(set(kinds), key=lambda k: (-kinds.count(k), k))
    out = feature_pipeline(mixed.where("split = 'train'"), ["a"], ["kind"]).transform(mixed)
    assert feature_names(out) == ["num__a", "cat__kind_p", "cat__kind_q"]
    for r in out.collect():
        x, kind = (np.median(a) if r["a"] is None else r["a"]), r["kind"] or usual
        wanted = [(x - filled.mean()) / filled.std(), float(kind == "p"), float(kind == "q")]
        assert np.allclose(r["features"].toArray(), wanted)


def test_saved_pipeline_predicts_the_same(mixed, tmp_path):
    steps, data = models.prepared_rows(mixed, ["a"], ["kind"])
    predict, tree = models.fit_model("baseline_2_tree", data.where("split = 'train'"), {"max_depth": 3, "min_leaf": 2})
    tables.write_model(PipelineModel(stages=[*steps.stages, tree]), str(tmp_path / "m"))
    again = models.predictor(tables.read_model(str(tmp_path / "m")))(mixed.select("entity_id", "a", "kind"))
    same = predict(data).select("entity_id", "y_score").join(again.select("entity_id", F.col("y_score").alias("s")), "entity_id")
    assert same.count() == mixed.count() and same.where("y_score <> s").isEmpty()


def test_permutation_finds_the_only_input_that_counts(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(2), rng.randrange(2)) for i in range(200)]
    df = spark.createDataFrame(rows, "entity_id long, a int, b int").selectExpr("*", f"a AS {LABEL}")
    table = importance.permutation_importance(df, ["a", "b"], lambda d: d.selectExpr("*", "a AS y_pred"), LABEL, "entity_id", repeats=5)
    got = {r["feature"]: (r["perm_importance_mean"], r["perm_importance_std"]) for r in table.collect()}
    assert got["b"] == (0.0, 0.0) and 0.3 < got["a"][0] < 0.7


def test_learning_curve_and_comparison(mixed):
    curve = models.learning_curve(mixed.where("split = 'train'"), ["a"], ["kind"], sizes=(0.5, 1.0), folds=2).collect()
    assert [r["train_size"] for r in curve] == sorted(r["train_size"] for r in curve) and len(curve) == 2
    assert all(abs(r["train_f1_mean"] - r["val_f1_mean"] - r["gap_train_minus_val"]) < 1e-9 and 0 < r["val_f1_mean"] <= 1 for r in curve)
    _, data = models.prepared_rows(mixed, ["a"], ["kind"])
    scored = models.evaluate_models(data, ["baseline_0_dummy", "baseline_6_knn"]).collect()
    knn = {r["split"]: r["accuracy"] for r in scored if r["model"] == "baseline_6_knn"}
    rows = data.collect()
    train = [r for r in rows if r["split"] == "train"]
    for split, accuracy in knn.items():
        held, right = [r for r in rows if r["split"] == split], 0
        for q in held:
            near = sorted(train, key=lambda t: (round(math.dist(q["features"].toArray(), t["features"].toArray()), 9), t["entity_id"]))[:5]
            right += (sum(t[LABEL] for t in near) / 5 > 0.5) == q[LABEL]
        assert abs(accuracy - right / len(held)) < 1e-4


def test_complexity_variants_equal_their_fits(mixed):
    _, data = models.prepared_rows(mixed, ["a"], ["kind"])
    data = data.cache()
    got = {r["model"]: r for r in models.complexity_check(data).collect()}
    assert set(got) == set(models.VARIANTS)
    for name, (kind, params) in models.VARIANTS.items():
        predict, _ = models.fit_model(kind, data.where("split = 'train'"), params)
        f1 = {}
        for split in ("train", "validation"):
            rows = predict(data.where(f"split = '{split}'")).collect()
            hits = sum(r["y_pred"] and r[LABEL] for r in rows)
            marked, real = sum(r["y_pred"] for r in rows), sum(r[LABEL] for r in rows)
            f1[split] = 2 * hits / (marked + real) if marked + real else 0.0
        assert got[name]["train_f1"] == pytest.approx(f1["train"], abs=1e-4)
        assert got[name]["val_f1"] == pytest.approx(f1["validation"], abs=1e-4)
        assert got[name]["f1_gap_train_val"] == pytest.approx(f1["train"] - f1["validation"], abs=2e-4)


def test_fitted_importances_agree_on_what_counts(spark):
    """One column decides the label, one is noise, one is constant: votes and irrelevance follow."""
    rng = random.Random(8)
    rows = [(i, i % 2, ("train", "train", "validation")[i % 3], float(i % 2) * 2 + rng.gauss(0, 0.1), rng.gauss(0, 1), 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, f"entity_id long, {LABEL} int, split string, deciding double, noise double, constant double").cache()
    columns = ["deciding", "noise", "constant"]
    steps, data = models.prepared_rows(df, columns, [])
    train = data.where("split = 'train'").cache()
    predict, linear = models.fit_model("baseline_1_logreg", train)
    _, tree = models.fit_model("baseline_2_tree", train)
    names = feature_names(data)
    by_coef = importance.importance_table(spark, names, [abs(x) for x in linear.coefficients], "abs_coef")
    by_tree = importance.importance_table(spark, names, tree.featureImportances.toArray(), "tree_importance")
    permuted = importance.permutation_importance(df.where("split = 'validation'"), columns, lambda d: predict(steps.transform(d)), LABEL, "entity_id", repeats=3)
    assert by_coef.first()["feature"] == by_tree.first()["feature"] == "num__deciding" and permuted.first()["feature"] == "deciding"
    assert {r["feature"]: r["tree_importance"] for r in by_tree.collect()} == {"num__deciding": 1.0, "num__noise": 0.0, "num__constant": 0.0}
    votes = {r["feature"]: r["votes"] for r in importance.importance_consensus(by_coef, by_tree, permuted, top=1).collect()}
    assert votes == {"deciding": 3}
    short = importance.base_feature_name("feature", short=True)
    plain = [t.selectExpr(f"{short} AS feature", c) for t, c in ((by_coef, "abs_coef"), (by_tree, "tree_importance"))]
    assert "constant" in {r["feature"] for r in importance.irrelevant_features(*plain, permuted).collect()} <= {"noise", "constant"}


def test_review_queue_of_ten_million_items(spark):
    runs = spark.sql("SELECT 1L AS entity_id, array(named_struct('priority', 'high', 'n', 3L), named_struct('priority', 'medium', 'n', 10000000L)) AS runs "
                     "UNION ALL SELECT 2L, CAST(array() AS array<struct<priority string, n bigint>>)")
    parts = facts.review_queue_parts(runs, items=100_000)
    sizes = parts.selectExpr("entity_id", "part", "size(from_json(review_queue_json, 'array<struct<priority string>>')) AS n").groupBy("entity_id").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.max("n").alias("most"))
    assert {tuple(r) for r in sizes.collect()} == {(1, 101, 10_000_003, 100_000), (2, 1, 0, 0)}
    first = parts.where("entity_id = 1 AND part = 0").first()["review_queue_json"]
    assert first.count('"high"') == 3 and first.startswith('[{"priority": "high"}, ')
    assert {r["entity_id"]: r["priority_score_raw"] for r in risk.priority_from_runs(runs).collect()} == {1: 1.5, 2: 0.0}
