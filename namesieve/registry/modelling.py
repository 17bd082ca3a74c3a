"""Registered queries that prepare features and fit models on the labelled entity facts."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namesieve.operators import importance, models, splits
from namesieve.operators.facts import LABEL, joined_facts
from namesieve.operators.features import feature_names, feature_pipeline, impute_scale, route_columns
from namesieve.operators.profiling import candidate_features
from namesieve.plans.storage import shared_folder, written
from namesieve.registry import views
from namesieve.registry.risk import FACTS, SPLIT, labelled_facts
from namesieve.registry.views import with_ctes
from namesieve.sources import tables

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


NUMERIC = ["sources_evaluated", "sources_with_hallazgo", "max_identity_score", "evidence_items", "review_items"]
CATEGORICAL = ["entity_type", "country_code"]


def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled facts with their split, written once because every fit reads them again."""
    rows = splits.stratified_split(labelled_facts(spark, folder))
    return written(rows.select("entity_id", LABEL, "split", *NUMERIC, *CATEGORICAL), "split-facts")


def prepared(spark: SparkSession, folder: str) -> DataFrame:
    return models.prepared_rows(split_rows(spark, folder), NUMERIC, CATEGORICAL)[1]


# ---- feature steps -------------------------------------------------------------------------


def _scaled(column: str) -> str:
    filled = f"coalesce({column}, (SELECT quantile_cont({column}, 0.5) FROM gaps))"
    return (
        f"round(({filled} - (SELECT avg({filled}) FROM gaps)) / (SELECT stddev_pop({filled}) FROM gaps), 6) AS num__{column}"
    )


@query(
    with_ctes(
        f"SELECT entity_id, {_scaled('sources_evaluated')}, {_scaled('max_identity_score')}, coalesce(country_code, "
        "(SELECT country_code FROM gaps WHERE country_code IS NOT NULL GROUP BY country_code ORDER BY count(*) DESC, country_code LIMIT 1)) "
        "AS value__country_code FROM gaps",
        *FACTS,
        (
            "gaps",
            "SELECT cat.entity_id, CASE WHEN cat.entity_id % 11 = 0 THEN NULL ELSE country_code END AS country_code, "
            "srcf.sources_evaluated, evdf.max_identity_score FROM cat LEFT JOIN srcf USING (entity_id) LEFT JOIN evdf USING (entity_id)",
        ),
    )
)
def impute_scale_query(spark, folder):
    """Imputation and scaling on facts that still have their gaps."""
    rows = joined_facts(views.catalog(spark, folder), views.sources(spark, folder), views.evidence(spark, folder))
    rows = rows.withColumn("country_code", F.expr("if(entity_id % 11 = 0, NULL, country_code)"))
    prepared_columns = impute_scale(rows, ["sources_evaluated", "max_identity_score"], ["country_code"])
    return rows.selectExpr(
        "entity_id", *[f"round({e}, 6) AS {n}" if n.startswith("num__") else f"{e} AS {n}" for n, e in prepared_columns.items()]
    )


@query(
    with_ctes(
        "SELECT entity_id, array_to_string(list_concat("
        + ", ".join(
            f"list_transform((SELECT list(DISTINCT {c} ORDER BY {c}) FROM splits WHERE split = 'train'), "
            f"lambda x: CASE WHEN x = odd_{c} THEN '1.0' ELSE '0.0' END)"
            for c in CATEGORICAL
        )
        + "), ',') AS slots FROM odd",
        *SPLIT,
        (
            "odd",
            "SELECT entity_id, entity_type AS odd_entity_type, CASE WHEN entity_id % 13 = 0 THEN 'NOWHERE' ELSE country_code END "
            "AS odd_country_code FROM splits",
        ),
    )
)
def onehot_features(spark, folder):
    """Slots of the category columns; an unseen category has none."""
    rows = split_rows(spark, folder)
    steps = feature_pipeline(rows.where("split = 'train'"), [], CATEGORICAL)
    odd = rows.withColumn("country_code", F.expr("if(entity_id % 13 = 0, 'NOWHERE', country_code)"))
    return steps.transform(odd).select("entity_id", F.array_join(vector_to_array("features"), ",").alias("slots"))


@query()
def feature_pipeline_query(spark, folder):
    """Vector of every entity, from the candidate columns routed by type."""
    rows = written(splits.stratified_split(labelled_facts(spark, folder)), "labelled-facts")
    names = [c for c in candidate_features(rows) if c != "split"]
    steps = feature_pipeline(rows.where("split = 'train'"), *route_columns(rows, names))
    return steps.transform(rows).select(
        "entity_id", "split", F.array_join(F.transform(vector_to_array("features"), lambda x: F.round(x, 4)), ",").alias("features")
    )


_SLOTS = [*NUMERIC, "review_items_high"]


def _train(value: str) -> str:
    return f"(SELECT {value} FROM splits WHERE split = 'train')"


@query(
    with_ctes(
        " UNION ALL ".join(
            [
                f"SELECT entity_id, 'num__{c}' AS feature, round(({c} - {_train(f'avg({c})')}) / "
                f"{_train(f'CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END')}, 6) + 0 AS value FROM splits"
                for c in _SLOTS
            ]
            + [
                f"SELECT entity_id, 'cat__{c}_' || v, CASE WHEN {c} = v THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END "
                f"FROM splits, (SELECT DISTINCT {c} AS v FROM splits WHERE split = 'train')"
                for c in CATEGORICAL
            ]
        ),
        *SPLIT,
    )
)
def feature_slots(spark, folder):
    """Vector of every entity slot by slot, from the candidate columns routed by type."""
    rows = written(splits.stratified_split(labelled_facts(spark, folder)), "labelled-facts")
    names = [c for c in candidate_features(rows) if c != "split"]
    vectors = feature_pipeline(rows.where("split = 'train'"), *route_columns(rows, names)).transform(rows)
    slots = F.array(*map(F.lit, feature_names(vectors)))
    each = vectors.select("entity_id", F.explode(F.arrays_zip(slots.alias("feature"), vector_to_array("features").alias("value"))).alias("s"))
    return each.select("entity_id", F.col("s.feature").alias("feature"), (F.round("s.value", 6) + 0.0).alias("value"))


# ---- single models -------------------------------------------------------------------------


@query(
    with_ctes(
        f"SELECT entity_id, {LABEL}, u.y AS y_pred, CAST(u.y AS DOUBLE) AS y_score FROM splits, (SELECT {LABEL} AS y FROM splits "
        f"WHERE split = 'train' GROUP BY {LABEL} ORDER BY count(*) DESC, {LABEL} LIMIT 1) u WHERE split <> 'train'",
        *SPLIT,
    )
)
def model_majority(spark, folder):
    rows = splits.stratified_split(labelled_facts(spark, folder)).select("entity_id", LABEL, "split")
    predict = models.majority_model(rows.where("split = 'train'"))
    return predict(rows.where("split <> 'train'")).select("entity_id", LABEL, "y_pred", "y_score")


def _single(kind: str):
    def run(spark, folder):
        data = written(prepared(spark, folder), "prepared")
        predict, _ = models.fit_model(kind, data.where("split = 'train'"))
        return predict(data.where("split <> 'train'")).select("entity_id", "split", LABEL, "y_pred", "y_score")

    return run


for _name, _kind in (
    ("model_logreg", "baseline_1_logreg"),
    ("model_tree", "baseline_2_tree"),
    ("model_rf", "baseline_3_rf"),
    ("model_gbt", "baseline_4_gb"),
    ("model_linear_svc", models.LINEAR_MARGIN),
    ("model_kernel_svc", "baseline_5_svm"),
):
    QUERIES[_name] = _single(_kind)

def _gap(column: str) -> str:
    return f"pow((q.{column} - t.{column}) / (SELECT CASE WHEN stddev_pop({column}) > 0 THEN stddev_pop({column}) ELSE 1 END FROM splits WHERE split = 'train'), 2)"


def _other(column: str) -> str:
    """Squared distance of the slots of two categories: an unseen one has none."""
    seen = f"q.{column} IN (SELECT {column} FROM splits WHERE split = 'train')"
    return f"CASE WHEN q.{column} = t.{column} THEN 0 WHEN {seen} THEN 2 ELSE 1 END"


@query(
    with_ctes(
        "SELECT query_id, round(avg(label), 6) AS y_score, CAST(avg(label) > 0.5 AS INT) AS y_pred FROM (SELECT q.entity_id AS query_id, "
        f"t.{LABEL}::DOUBLE AS label, row_number() OVER (PARTITION BY q.entity_id ORDER BY round(sqrt("
        + " + ".join([*map(_gap, NUMERIC), *map(_other, CATEGORICAL)])
        + "), 9), t.entity_id) AS r FROM splits q JOIN splits t ON q.split = 'test' AND t.split = 'train') WHERE r <= 5 GROUP BY query_id",
        *SPLIT,
    )
)
def model_knn(spark, folder):
    """Vote of the five nearest training entities for each test entity, on the vectors of the fitted feature steps."""
    data = written(prepared(spark, folder), "prepared")
    predict, _ = models.fit_model("baseline_6_knn", data.where("split = 'train'"))
    voted = predict(data.where("split = 'test'"))
    return voted.selectExpr("entity_id AS query_id", "round(y_score, 6) AS y_score", "y_pred")


# ---- comparisons ---------------------------------------------------------------------------


@query()
def evaluate_models(spark, folder):
    return models.evaluate_models(prepared(spark, folder))


@query()
def grid_search(spark, folder):
    return models.grid_search(split_rows(spark, folder).where("split = 'train'"), NUMERIC, CATEGORICAL)


@query()
def model_stacking(spark, folder):
    data = written(prepared(spark, folder), "prepared")
    predict = models.stacking_model(data.where("split = 'train'"), {})
    return predict(data.where("split <> 'train'")).select("entity_id", "split", LABEL, "y_pred", "y_score")


@query()
def model_comparison(spark, folder):
    return models.compare_models(split_rows(spark, folder), NUMERIC, CATEGORICAL)[0]


@query()
def predictions(spark, folder):
    """True class, predicted class and score of the test split."""
    data = written(prepared(spark, folder), "prepared")
    predict, _ = models.fit_model("baseline_3_rf", data.where("split = 'train'"))
    return predict(data.where("split = 'test'")).selectExpr(f"{LABEL} AS y_true", "y_pred", "y_score")


@query()
def model_roundtrip_score(spark, folder):
    """Save the fitted steps and model as one pipeline, load it, and score rows of the candidate columns."""
    rows = split_rows(spark, folder)
    steps, data = models.prepared_rows(rows, NUMERIC, CATEGORICAL)
    _, tree = models.fit_model("baseline_2_tree", data.where("split = 'train'"))
    path = f"{shared_folder(spark)}/namesieve/model-{uuid.uuid4().hex}"
    tables.write_model(PipelineModel(stages=[*steps.stages, tree]), path)
    return models.predictor(tables.read_model(path))(rows.select("entity_id", *NUMERIC, *CATEGORICAL))


@query()
def run_manifest(spark, folder):
    """Metadata of a run with the confusion matrix of its test predictions."""
    scored = predictions(spark, folder)
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in scored.groupBy("y_true", "y_pred").agg(F.expr("count(*) AS n")).collect()}
    path = f"{shared_folder(spark)}/namesieve/manifest-{uuid.uuid4().hex}"
    manifest = {
        "timestamp": datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S"),
        "project_root": path,
        "inputs": {"tables": folder},
        "parameters": {"baseline_3_rf": models.DEFAULTS["baseline_3_rf"]},
        "candidate_features": [*NUMERIC, *CATEGORICAL],
        "selected_model": "baseline_3_rf",
        "confusion_matrix": [[cells.get((t, p), 0) for p in (0, 1)] for t in (0, 1)],
    }
    return tables.write_manifest(spark, path, manifest)


# ---- interpretability ----------------------------------------------------------------------


def _linear(data: DataFrame) -> DataFrame:
    _, model = models.fit_model("baseline_1_logreg", data.where("split = 'train'"))
    table = importance.importance_table(data.sparkSession, feature_names(data), model.coefficients.toArray(), "coef")
    return table.selectExpr("feature", "coef", "abs(coef) AS abs_coef").orderBy(F.desc("abs_coef"), "feature")


@query()
def importance_logreg(spark, folder):
    return _linear(written(prepared(spark, folder), "prepared")).limit(importance.TOP)


@query()
def importance_tree(spark, folder):
    data = written(prepared(spark, folder), "prepared")
    _, model = models.fit_model("baseline_2_tree", data.where("split = 'train'"))
    table = importance.importance_table(spark, feature_names(data), model.featureImportances.toArray(), "tree_importance")
    return table.limit(importance.TOP)


@query()
def importance_permutation(spark, folder):
    rows = split_rows(spark, folder)
    steps, data = models.prepared_rows(rows, NUMERIC, CATEGORICAL)
    predict, _ = models.fit_model("baseline_1_logreg", data.where("split = 'train'"))
    return importance.permutation_importance(
        rows.where("split = 'validation'"), [*NUMERIC, *CATEGORICAL], lambda df: predict(steps.transform(df)), LABEL, "entity_id"
    )


def _fitted_importances(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Importances of the linear model, the tree and the permutations, written: several results read them."""
    rows = split_rows(spark, folder)
    steps, data = models.prepared_rows(rows, NUMERIC, CATEGORICAL)
    data = written(data, "prepared")
    predict, _ = models.fit_model("baseline_1_logreg", data.where("split = 'train'"))
    _, tree = models.fit_model("baseline_2_tree", data.where("split = 'train'"))
    by_tree = importance.importance_table(spark, feature_names(data), tree.featureImportances.toArray(), "tree_importance")
    permuted = importance.permutation_importance(
        rows.where("split = 'validation'"), [*NUMERIC, *CATEGORICAL], lambda df: predict(steps.transform(df)), LABEL, "entity_id"
    )
    return _linear(data), by_tree, written(permuted, "permutation-importance")


@query()
def fitted_importance_consensus(spark, folder):
    """Votes of the three fitted importances for the columns of the entity facts."""
    return importance.importance_consensus(*_fitted_importances(spark, folder))


@query()
def fitted_irrelevant_features(spark, folder):
    """Columns of the entity facts that none of the three fitted importances sees; a column counts by its best slot."""
    linear, tree, permuted = _fitted_importances(spark, folder)
    base = importance.base_feature_name("feature", short=True)
    linear = linear.groupBy(F.expr(base).alias("feature")).agg(F.max("abs_coef").alias("abs_coef"))
    tree = tree.groupBy(F.expr(base).alias("feature")).agg(F.max("tree_importance").alias("tree_importance"))
    return importance.irrelevant_features(linear, tree, permuted)


@query()
def learning_curve(spark, folder):
    return models.learning_curve(split_rows(spark, folder).where("split = 'train'"), NUMERIC, CATEGORICAL)


@query()
def complexity_check(spark, folder):
    return models.complexity_check(prepared(spark, folder))
