"""Second phase from source results and evidence to models and risk scores."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namesieve.operators import facts, features, models, profiling, risk, selection, splits
from namesieve.operators.catalog import entity_catalog
from namesieve.operators.facts import LABEL
from namesieve.operators.metrics import quality
from namesieve.sources import tables


def labelled_entities(catalog: DataFrame, sources: DataFrame, evidence: DataFrame) -> DataFrame:
    """Facts, decision and label per entity; the facts are written because the label reads them twice."""
    return facts.risk_label(tables.written(facts.entity_facts(catalog, sources, evidence), "entity-facts"))


def scored_entities(labelled: DataFrame) -> DataFrame:
    return risk.risk_levels(risk.risk_score(risk.priority_from_counts(labelled)))


def run(
    spark: SparkSession,
    source_results: str,
    evidence_items: str,
    out: str,
    grids=models.GRIDS,
    kinds: Sequence[str] = tuple(models.DEFAULTS),
) -> DataFrame:
    """Whole phase on two inputs (CSV, or Parquet by the name); writes comparison, test metrics, predictions, model, manifest and scores.

    Returns the model comparison.
    """
    sources = tables.read_input(spark, source_results, tables.SOURCE_RESULTS, position="_place")
    evidence = tables.read_input(spark, evidence_items, tables.EVIDENCE_ITEMS)
    catalog = entity_catalog(sources, "_place")
    labelled = tables.written(labelled_entities(catalog, sources.drop("_place"), evidence), "labelled-entities")
    # The urgent-review count only serves the risk score.
    modelled = labelled.drop("review_items_high")
    candidates = profiling.candidate_features(modelled)
    numeric, categorical = features.route_columns(modelled, candidates)
    rows = tables.written(splits.stratified_split(modelled), "split-entities")

    table, fitted, kept = models.compare_models(rows, numeric, categorical, grids, kinds=kinds)
    table = tables.written(table, "model-comparison")
    best = selection.best_by_pr_auc(table).first()["model"]
    tables.write_csv(table.orderBy(F.desc_nulls_last("pr_auc"), "model"), f"{out}/metrics_comparison")

    test = kept["features"].transform(rows.where("split = 'test'"))
    scored = tables.written(fitted[best](test).select("entity_id", LABEL, "y_pred", "y_score"), "test-predictions")
    tables.write_csv(scored.selectExpr(f"{LABEL} AS y_true", "y_pred", "y_score"), f"{out}/test_predictions")
    marked = scored.withColumn("model", F.lit(best))
    tables.write_csv(quality(marked, LABEL, "y_pred", "y_score", ["model"]), f"{out}/test_metrics")

    model_path = None
    if kept.get(best) is not None:
        model_path = f"{out}/best_model"
        tables.write_model(PipelineModel(stages=[*kept["features"].stages, kept[best]]), model_path)
    counts = scored.groupBy(LABEL, "y_pred").agg(F.expr("count(*) AS n")).collect()  # at most four rows
    cells = {(r[LABEL], r["y_pred"]): r["n"] for r in counts}
    manifest = {
        "timestamp": datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S"),
        "inputs": {"source_results": source_results, "evidence_items": evidence_items},
        "project_root": out,
        "parameters": {"grids": grids, "kinds": list(kinds)},
        "candidate_features": candidates,
        "selected_model": best,
        "model_path": model_path,
        "test_metrics_path": f"{out}/test_metrics",
        "test_predictions_path": f"{out}/test_predictions",
        "confusion_matrix": [[cells.get((t, p), 0) for p in (0, 1)] for t in (0, 1)],
    }
    tables.write_manifest(spark, f"{out}/run_manifest", manifest)
    tables.write_csv(scored_entities(labelled), f"{out}/osint_risk_scores")
    return table
