"""Both phases end to end on CSV files made from the smallest test tables."""

import os

import pytest
from pyspark.sql import functions as F

from namesieve.plans import resolution, risk
from namesieve.registry import views
from namesieve.sources import tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """Source results with query literals, and evidence, as CSV folders."""
    folder = str(tmp_path_factory.mktemp("inputs"))
    names = views.entities(spark, FOLDER).selectExpr(
        "entity_id",
        "translate(entity_name, '\\'\\n\\\\', '   ') AS name",
        "if(entity_type = 'MORAL', 'PM', 'PF') AS code",
        "coalesce(concat('\\'', country_code, '\\''), 'None') AS country",
    )
    literal = (
        "concat('[{\\'entity_id\\': \\'', entity_id, '\\', \\'query_value\\': \\'', name, '\\', \\'metadata\\': "
        "{\\'country_code\\': ', country, ', \\'entity_type\\': \\'', code, '\\'}}]') AS query_used"
    )
    sources = names.join(views.sources(spark, FOLDER).select("entity_id", "evidence_count"), "entity_id", "left")
    tables.write_csv(sources.selectExpr("entity_id", "evidence_count", literal), f"{folder}/sources")
    tables.write_csv(views.evidence(spark, FOLDER), f"{folder}/evidence")
    return folder


def test_resolution_phase(spark, inputs, tmp_path):
    result = resolution.run(spark, f"{inputs}/sources", str(tmp_path / "out"))
    table = spark.read.option("header", True).csv(str(tmp_path / "out" / "similarity_results"))
    queue = spark.read.option("header", True).csv(str(tmp_path / "out" / "manual_review_queue"))
    assert table.count() == result.text_scores.agg(F.sum("pairs")).first()[0] > 0
    assert table.count() == table.select("pair_id").distinct().count()
    assert queue.count() == table.where("confidence_level = 'medium'").count()
    ranking = resolution.compare_backends(result.variants)
    assert ranking.first()["backend"] == "tfidf" and ranking.first()["pairs_scored"] == 40


def test_risk_phase(spark, inputs, tmp_path):
    out = str(tmp_path / "out")
    kinds = ("baseline_0_dummy", "baseline_1_logreg", "baseline_2_tree", "baseline_6_knn")
    grids = {"baseline_2_tree": {"max_depth": [3, 5]}}
    comparison = risk.run(spark, f"{inputs}/sources", f"{inputs}/evidence", out, grids, kinds)
    assert comparison.count() == len(kinds) + 2
    read = lambda name: spark.read.option("header", True).csv(f"{out}/{name}")
    scores = read("osint_risk_scores").withColumn("osint_risk_score", F.col("osint_risk_score").cast("double"))
    assert scores.count() == views.entities(spark, FOLDER).count()
    assert scores.where("osint_risk_score IS NULL OR osint_risk_score < 0 OR osint_risk_score > 1").isEmpty()
    manifest = spark.read.json(f"{out}/run_manifest").first()
    assert sum(map(sum, manifest["confusion_matrix"])) == read("test_predictions").count()
    assert manifest["selected_model"] == read("metrics_comparison").orderBy(F.desc(F.col("pr_auc").cast("double")), "model").first()["model"]
