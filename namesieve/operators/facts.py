"""Per-entity facts from source results and evidence, the decision and the risk label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesieve.operators.ranking import exact_quantiles, one_row

# Texts that mark a review, score of an urgent one, and limits of the label rule.
REVIEW_TEXTS = ("true", "1")
URGENT_IDENTITY = 0.8
LABEL_FINDINGS = 3
LABEL_REVIEWS = 3
LABEL_QUANTILE = 0.75
LABEL = "riesgo_fraude_aml"

_IS_REVIEW = "lower(CAST(review_required AS STRING)) IN ({})".format(", ".join(f"'{t}'" for t in REVIEW_TEXTS))
# NaN is a missing score; Spark would sort it above every number.
_SCORE = "nullif(CAST(identity_score AS DOUBLE), CAST('NaN' AS DOUBLE))"


def source_facts(sources: DataFrame) -> DataFrame:
    """Sources looked at and sources with a finding, in one pass."""
    return (
        sources.where("entity_id IS NOT NULL")
        .groupBy("entity_id")
        .agg(F.expr("count(*) AS sources_evaluated"), F.expr("count_if(evidence_count > 0) AS sources_with_hallazgo"))
    )


def evidence_facts(evidence: DataFrame) -> DataFrame:
    """Best identity score, evidence items, reviews and urgent reviews, in one pass."""
    return (
        evidence.where("entity_id IS NOT NULL")
        .selectExpr("entity_id", f"{_SCORE} AS score", f"coalesce({_IS_REVIEW}, false) AS review")
        .groupBy("entity_id")
        .agg(
            F.expr("max(score) AS max_identity_score"),
            F.expr("count(*) AS evidence_items"),
            F.expr("count_if(review) AS review_items"),
            F.expr(f"count_if(review AND score >= {URGENT_IDENTITY}D) AS review_items_high"),
        )
    )


def review_queue_json(evidence: DataFrame) -> DataFrame:
    """Review queue of each entity as JSON text, urgent items first.

    The items differ only in their priority, so two counts per entity carry the whole list and no
    item is collected. The text grows with the queue: ``review_queue_runs`` is the form to work with, and
    ``review_queue_parts`` writes long queues.
    """
    items = "concat(array_repeat('{{\"priority\": \"high\"}}', {0}), array_repeat('{{\"priority\": \"medium\"}}', {1}))".format(
        "CAST(review_items_high AS INT)", "CAST(review_items - review_items_high AS INT)"
    )
    return evidence_facts(evidence).selectExpr("entity_id", f"concat('[', array_join({items}, ', '), ']') AS review_queue_json")


def review_queue_runs(evidence: DataFrame) -> DataFrame:
    """Review queue of each entity as runs of equal items, urgent ones first: ``entity_id, runs`` of ``priority, n``.

    However many items an entity has, its queue is two runs at most.
    """
    runs = "filter(array(struct('high' AS priority, review_items_high AS n), struct('medium' AS priority, review_items - review_items_high AS n)), r -> r.n > 0)"
    return evidence_facts(evidence).selectExpr("entity_id", f"{runs} AS runs")


def review_queue_parts(runs: DataFrame, items: int = 10_000) -> DataFrame:
    """Runs written out for export as JSON lists of at most ``items`` items: ``entity_id, part`` (from 0), ``review_queue_json``.

    Parts of one entity are rows of their own, so no task holds a whole long queue; an empty queue is one empty list.
    """
    placed = (
        "transform(runs, (r, i) -> struct(r.priority AS priority, aggregate(slice(runs, 1, i), 0L, (acc, x) -> acc + x.n) AS first, r.n AS n))"
    )
    total = "aggregate(runs, 0L, (acc, r) -> acc + r.n)"
    parts = runs.selectExpr("entity_id", f"{placed} AS _p", f"explode(sequence(0L, greatest(ceil({total} / {items}) - 1, 0L))) AS part")
    here = f"greatest(0L, least(r.first + r.n, (part + 1) * {items}) - greatest(r.first, part * {items}))"
    texts = f"flatten(transform(_p, r -> array_repeat(concat('{{\"priority\": \"', r.priority, '\"}}'), CAST({here} AS INT))))"
    return parts.selectExpr("entity_id", "part", f"concat('[', array_join({texts}, ', '), ']') AS review_queue_json")


def joined_facts(catalog: DataFrame, sources: DataFrame, evidence: DataFrame) -> DataFrame:
    """Catalog with both fact tables, missing values as they come. Each side has one row per entity."""
    return catalog.join(source_facts(sources), "entity_id", "left").join(evidence_facts(evidence), "entity_id", "left")


def entity_facts(catalog: DataFrame, sources: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row per catalog entity with counts (0 when missing) and ``overall_decision``."""
    counts = ("sources_evaluated", "sources_with_hallazgo", "evidence_items", "review_items", "review_items_high")
    filled = joined_facts(catalog, sources, evidence).fillna(0, list(counts)).fillna(0.0, ["max_identity_score"])
    decision = "CASE WHEN review_items > 0 THEN 'needs_review' WHEN evidence_items > 0 THEN 'accepted' ELSE 'no_match' END"
    return filled.selectExpr("*", f"{decision} AS overall_decision")


def risk_label(facts: DataFrame) -> DataFrame:
    """Add the target: a review with many findings, a high identity score or many reviews."""
    limit = exact_quantiles(facts, "max_identity_score", {"p75": LABEL_QUANTILE})
    rule = (
        f"overall_decision = 'needs_review' AND (sources_with_hallazgo >= {LABEL_FINDINGS} "
        f"OR max_identity_score >= _limit.p75 OR review_items >= {LABEL_REVIEWS})"
    )
    return facts.withColumn("_limit", one_row(limit)).selectExpr(*facts.columns, f"CAST({rule} AS INT) AS {LABEL}")
