"""Continuous risk score and its levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesieve.functions.literals import PRIORITY_WEIGHTS, highest_priority_weight
from namesieve.operators.ranking import exact_quantiles, one_row

# Weights of the score, guard against division by zero, level limits and names.
WEIGHTS = {"max_identity_norm": 0.50, "hallazgo_ratio": 0.20, "evidence_norm": 0.20, "priority_norm": 0.10}
EPSILON = "1e-9D"
LEVEL_QUANTILES = {"q33": 0.33, "q66": 0.66}
LEVELS = ("bajo", "medio", "alto")
EDGE_DIGITS = 9


def priority_from_json(df: DataFrame, queue_json: str = "review_queue_json") -> DataFrame:
    """Add the largest priority weight of a JSON review queue; 0 for anything unreadable."""
    return df.selectExpr("*", f"{highest_priority_weight(queue_json)} AS priority_score_raw")


def priority_from_counts(facts: DataFrame) -> DataFrame:
    """The same weight straight from the review counts, without the JSON detour."""
    high, medium = PRIORITY_WEIGHTS["high"], PRIORITY_WEIGHTS["medium"]
    weight = f"CASE WHEN review_items_high > 0 THEN {high}D WHEN review_items > 0 THEN {medium}D ELSE 0D END"
    return facts.selectExpr("*", f"{weight} AS priority_score_raw")


def priority_from_runs(df: DataFrame, runs: str = "runs") -> DataFrame:
    """The same weight from a run-length queue."""
    weights = "map({})".format(", ".join(f"'{p}', {w}D" for p, w in PRIORITY_WEIGHTS.items()))
    weight = f"coalesce(array_max(transform({runs}, r -> coalesce({weights}[r.priority], 0D))), 0D)"
    return df.selectExpr("*", f"{weight} AS priority_score_raw")


def risk_score(scored: DataFrame) -> DataFrame:
    """Add three min-max normalised parts, the finding ratio and their weighted sum."""
    parts = {
        "max_identity_norm": "max_identity_score",
        "evidence_norm": "evidence_items",
        "priority_norm": "priority_score_raw",
    }
    ends = [F.expr(f"{f}({c}) AS {f}_{n}") for n, c in parts.items() for f in ("min", "max")]
    norms = [f"({c} - _ends.min_{n}) / (_ends.max_{n} - _ends.min_{n} + {EPSILON}) AS {n}" for n, c in parts.items()]
    out = scored.withColumn("_ends", one_row(scored.agg(*ends)))
    out = out.selectExpr(*scored.columns, *norms, f"sources_with_hallazgo / (sources_evaluated + {EPSILON}) AS hallazgo_ratio")
    total = " + ".join(f"{w}D * {n}" for n, w in WEIGHTS.items())
    return out.selectExpr("*", f"{total} AS osint_risk_score")


def risk_levels(scored: DataFrame) -> DataFrame:
    """Low, middle and high third of the score, upper edges included; with equal edges the middle is empty.

    Scores and edges are compared after rounding, so the order of additions cannot move an entity that
    sits on an edge.
    """
    limits = one_row(exact_quantiles(scored, "osint_risk_score", LEVEL_QUANTILES))
    low, middle, high = LEVELS
    score = f"round(osint_risk_score, {EDGE_DIGITS})"
    level = (
        f"CASE WHEN {score} <= round(_limits.q33, {EDGE_DIGITS}) THEN '{low}' "
        f"WHEN {score} <= round(_limits.q66, {EDGE_DIGITS}) THEN '{middle}' ELSE '{high}' END"
    )
    return scored.withColumn("_limits", limits).selectExpr(
        "entity_id", "entity_name", "osint_risk_score", f"{level} AS risk_level"
    )
