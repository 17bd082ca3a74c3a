"""Normalised names, variants and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesieve.functions.names import COMPANY, with_normalized_name
from namesieve.functions.variants import first_spelling_wins, variant_candidates


def normalize_names(entities: DataFrame) -> DataFrame:
    """Normalise every entity name; adds name_raw, name_norm, name_base, tokens, counts and initials."""
    return with_normalized_name(entities)


def name_variants(normalized: DataFrame) -> DataFrame:
    """One row per distinct spelling of an entity; an empty name has none. No shuffle."""
    entries = first_spelling_wins(variant_candidates("name_tokens", "entity_type"))
    kept = ["entity_id", "entity_type", "country_code", "name_raw", "name_base"]
    return normalized.selectExpr(*kept, f"inline({entries}) AS (name_variant, variant_rule)")


def metric_rows(one: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Turn the columns of a one-row report into ``metric, value`` rows."""
    names = [c for c in one.columns if c not in by]
    typed = one.select(*by, *[F.col(c).cast("double").alias(c) for c in names])
    return typed.unpivot(list(by), names, "metric", "value")


def normalization_report(normalized: DataFrame) -> DataFrame:
    """Row and distinct counts, average lengths and the share of companies that lost a legal form."""
    distinct = [
        normalized.groupBy(F.col(c)).agg(F.lit(1).alias("one")).agg(F.count("*").alias(name))
        for c, name in (
            ("name_raw", "distinct_raw_names"),
            ("name_norm", "distinct_norm_names"),
            ("name_base", "distinct_base_names"),
        )
    ]
    # Rounded as binary numbers: the decimal rounding of Spark would lift 4.145, which is below the tie.
    averages = normalized.agg(
        F.expr("count(*) AS rows"),
        F.expr("rint(avg(name_token_count) * 100) / 100 AS avg_token_count"),
        F.expr("rint(avg(name_char_count) * 100) / 100 AS avg_char_count"),
        F.expr(
            f"rint(avg(CAST(coalesce(entity_type = '{COMPANY}' AND removed_legal_suffix_pattern_count > 0, false) AS DOUBLE)) * 100 * 100) / 100 "
            "AS pct_moral_with_legal_suffix_removed"
        ),
    )
    out = metric_rows(averages)
    for d in distinct:
        out = out.unionByName(metric_rows(d))
    return out


def variant_report(normalized: DataFrame, variants: DataFrame) -> DataFrame:
    """Entities, variants, variants per entity and distinct variants."""
    entities = normalized.agg(F.countDistinct("entity_id").alias("entities"))
    spelled = variants.agg(F.count("*").alias("variants"), F.countDistinct("name_variant").alias("unique_variants"))
    both = entities.join(spelled, F.lit(True)).select(
        F.col("entities").alias("entities_total"),
        F.col("variants").alias("variants_total"),
        F.round(F.col("variants") / F.greatest("entities", F.lit(1)), 4).alias("avg_variants_per_entity"),
        "unique_variants",
    )
    return metric_rows(both)


def rule_distribution(variants: DataFrame) -> DataFrame:
    return variants.groupBy("variant_rule").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "variant_rule")


def first_entities(variants: DataFrame, entities: int = 5) -> DataFrame:
    """Variants of the ``entities`` smallest entity ids, for reading."""
    chosen = variants.select("entity_id").distinct().orderBy("entity_id").limit(entities)
    return variants.join(chosen, "entity_id", "left_semi").orderBy("entity_id", "variant_rule")
