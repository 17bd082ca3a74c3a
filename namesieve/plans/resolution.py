"""First phase from source results to a review queue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from namesieve.operators import decisions, naming, sampling, similarity
from namesieve.operators.catalog import entity_catalog
from namesieve.sources import tables


@dataclass(frozen=True)
class Resolution:
    """Tables of one run. ``text_scores`` counts the pairs of each score; it and the thresholds are written, the others follow lazily."""

    normalized: DataFrame
    variants: DataFrame
    text_scores: DataFrame
    thresholds: DataFrame
    similarity: DataFrame
    review_queue: DataFrame


def resolve(entities: DataFrame) -> Resolution:
    """Normalise, vary, block, score, classify. ``entities`` has one row per entity id."""
    normalized = naming.normalize_names(entities)
    variants = tables.written(naming.name_variants(normalized), "variants")
    table = similarity.similarity_table(variants)
    counts = tables.written(table.counts, "score-counts")
    thresholds = tables.written(decisions.similarity_thresholds(counts), "thresholds")
    classified = similarity.named_pairs(decisions.classify(similarity.entity_pairs(table), thresholds), table)
    queue = decisions.review_queue(classified, thresholds)
    return Resolution(normalized, variants, counts, thresholds, classified, queue)


def compare_backends(variants: DataFrame, dense_vectors: DataFrame | None = None) -> DataFrame:
    """Rank the sparse and, if given as ``variant, vector`` or ``text_key, vector``, the dense representation on labelled pairs."""
    pairs = tables.written(sampling.validation_pairs(variants), "validation-pairs")
    backends = {"tfidf": similarity.score_pairs}
    if dense_vectors is not None:
        backends["dense"] = lambda p: similarity.score_pairs_dense(p, dense_vectors)
    return sampling.backend_ranking(sampling.backend_comparison(pairs, backends))


def run(spark: SparkSession, source_results: str, out: str) -> Resolution:
    """Read source results (CSV, or Parquet by its name), resolve their entities and write the similarity table and the queue."""
    sources = tables.read_input(spark, source_results, tables.SOURCE_RESULTS, position="_place")
    result = resolve(tables.written(entity_catalog(sources, "_place"), "catalog"))
    tables.write_csv(result.similarity, f"{out}/similarity_results")
    tables.write_csv(result.review_queue, f"{out}/manual_review_queue")
    return result
