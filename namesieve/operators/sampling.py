"""Labelled validation pairs and the comparison of vector representations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesieve.operators.metrics import ranking_metrics
from namesieve.operators.ranking import one_row
from namesieve.plans.storage import written

SEED = 42
SAMPLE_PER_CLASS = 20
ANYWHERE = "*"
#: Up to so many drawn entities are looked up by a list of their ids; more by a join.
LISTED_IDS = 1000


def _usable(variants: DataFrame) -> DataFrame:
    return variants.where("length(name_variant) > 0")


def _key(seed: int, *columns: str) -> str:
    """Seeded pseudo-random text of some columns."""
    return f"md5(concat_ws('|', '{seed}', {', '.join(f'CAST({c} AS STRING)' for c in columns)}))"


def _bucketed(variants: DataFrame) -> DataFrame:
    return _usable(variants).withColumn("bucket", F.expr("concat_ws('||', coalesce(country_code, 'None'), coalesce(entity_type, 'None'))"))


def usable_entities(variants: DataFrame) -> DataFrame:
    """How many usable variants (``n``) each entity has in each country-and-type ``bucket``, written once: pairs are drawn from it, without texts."""
    return written(_bucketed(variants).groupBy("entity_id", "bucket").agg(F.expr("count(*) AS n")), "usable-entities")


def _drawn_entities(entities: DataFrame, size: int, seed: int) -> DataFrame:
    """``size`` random entities that have at least two usable variants: the n smallest hashes, so nothing is sorted as a whole."""
    several = entities.groupBy("entity_id").agg(F.expr("sum(n) AS n")).where("n >= 2")
    return written(several.orderBy(F.expr(_key(seed, "entity_id")), "entity_id").limit(size).select("entity_id"), "drawn-entities")


def _drawn_places(entities: DataFrame, draws: DataFrame, seed: int) -> DataFrame:
    """Two entities (``_place`` 1 and 2) of a random bucket for each draw, with the ``home`` bucket of each; at most two rows a draw."""
    buckets = entities.groupBy("bucket").agg(F.expr("count(*) AS n")).where("n >= 2").select("bucket")
    found = one_row(buckets.agg(F.expr("count(*) AS n")))
    placed = entities.withColumn("_found", found).selectExpr(
        "entity_id", "bucket AS home", f"if(_found.n > 0, bucket, '{ANYWHERE}') AS bucket"
    )
    # Countries times types times draws: a short list, and each draw keeps the smallest hash.
    options = draws.join(buckets, F.lit(True), "left").selectExpr("draw", f"coalesce(bucket, '{ANYWHERE}') AS bucket")
    picked = options.groupBy("draw").agg(F.expr(f"min_by(bucket, {_key(seed, 'draw', 'bucket')}) AS bucket"))
    order = f"PARTITION BY draw ORDER BY {_key(seed, 'draw', 'entity_id')}, entity_id"
    two = (
        placed.join(F.broadcast(picked), "bucket")  # one row per draw
        .selectExpr("draw", "entity_id", "home", f"row_number() OVER ({order}) AS _place")
        .where("_place <= 2")
    )
    return written(two, "drawn-places")


def _variants_of(variants: DataFrame, drawn: DataFrame) -> DataFrame:
    """Variants of the drawn entities. Few ids are a filter, which reaches the scan, so that the others' texts are not made into variants."""
    asked = drawn.select("entity_id").distinct()
    ids = [r["entity_id"] for r in asked.limit(LISTED_IDS + 1).collect()]
    if len(ids) > LISTED_IDS:
        return variants.alias("l").join(asked.alias("r"), F.expr("l.entity_id <=> r.entity_id"), "left_semi")
    listed = F.col("entity_id").isin([i for i in ids if i is not None])
    return variants.where(listed | F.col("entity_id").isNull() if None in ids else listed)


def _positive(variants: DataFrame, chosen: DataFrame, seed: int) -> DataFrame:
    order = f"PARTITION BY entity_id ORDER BY {_key(seed, 'entity_id', 'name_variant', 'variant_rule')}, name_variant"
    own = _usable(variants).join(F.broadcast(chosen), "entity_id", "left_semi")
    two = own.selectExpr("*", f"row_number() OVER ({order}) AS _place").where("_place <= 2")
    pairs = two.groupBy("entity_id").agg(
        F.expr("max(CASE WHEN _place = 1 THEN name_variant END) AS variant_a"),
        F.expr("max(CASE WHEN _place = 2 THEN name_variant END) AS variant_b"),
    )
    return pairs.selectExpr("variant_a", "variant_b", "entity_id AS entity_id_a", "entity_id AS entity_id_b", "1 AS same_entity")


def _negative(variants: DataFrame, drawn: DataFrame, seed: int) -> DataFrame:
    spelling = f"struct({_key(seed, 'entity_id', 'name_variant', 'variant_rule')}, name_variant)"
    one_spelling = _bucketed(variants).groupBy("entity_id", "bucket").agg(F.expr(f"min_by(name_variant, {spelling}) AS variant"))
    same = F.expr("l.entity_id <=> r.entity_id AND l.home = r.bucket")
    two = drawn.alias("l").join(one_spelling.alias("r"), same).selectExpr("l.*", "r.variant")
    pairs = two.groupBy("draw").agg(
        *[
            F.expr(f"max(CASE WHEN _place = {place} THEN {column} END) AS {name}_{side}")
            for column, name in (("variant", "variant"), ("entity_id", "entity_id"))
            for place, side in ((1, "a"), (2, "b"))
        ]
    )
    return pairs.where("entity_id_b IS NOT NULL").selectExpr(*pairs.columns, "0 AS same_entity")


def positive_pairs(variants: DataFrame, size: int = SAMPLE_PER_CLASS, seed: int = SEED) -> DataFrame:
    """Two spellings of each of ``size`` random entities that have at least two; label 1.

    Entities are drawn by the order of a seeded hash, without their texts; only the drawn ones' variants are looked up.
    """
    chosen = _drawn_entities(usable_entities(variants), size, seed)
    return _positive(_variants_of(variants, chosen), chosen, seed)


def negative_pairs(variants: DataFrame, draws: DataFrame, seed: int = SEED) -> DataFrame:
    """One pair of different entities per row of ``draws`` (column ``draw``); label 0.

    Each draw takes a random country-and-type bucket with at least two entities and two of its entities;
    without such a bucket, any two entities. Only two rows per draw and task reach the shuffle, and only drawn entities' variants are looked up.
    """
    drawn = _drawn_places(usable_entities(variants), draws, seed)
    return _negative(_variants_of(variants, drawn), drawn, seed)


def validation_pairs(variants: DataFrame, size: int = SAMPLE_PER_CLASS, seed: int = SEED) -> DataFrame:
    """As many negative as positive pairs, at most ``size`` each, in random order (column ``position``).

    The variants are made once to count the entities' and once more for the drawn entities, whose variants are written.
    """
    entities = usable_entities(variants)
    draws = variants.sparkSession.range(size).withColumnRenamed("id", "draw")
    chosen, drawn = _drawn_entities(entities, size, seed), _drawn_places(entities, draws, seed)
    few = written(_variants_of(variants, chosen.unionByName(drawn.select("entity_id"))), "drawn-variants")
    positive = _positive(few, chosen, seed)
    wanted = one_row(positive.agg(F.expr("count(*) AS n")))
    negative = _negative(few, drawn, seed)
    negative = negative.withColumn("_wanted", wanted).where("draw < _wanted.n").drop("_wanted")
    both = positive.withColumn("draw", F.expr("-1L")).unionByName(negative)
    # At most 2 * size rows.
    position = f"row_number() OVER (PARTITION BY 1 ORDER BY {_key(seed, 'same_entity', 'draw', 'entity_id_a')}, entity_id_a)"
    return both.selectExpr(*positive.columns, f"{position} AS position")


def backend_comparison(pairs: DataFrame, backends: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """One row per representation: pairs scored, ROC-AUC, PR-AUC, mean and deviation of the similarity.

    A representation that cannot be used becomes a row with its error.
    """
    scored, failed = [], []
    for name, score in backends.items():
        try:
            scored.append(score(pairs).select(F.lit(name).alias("backend"), "same_entity", "cosine_similarity"))
        except Exception as error:  # noqa: BLE001 - the report names whatever went wrong
            failed.append((name, 0, str(error)))
    out = None
    if scored:
        every = scored[0]
        for s in scored[1:]:
            every = every.unionByName(s)
        spread = every.groupBy("backend").agg(
            F.expr("count(*) AS pairs_scored"),
            F.expr("round(avg(cosine_similarity), 6) AS mean_similarity"),
            F.expr("round(stddev_samp(cosine_similarity), 6) AS std_similarity"),
        )
        curve = ranking_metrics(every, "same_entity", "cosine_similarity", by=["backend"])
        out = spread.join(curve, "backend").selectExpr(
            "backend",
            "pairs_scored",
            "round(roc_auc, 6) AS roc_auc",
            "round(pr_auc, 6) AS pr_auc",
            "mean_similarity",
            "std_similarity",
            "CAST(NULL AS STRING) AS error",
        )
    if failed:
        rows = pairs.sparkSession.createDataFrame(failed, "backend string, pairs_scored long, error string")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def backend_ranking(comparison: DataFrame) -> DataFrame:
    """Best representation first: ROC-AUC, then PR-AUC, then pairs; missing values last."""
    order = "roc_auc DESC NULLS LAST, pr_auc DESC NULLS LAST, pairs_scored DESC NULLS LAST, backend"
    # One row per representation.
    ranked = comparison.withColumn("error", F.expr("coalesce(error, '')"))
    ranked = ranked.selectExpr("*", f"row_number() OVER (PARTITION BY 1 ORDER BY {order}) AS place")
    return ranked.selectExpr("*", "place = 1 AS suggested").orderBy("place")
