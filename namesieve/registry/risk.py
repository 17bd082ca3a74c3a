"""Registered queries of entity facts, the risk score, profiles, splits and validation samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namesieve.functions.grams import PROJECTION
from namesieve.operators import facts, profiling, risk, sampling, similarity, splits, tfidf
from namesieve.operators.facts import LABEL
from namesieve.operators.profiling import LEAKING
from namesieve.registry import views
from namesieve.registry.resolution import _TFIDF, VAR, _metric_rows
from namesieve.registry.views import ctes, with_ctes
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


# ---- facts, decision, label ----------------------------------------------------------------

_REVIEW = "lower(CAST(review_required AS VARCHAR)) IN ('true', '1')"
_SCORE = "CASE WHEN isnan(identity_score) THEN NULL ELSE identity_score END"
FACTS = [
    *ctes("cat", "src", "evd"),
    (
        "srcf",
        "SELECT entity_id, count(*) AS sources_evaluated, count(*) FILTER (evidence_count > 0) AS sources_with_hallazgo "
        "FROM src WHERE entity_id IS NOT NULL GROUP BY entity_id",
    ),
    (
        "evdf",
        f"SELECT entity_id, max({_SCORE}) AS max_identity_score, count(*) AS evidence_items, "
        f"count(*) FILTER ({_REVIEW}) AS review_items, count(*) FILTER ({_REVIEW} AND {_SCORE} >= 0.8::DOUBLE) AS review_items_high "
        "FROM evd WHERE entity_id IS NOT NULL GROUP BY entity_id",
    ),
    (
        "facts",
        "SELECT cat.*, coalesce(sources_evaluated, 0) AS sources_evaluated, coalesce(sources_with_hallazgo, 0) AS sources_with_hallazgo, "
        "coalesce(max_identity_score, 0) AS max_identity_score, coalesce(evidence_items, 0) AS evidence_items, "
        "coalesce(review_items, 0) AS review_items, coalesce(review_items_high, 0) AS review_items_high, "
        "CASE WHEN coalesce(review_items, 0) > 0 THEN 'needs_review' WHEN coalesce(evidence_items, 0) > 0 THEN 'accepted' ELSE 'no_match' END "
        "AS overall_decision FROM cat LEFT JOIN srcf USING (entity_id) LEFT JOIN evdf USING (entity_id)",
    ),
    (
        "labelled",
        "SELECT *, CAST(overall_decision = 'needs_review' AND (sources_with_hallazgo >= 3 OR max_identity_score >= "
        f"(SELECT quantile_cont(max_identity_score, 0.75) FROM facts) OR review_items >= 3) AS INT) AS {LABEL} FROM facts",
    ),
]


def entity_facts_of(spark: SparkSession, folder: str) -> DataFrame:
    return facts.entity_facts(views.catalog(spark, folder), views.sources(spark, folder), views.evidence(spark, folder))


def labelled_facts(spark: SparkSession, folder: str) -> DataFrame:
    return facts.risk_label(tables.written(entity_facts_of(spark, folder), "entity-facts"))


@query(with_ctes("SELECT * FROM facts", *FACTS))
def entity_facts(spark, folder):
    return entity_facts_of(spark, folder)


@query(with_ctes("SELECT overall_decision, count(*) AS count FROM facts GROUP BY overall_decision", *FACTS))
def overall_decision(spark, folder):
    return entity_facts_of(spark, folder).groupBy("overall_decision").agg(F.expr("count(*) AS count"))


@query(with_ctes(f"SELECT entity_id, {LABEL} FROM labelled", *FACTS))
def risk_label(spark, folder):
    return labelled_facts(spark, folder).select("entity_id", LABEL)


_QUEUE = (
    "SELECT entity_id, '[' || coalesce(string_agg(CASE WHEN review THEN '{\"priority\": \"' || p || '\"}' END, ', ' ORDER BY p), '') || ']' "
    f"AS review_queue_json FROM (SELECT entity_id, {_REVIEW} AS review, CASE WHEN {_SCORE} >= 0.8::DOUBLE THEN 'high' ELSE 'medium' END AS p "
    "FROM evd WHERE entity_id IS NOT NULL) GROUP BY entity_id"
)


@query(with_ctes(_QUEUE, *ctes("evd")))
def review_queue_json(spark, folder):
    return facts.review_queue_json(views.evidence(spark, folder))


_ITEMS = (
    f"SELECT entity_id, CASE WHEN {_SCORE} >= 0.8::DOUBLE THEN 'high' ELSE 'medium' END AS priority FROM evd WHERE entity_id IS NOT NULL AND {_REVIEW}"
)


@query(with_ctes(f"SELECT entity_id, priority, count(*) AS n FROM ({_ITEMS}) GROUP BY entity_id, priority", *ctes("evd")))
def review_queue_runs(spark, folder):
    """Review queues as runs, a row per run."""
    return facts.review_queue_runs(views.evidence(spark, folder)).selectExpr("entity_id", "inline(runs)")


@query(
    with_ctes(
        "SELECT entity_id, CAST(part AS BIGINT) AS part, '[' || string_agg('{\"priority\": \"' || priority || '\"}', ', ' ORDER BY priority) || ']' "
        "AS review_queue_json FROM (SELECT *, (row_number() OVER (PARTITION BY entity_id ORDER BY priority) - 1) // 3 AS part FROM items) "
        "GROUP BY entity_id, part UNION ALL SELECT DISTINCT entity_id, 0, '[]' FROM evd WHERE entity_id IS NOT NULL AND entity_id NOT IN "
        "(SELECT entity_id FROM items)",
        *ctes("evd"),
        ("items", _ITEMS),
    )
)
def review_queue_parts(spark, folder):
    """Review queues as text in parts of three items."""
    return facts.review_queue_parts(facts.review_queue_runs(views.evidence(spark, folder)), items=3)


# ---- risk score ----------------------------------------------------------------------------

_JSON_FORMS = (
    "CASE entity_id % 8 WHEN 0 THEN '[]' WHEN 1 THEN '{{\"priority\": \"high\"}}' WHEN 2 THEN '[1, {{\"priority\": \"high\"}}]' "
    "WHEN 3 THEN '[{{\"priority\": null}}, {{\"priority\": \"low\"}}]' WHEN 4 THEN '[{{\"x\": 1}}, {{\"priority\": \"LOW\"}}]' "
    "WHEN 5 THEN 'not json' WHEN 6 THEN {0} ELSE '[{{\"priority\": \"unknown\"}}, {{\"priority\": \"medium\"}}]' END"
)


@query(
    with_ctes(
        "SELECT entity_id, CASE entity_id % 8 WHEN 4 THEN 0.4::DOUBLE WHEN 7 THEN 1.0::DOUBLE WHEN 6 THEN "
        "CASE WHEN contains(review_queue_json, 'high') THEN 1.5::DOUBLE WHEN contains(review_queue_json, 'medium') THEN 1.0::DOUBLE "
        "ELSE 0.0::DOUBLE END ELSE 0.0::DOUBLE END AS priority_score_raw FROM queue",
        *ctes("evd"),
        ("queue", _QUEUE),
    )
)
def priority_score(spark, folder):
    """Weights of the JSON queues, with unreadable and odd forms mixed in."""
    queues = facts.review_queue_json(views.evidence(spark, folder))
    mixed = queues.selectExpr("entity_id", f"{_JSON_FORMS.format('review_queue_json')} AS review_queue_json")
    return risk.priority_from_json(mixed).select("entity_id", "priority_score_raw")


def scored_facts(spark: SparkSession, folder: str) -> DataFrame:
    return risk.risk_score(risk.priority_from_counts(tables.written(entity_facts_of(spark, folder), "entity-facts")))


RISK = [
    *FACTS,
    (
        "prio",
        "SELECT *, CASE WHEN review_items_high > 0 THEN 1.5::DOUBLE WHEN review_items > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p FROM facts",
    ),
    (
        "norms",
        "SELECT *, (max_identity_score - min(max_identity_score) OVER ()) / (max(max_identity_score) OVER () - min(max_identity_score) OVER () "
        "+ 1e-9::DOUBLE) AS i, sources_with_hallazgo / (sources_evaluated + 1e-9::DOUBLE) AS h, (evidence_items - min(evidence_items) OVER ()) / "
        "(max(evidence_items) OVER () - min(evidence_items) OVER () + 1e-9::DOUBLE) AS e, "
        "(p - min(p) OVER ()) / (max(p) OVER () - min(p) OVER () + 1e-9::DOUBLE) AS q FROM prio",
    ),
    ("scored", "SELECT *, 0.5::DOUBLE * i + 0.2::DOUBLE * h + 0.2::DOUBLE * e + 0.1::DOUBLE * q AS osint_risk_score FROM norms"),
]


@query(
    with_ctes(
        "SELECT entity_id, round(i, 6) AS max_identity_norm, round(h, 6) AS hallazgo_ratio, round(e, 6) AS evidence_norm, "
        "round(q, 6) AS priority_norm, round(osint_risk_score, 6) AS osint_risk_score FROM scored",
        *RISK,
    )
)
def risk_score(spark, folder):
    names = ("max_identity_norm", "hallazgo_ratio", "evidence_norm", "priority_norm", "osint_risk_score")
    return scored_facts(spark, folder).selectExpr("entity_id", *[f"round({n}, 6) AS {n}" for n in names])


@query(
    with_ctes(
        "SELECT entity_id, entity_name, round(osint_risk_score, 6) AS osint_risk_score, CASE WHEN round(osint_risk_score, 9) <= "
        "(SELECT round(quantile_cont(osint_risk_score, 0.33), 9) FROM scored) THEN 'bajo' WHEN round(osint_risk_score, 9) <= "
        "(SELECT round(quantile_cont(osint_risk_score, 0.66), 9) FROM scored) THEN 'medio' ELSE 'alto' END AS risk_level FROM scored",
        *RISK,
    )
)
def risk_levels(spark, folder):
    levels = risk.risk_levels(scored_facts(spark, folder))
    return levels.withColumn("osint_risk_score", F.expr("round(osint_risk_score, 6)"))


# ---- profiles ------------------------------------------------------------------------------

_FACT_TYPES = {
    "entity_id": "bigint", "entity_name": "string", "entity_type": "string", "country_code": "string", "sources_evaluated": "bigint",
    "sources_with_hallazgo": "bigint", "max_identity_score": "double", "evidence_items": "bigint", "review_items": "bigint",
    "review_items_high": "bigint", "overall_decision": "string", LABEL: "int",
}


def _profile_sql(source: str, types: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
        f"round((count(*) - count({c}))::DOUBLE / count(*) * 100, 4) AS null_pct, count(DISTINCT {c}) AS n_unique, "
        f"round(count(DISTINCT {c})::DOUBLE / count(*) * 100, 4) AS unique_pct, "
        f"count(DISTINCT {c}) + CAST(count(*) > count({c}) AS INT) <= 1 AS is_constant FROM {source}"
        for c, t in types.items()
    )


@query(with_ctes(_profile_sql("labelled", _FACT_TYPES), *FACTS))
def profile_columns(spark, folder):
    return profiling.profile_columns(labelled_facts(spark, folder))


_NUMBERS = ["sources_evaluated", "sources_with_hallazgo", "max_identity_score", "evidence_items", "review_items"]


@query(
    with_ctes(
        f"SELECT feature, CASE WHEN feature = '{LABEL}' THEN 'target' WHEN is_constant OR leaking THEN 'excluded' ELSE 'candidate' END AS role, "
        f"CASE WHEN feature = '{LABEL}' THEN 'objetivo' WHEN is_constant THEN 'constante' WHEN leaking THEN "
        "'leakage/identificador/texto-json crudo' ELSE 'candidata para modelado' END AS reason "
        'FROM (SELECT "column" AS feature, is_constant, "column" IN (' + ", ".join(f"'{c}'" for c in LEAKING) + ") AS leaking FROM prof)",
        *FACTS,
        ("prof", _profile_sql("labelled", _FACT_TYPES)),
    )
)
def feature_catalog(spark, folder):
    return profiling.feature_catalog(labelled_facts(spark, folder))


@query(
    with_ctes(
        "SELECT \"column\" AS feature FROM prof WHERE NOT is_constant AND \"column\" NOT IN ("
        + ", ".join(f"'{c}'" for c in (*LEAKING, LABEL))
        + ")",
        *FACTS,
        ("prof", _profile_sql("labelled", _FACT_TYPES)),
    )
)
def candidate_features(spark, folder):
    names = profiling.candidate_features(labelled_facts(spark, folder))
    return spark.createDataFrame([(n,) for n in names], "feature string")


@query(
    with_ctes(
        _metric_rows(
            "(SELECT (SELECT count(*) FROM src) - (SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS r, "
            "(SELECT count(*) FROM src) - (SELECT count(*) FROM (SELECT DISTINCT entity_id FROM src)) AS k)",
            duplicate_rows="r",
            duplicate_keys="k",
        ),
        *ctes("src"),
    )
)
def duplicate_rows(spark, folder):
    return profiling.duplicate_report(views.sources(spark, folder), "entity_id")


@query(
    with_ctes(
        "SELECT country_code, count(*) AS count, round(count(*)::DOUBLE / (SELECT count(*) FROM ent WHERE country_code IS NOT NULL), 4) AS share "
        "FROM ent WHERE country_code IS NOT NULL GROUP BY country_code ORDER BY count DESC, country_code LIMIT 12",
        *ctes("ent"),
    )
)
def value_counts(spark, folder):
    return profiling.value_counts(views.entities(spark, folder), "country_code", top=12)


_LENGTHS = (
    "lengths",
    r"SELECT length(coalesce(entity_name, '')) AS name_len, len(list_filter(string_split_regex(coalesce(entity_name, ''), '\s+'), "
    "lambda t: t <> '')) AS name_tokens FROM ent",
)


def name_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return views.entities(spark, folder).selectExpr(
        "length(coalesce(entity_name, '')) AS name_len",
        r"size(filter(split(coalesce(entity_name, ''), r'\s+'), t -> t <> '')) AS name_tokens",
    )


def _describe_sql(source: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"CAST(min({c}) AS DOUBLE) AS min, {', '.join(f'round(quantile_cont({c}, 0.{p})::DOUBLE, 6) AS q{p}' for p in (25, 50, 75))}, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM {source}"
        for c in columns
    )


@query(with_ctes(_describe_sql("lengths", ["name_len", "name_tokens"]), *ctes("ent"), _LENGTHS))
def describe_names(spark, folder):
    return profiling.describe(name_lengths(spark, folder), ["name_len", "name_tokens"])


def _fenced(column: str) -> str:
    q1, q3 = (f"(SELECT quantile_cont({column}, 0.{p})::DOUBLE FROM facts)" for p in (25, 75))
    return f"{q1} - 1.5::DOUBLE * ({q3} - {q1}) AS low, {q3} + 1.5::DOUBLE * ({q3} - {q1}) AS high"


@query(
    with_ctes(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} < low OR {c} > high) AS outlier_count, "
            f"round(count(*) FILTER ({c} < low OR {c} > high)::DOUBLE / count(*) * 100, 4) AS outlier_pct, round(max(low), 6) AS low_bound, "
            f"round(max(high), 6) AS high_bound FROM facts, (SELECT {_fenced(c)})"
            for c in _NUMBERS
        ),
        *FACTS,
    )
)
def iqr_outliers(spark, folder):
    return profiling.iqr_outliers(entity_facts_of(spark, folder), _NUMBERS)


@query(
    with_ctes(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", round(min({c}) FILTER ({c} >= low AND {c} <= high)::DOUBLE, 6) AS whisker_low, "
            + ", ".join(f"round(quantile_cont({c}, 0.{p})::DOUBLE, 6) AS q{i}" for i, p in enumerate((25, 50, 75), 1))
            + f", round(max({c}) FILTER ({c} >= low AND {c} <= high)::DOUBLE, 6) AS whisker_high FROM facts, (SELECT {_fenced(c)})"
            for c in _NUMBERS
        ),
        *FACTS,
    )
)
def box_stats(spark, folder):
    return profiling.box_stats(entity_facts_of(spark, folder), _NUMBERS)


@query(
    with_ctes(
        "SELECT bin, round(low + width * bin, 6) AS bin_start, count(*) AS count FROM (SELECT low, width, "
        "CAST(least(floor((name_len - low) / width), 19) AS INT) AS bin FROM lengths, "
        "(SELECT min(name_len)::DOUBLE AS low, (max(name_len) - min(name_len)) / 20::DOUBLE AS width FROM lengths)) GROUP BY ALL",
        *ctes("ent"),
        _LENGTHS,
    )
)
def histogram(spark, folder):
    return profiling.histogram(name_lengths(spark, folder), "name_len", bins=20)


# ---- splits --------------------------------------------------------------------------------

SPLIT = [
    *FACTS,
    (
        "ranked",
        f"SELECT *, row_number() OVER (PARTITION BY {LABEL} ORDER BY md5('42|' || entity_id), entity_id) AS r, "
        f"count(*) OVER (PARTITION BY {LABEL}) AS n FROM labelled",
    ),
    ("held", "SELECT *, CAST(ceil(n * 2 / 5) AS BIGINT) AS h FROM ranked"),
    (
        "splits",
        "SELECT *, CASE WHEN r <= n - h THEN 'train' WHEN r <= n - CAST(ceil(h / 2) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM held",
    ),
]


def split_facts(spark: SparkSession, folder: str) -> DataFrame:
    return splits.stratified_split(labelled_facts(spark, folder))


@query(with_ctes(f"SELECT entity_id, {LABEL}, split FROM splits", *SPLIT))
def stratified_split(spark, folder):
    return split_facts(spark, folder).select("entity_id", LABEL, "split")


@query(
    with_ctes(
        f"SELECT split, {LABEL}, count(*) AS count, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY split), 4) AS share "
        f"FROM splits GROUP BY split, {LABEL}",
        *SPLIT,
    )
)
def class_balance(spark, folder):
    return profiling.class_balance(split_facts(spark, folder))


@query(
    with_ctes(
        f"SELECT {LABEL}, count(*) AS count, round((SELECT count(*) FROM labelled)::DOUBLE / (2 * count(*)), 6) AS weight "
        f"FROM labelled GROUP BY {LABEL}",
        *FACTS,
    )
)
def class_weights(spark, folder):
    return splits.class_weights(labelled_facts(spark, folder)).withColumn("weight", F.expr("round(weight, 6)"))


# ---- validation samples --------------------------------------------------------------------

_KEY = "md5(concat_ws('|', '42', {0}))"
POSITIVE = [
    ("several", "SELECT entity_id FROM var GROUP BY entity_id HAVING count(*) >= 2"),
    ("chosen", f"SELECT entity_id FROM several ORDER BY {_KEY.format('entity_id')}, entity_id LIMIT 20"),
    (
        "two",
        f"SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY {_KEY.format('entity_id, name_variant, variant_rule')}, name_variant) AS k "
        "FROM var WHERE entity_id IN (SELECT entity_id FROM chosen)",
    ),
    (
        "positive",
        "SELECT a.name_variant AS variant_a, b.name_variant AS variant_b, a.entity_id AS entity_id_a, a.entity_id AS entity_id_b, 1 AS same_entity "
        "FROM two a JOIN two b USING (entity_id) WHERE a.k = 1 AND b.k = 2",
    ),
]
NEGATIVE = [
    (
        "pick",
        "SELECT entity_id, concat_ws('||', coalesce(country_code, 'None'), coalesce(entity_type, 'None')) AS bucket, name_variant AS variant FROM var "
        f"QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY {_KEY.format('entity_id, name_variant, variant_rule')}, name_variant) = 1",
    ),
    ("buckets", "SELECT bucket FROM pick GROUP BY bucket HAVING count(*) >= 2"),
    (
        "drawn",
        f"SELECT draw, bucket FROM range(20) AS d(draw), buckets QUALIFY row_number() OVER (PARTITION BY draw ORDER BY {_KEY.format('draw, bucket')}) = 1",
    ),
    (
        "couple",
        f"SELECT draw, entity_id, variant, row_number() OVER (PARTITION BY draw ORDER BY {_KEY.format('draw, entity_id')}, entity_id) AS k "
        "FROM drawn JOIN pick USING (bucket)",
    ),
    (
        "negative",
        "SELECT a.draw, a.variant AS variant_a, b.variant AS variant_b, a.entity_id AS entity_id_a, b.entity_id AS entity_id_b, 0 AS same_entity "
        "FROM couple a JOIN couple b USING (draw) WHERE a.k = 1 AND b.k = 2 AND a.draw < (SELECT count(*) FROM positive)",
    ),
]
VALIDATION = [
    *VAR,
    *POSITIVE,
    *NEGATIVE,
    (
        "valid",
        "SELECT * EXCLUDE (draw), CAST(row_number() OVER (ORDER BY md5(concat_ws('|', '42', same_entity, draw, entity_id_a)), entity_id_a) AS INT) "
        "AS position FROM (SELECT *, -1 AS draw FROM positive UNION ALL BY NAME SELECT * FROM negative)",
    ),
]


@query(with_ctes("SELECT * FROM positive", *VAR, *POSITIVE))
def sample_positive_pairs(spark, folder):
    return sampling.positive_pairs(views.variants(spark, folder))


@query(with_ctes("SELECT * FROM negative", *VAR, *POSITIVE, *NEGATIVE))
def sample_negative_pairs(spark, folder):
    draws = spark.range(20).withColumnRenamed("id", "draw")
    return sampling.negative_pairs(views.variants(spark, folder), draws)


@query(with_ctes("SELECT * FROM valid", *VALIDATION))
def validation_pairs(spark, folder):
    return sampling.validation_pairs(views.variants(spark, folder))


_LABELLED_COSINE = [
    *VALIDATION,
    ("texts", "SELECT variant_a AS variant FROM valid UNION SELECT variant_b FROM valid"),
    *_TFIDF,
    (
        "sparse",
        "SELECT valid.*, round(s, 6) AS cosine_similarity FROM valid JOIN (SELECT position, sum(x.weight * y.weight) AS s FROM valid "
        "JOIN vec x ON x.variant = variant_a JOIN vec y ON y.variant = variant_b AND x.gram = y.gram GROUP BY position) USING (position)",
    ),
]


@query(with_ctes("SELECT position, variant_a, variant_b, same_entity, cosine_similarity FROM sparse", *_LABELLED_COSINE))
def score_labelled_pairs(spark, folder):
    pairs = tables.written(sampling.validation_pairs(views.variants(spark, folder)), "validation-pairs")
    return similarity.score_pairs(pairs).select("position", "variant_a", "variant_b", "same_entity", "cosine_similarity")


def _comparison(spark: SparkSession, folder: str) -> DataFrame:
    pairs = tables.written(sampling.validation_pairs(views.variants(spark, folder)), "validation-pairs")
    texts = tfidf.vocabulary(pairs.selectExpr("explode(array(variant_a, variant_b)) AS name_variant"))

    def missing(_: DataFrame) -> DataFrame:
        raise RuntimeError("no vectors stored")

    return sampling.backend_comparison(
        pairs,
        {
            "tfidf": similarity.score_pairs,
            "dense": lambda p: similarity.score_pairs_dense(p, tables.written(tfidf.projected_vectors(texts), "projected-vectors")),
            "remote": missing,
        },
    )


_CODE = " + ".join(
    f"(CASE WHEN length(gram) > {i} THEN unicode(substr(gram, {i + 1}, 1))::BIGINT ELSE 0 END) * {1 << 21 * (2 - i)}" for i in range(3)
)
_COMPARED = [
    *_LABELLED_COSINE,
    ("spread", f"SELECT variant, weight, ({_CODE}) % {PROJECTION[0]} * {PROJECTION[1]} % {PROJECTION[0]} AS h FROM vec"),
    (
        "projected",
        f"SELECT variant, h % {tfidf.PROJECTED} AS i, sum(CASE WHEN h // {tfidf.PROJECTED} % 2 = 0 THEN weight ELSE -weight END) AS x "
        "FROM spread GROUP BY ALL",
    ),
    ("dense", "SELECT variant, i, x / sqrt(sum(x * x) OVER (PARTITION BY variant)) AS x FROM projected"),
    (
        "every",
        "SELECT 'tfidf' AS backend, same_entity AS y, cosine_similarity AS s FROM sparse UNION ALL SELECT 'dense', same_entity, "
        "round(coalesce(s, 0), 6) FROM valid LEFT JOIN (SELECT position, sum(a.x * b.x) AS s FROM valid JOIN dense a ON a.variant = variant_a "
        "JOIN dense b ON b.variant = variant_b AND a.i = b.i GROUP BY position) USING (position)",
    ),
    (
        "auc",
        "SELECT p.backend, avg(CASE WHEN p.s > n.s THEN 1.0::DOUBLE WHEN p.s = n.s THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) AS roc_auc "
        "FROM every p JOIN every n ON p.backend = n.backend AND p.y = 1 AND n.y = 0 GROUP BY p.backend",
    ),
    (
        "ap",
        "SELECT backend, sum(y * prec) / sum(y) AS pr_auc FROM (SELECT backend, y, sum(y) OVER w / count(*) OVER w AS prec "
        "FROM every WINDOW w AS (PARTITION BY backend ORDER BY s DESC RANGE UNBOUNDED PRECEDING)) GROUP BY backend",
    ),
    (
        "compared",
        "SELECT backend, count(*) AS pairs_scored, round(max(roc_auc), 6) AS roc_auc, round(max(pr_auc), 6) AS pr_auc, "
        "round(avg(s), 6) AS mean_similarity, round(stddev_samp(s), 6) AS std_similarity, CAST(NULL AS VARCHAR) AS error "
        "FROM every JOIN auc USING (backend) JOIN ap USING (backend) GROUP BY backend "
        "UNION ALL SELECT 'remote', 0, NULL, NULL, NULL, NULL, 'no vectors stored'",
    ),
]


@query(with_ctes("SELECT * FROM compared", *_COMPARED))
def backend_comparison(spark, folder):
    return _comparison(spark, folder)


@query(
    with_ctes(
        "SELECT * REPLACE (coalesce(error, '') AS error), CAST(row_number() OVER (ORDER BY roc_auc DESC NULLS LAST, pr_auc DESC NULLS LAST, "
        "pairs_scored DESC, backend) AS INT) AS place, place = 1 AS suggested FROM compared",
        *_COMPARED,
    )
)
def backend_ranking(spark, folder):
    return sampling.backend_ranking(_comparison(spark, folder))


# ---- sources -------------------------------------------------------------------------------


@query(with_ctes("SELECT entity_id, entity_name, entity_type, country_code FROM cat", *ctes("cat")))
def scan_csv_roundtrip(spark, folder):
    return tables.csv_roundtrip(views.catalog(spark, folder), "catalog")
