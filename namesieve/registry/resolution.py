"""Registered queries of the first phase: names, variants, blocking, similarity, decisions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namesieve.functions.names import LEGAL_FORMS, normalize_whitespace, strip_accents
from namesieve.functions.variants import CORPORATE_NOISE, RULES
from namesieve.functions.vectors import unit_length
from namesieve.operators import blocking, decisions, naming, similarity, tfidf
from namesieve.operators.catalog import entity_catalog
from namesieve.plans.storage import shared_folder, written
from namesieve.registry import views
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


# ---- SQL building blocks -------------------------------------------------------------------

_NORM_STEPS = r"""
SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(name_raw)),
  '[^a-z0-9\s.]', ' ', 'g'), '\.(\s|$)', ' \1', 'g'), '\s+', ' ', 'g')) AS name_norm
FROM (SELECT entity_id, entity_type, country_code, coalesce(entity_name, '') AS name_raw FROM ent)"""


def _norm_ctes() -> list[tuple[str, str]]:
    steps = [("norm_start", _NORM_STEPS), ("form_0", "SELECT *, name_norm AS b0 FROM norm_start")]
    for i, pattern in enumerate(LEGAL_FORMS):
        steps.append(
            (
                f"form_{i + 1}",
                f"SELECT *, CASE WHEN entity_type = 'MORAL' THEN regexp_replace(b{i}, '{pattern}', ' ', 'gi') ELSE b{i} END "
                f"AS b{i + 1}, CAST(entity_type = 'MORAL' AND regexp_matches(b{i}, '{pattern}', 'i') AS INT) AS h{i} FROM form_{i}",
            )
        )
    last = len(LEGAL_FORMS)
    hits = " + ".join(f"h{i}" for i in range(last))
    steps.append(
        (
            "based",
            f"SELECT *, trim(regexp_replace(b{last}, '\\s+', ' ', 'g')) AS name_base, CAST({hits} AS INT) AS removed FROM form_{last}",
        )
    )
    steps.append(
        (
            "norm",
            "SELECT entity_id, entity_type, country_code, name_raw, name_norm, name_base, "
            "list_filter(string_split(name_base, ' '), lambda t: t <> '') AS toks, "
            "length(replace(name_base, ' ', '')) AS name_char_count, removed AS removed_legal_suffix_pattern_count FROM based",
        )
    )
    return [*ctes("ent"), *steps]


_NOISE = ", ".join(f"'{w}'" for w in CORPORATE_NOISE)
_VARIANT_TEXTS = (
    "array_to_string(toks, ' ')",
    "CASE WHEN len(toks) >= 2 THEN array_to_string(list_reverse(toks), ' ') END",
    "array_to_string(list_transform(toks, lambda t: t[1]), ' ')",
    "CASE WHEN len(toks) >= 2 THEN toks[1] || ' ' || toks[-1] END",
    "CASE WHEN len(toks) >= 2 THEN toks[1][1] || ' ' || toks[-1] END",
    "CASE WHEN len(toks) > 3 THEN array_to_string(toks[1:3], ' ') END",
    f"CASE WHEN entity_type = 'MORAL' THEN array_to_string(list_filter(toks, lambda t: t NOT IN ({_NOISE})), ' ') END",
)
_ALL_VARIANTS = "\nUNION ALL\n".join(
    f"SELECT entity_id, entity_type, country_code, name_raw, name_base, {text} AS name_variant, '{rule}' AS variant_rule, {i} AS o "
    "FROM norm WHERE len(toks) > 0"
    for i, (text, rule) in enumerate(zip(_VARIANT_TEXTS, RULES))
)
VAR = [
    *_norm_ctes(),
    ("made", _ALL_VARIANTS),
    (
        "var",
        "SELECT * EXCLUDE (o) FROM made WHERE name_variant <> '' "
        "QUALIFY row_number() OVER (PARTITION BY entity_id, name_variant ORDER BY o) = 1",
    ),
]
FEAT = [
    *VAR,
    (
        "feat",
        r"""SELECT *, CAST(len(string_split_regex(trim(name_variant), '\s+')) AS INT) AS tokens,
  substr(trim(name_variant), 1, 1) AS c1, substr(replace(name_variant, ' ', ''), 2, 1) AS c2,
  length(replace(name_variant, ' ', '')) AS chars FROM var WHERE name_variant <> ''""",
    ),
]


def _pairs(columns: str, words: int = 2, chars: int = 15, extra: str = "", country: bool = True) -> str:
    same_country = "AND a.country_code IS NOT DISTINCT FROM b.country_code" if country else ""
    return (
        f"SELECT {columns} FROM feat a JOIN feat b ON a.entity_type IS NOT DISTINCT FROM b.entity_type {same_country} "
        f"AND a.c1 = b.c1 {extra} AND a.entity_id < b.entity_id "
        f"AND abs(a.tokens - b.tokens) <= {words} AND abs(a.chars - b.chars) <= {chars}"
    )


_PAIR_ID = "concat_ws('||', a.entity_id, b.entity_id, a.name_variant, b.name_variant) AS pair_id"
_PAIR_COLUMNS = (
    f"{_PAIR_ID}, a.entity_id AS entity_id_a, b.entity_id AS entity_id_b, a.name_variant AS variant_a, b.name_variant AS variant_b, "
    "a.variant_rule AS rule_a, b.variant_rule AS rule_b"
)
_FAST = "AND a.c2 = b.c2"

GRAMS = r"""
SELECT variant, substr(w, CAST(i AS INT), CAST(n AS INT)) AS gram
FROM (SELECT variant, ' ' || unnest(string_split(variant, ' ')) || ' ' AS w FROM texts),
  range(1, 4) AS lens(n), LATERAL (SELECT unnest(range(1, length(w) - n + 2)) AS i)"""
_TFIDF = [
    ("grams", GRAMS),
    ("tf", "SELECT variant, gram, count(*) AS tf FROM grams GROUP BY ALL"),
    ("df", "SELECT gram, count(*) AS df FROM tf GROUP BY gram"),
    (
        "raw",
        "SELECT variant, gram, tf * (ln((1 + (SELECT count(*) FROM texts))::DOUBLE / (1 + df)) + 1) AS w FROM tf JOIN df USING (gram)",
    ),
    ("vec", "SELECT variant, gram, w / sqrt(sum(w * w) OVER (PARTITION BY variant)) AS weight FROM raw"),
]
TFIDF = [*FEAT, ("texts", "SELECT DISTINCT name_variant AS variant FROM var"), *_TFIDF]
SIM = [
    *TFIDF,
    ("fast", _pairs(_PAIR_COLUMNS + ", a.country_code AS country_code", 1, 8, _FAST)),
    ("tp", "SELECT DISTINCT least(variant_a, variant_b) AS t1, greatest(variant_a, variant_b) AS t2 FROM fast"),
    (
        "dots",
        "SELECT t1, t2, round(sum(x.weight * y.weight), 6) AS cosine_similarity FROM tp JOIN vec x ON x.variant = t1 "
        "JOIN vec y ON y.variant = t2 AND y.gram = x.gram GROUP BY t1, t2",
    ),
    (
        "sim",
        "SELECT fast.*, cosine_similarity FROM fast JOIN dots ON t1 = least(variant_a, variant_b) AND t2 = greatest(variant_a, variant_b)",
    ),
    (
        "lim",
        "SELECT round(greatest(quantile_cont(cosine_similarity, 0.90), 0.80::DOUBLE), 6) AS high_min, "
        "round(greatest(quantile_cont(cosine_similarity, 0.75), 0.60::DOUBLE), 6) AS medium_min, "
        "round(quantile_cont(cosine_similarity, 0.75), 6) AS q75_raw, round(quantile_cont(cosine_similarity, 0.90), 6) AS q90_raw, "
        "round(quantile_cont(cosine_similarity, 0.95), 6) AS q95_raw FROM sim",
    ),
    (
        "cls",
        "SELECT sim.*, CASE WHEN cosine_similarity >= high_min THEN 'high' WHEN cosine_similarity >= medium_min THEN 'medium' "
        "ELSE 'low' END AS confidence_level FROM sim, lim",
    ),
]


def _metric_rows(source: str, **metrics: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{m}' AS metric, CAST({e} AS DOUBLE) AS value FROM {source}" for m, e in metrics.items())


# ---- catalog and names ---------------------------------------------------------------------


# Names that a careless reader of literals would change: keywords, commas, both quotes, brackets.
_ODD_NAME = (
    "CASE entity_id % 4 WHEN 0 THEN '' WHEN 1 THEN ', None, True Inc' WHEN 2 THEN ' \"Quoted\" (x,)' ELSE ' O''Neil [1, 2]' END"
)


def literal_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The catalog as query texts: Python-style literals, each entity twice, plus unreadable rows; in this order in its files."""
    country = F.when(F.col("entity_id") % 11 == 0, F.lit("None")).otherwise(F.concat(F.lit("'"), "country_code", F.lit("'")))
    code = F.when(F.col("entity_type") == "MORAL", "PM").otherwise("PF")
    odd = F.expr(_ODD_NAME.replace("''Neil", "\\'Neil"))
    quote = F.when(F.col("entity_id") % 4 == 3, '"').otherwise("'")
    literal = F.concat(
        F.lit("[{'entity_id': "), "entity_id", F.lit(", 'query_value': "), quote, "entity_name", odd, quote,
        F.lit(", 'seen': (1, None, 'a, (b',), 'metadata': {'country_code':"), country, F.lit(", 'entity_type': '"), code, F.lit("', 'active': True}},]"),
    )
    cat = views.catalog(spark, folder).withColumn("query_used", literal)
    later = cat.select(F.replace("query_used", F.lit("Customer"), F.lit("Later")).alias("query_used"))
    broken = cat.select(F.when(F.col("entity_id") % 2 == 0, "[]").otherwise("{'entity_id': 1, 'query_value': 'x'}").alias("query_used"))
    path = f"{shared_folder(spark)}/namesieve/literal-sources-{uuid.uuid4().hex}.parquet"
    broken.unionByName(cat.select("query_used")).unionByName(later).write.parquet(path)
    return tables.read_parquet(spark, path, "query_used STRING", position="position")


@query(
    with_ctes(
        f"SELECT CAST(entity_id AS VARCHAR) AS entity_id, entity_name || {_ODD_NAME} AS entity_name, entity_type, "
        "CASE WHEN entity_id % 11 = 0 THEN NULL ELSE country_code END AS country_code FROM cat WHERE entity_name <> ''",
        *ctes("cat"),
    )
)
def entity_catalog_query(spark, folder):
    return entity_catalog(literal_sources(spark, folder), order="position")


@query("SELECT doc_id, strip_accents(text) AS text FROM documents")
def strip_accents_query(spark, folder):
    return views.table(spark, folder, "documents").selectExpr("doc_id", f"{strip_accents('text')} AS text")


@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents")
def normalize_whitespace_query(spark, folder):
    return views.table(spark, folder, "documents").selectExpr("doc_id", f"{normalize_whitespace('text')} AS text")


@query(
    with_ctes(
        "SELECT entity_id, entity_type, country_code, name_raw, name_norm, name_base, array_to_string(toks, '|') AS name_tokens, "
        "CAST(len(toks) AS INT) AS name_token_count, CAST(name_char_count AS INT) AS name_char_count, "
        "array_to_string(list_transform(toks, lambda t: t[1]), '') AS name_initials, removed_legal_suffix_pattern_count FROM norm",
        *_norm_ctes(),
    )
)
def normalize_names(spark, folder):
    out = views.normalized(spark, folder).drop("entity_name")
    return out.withColumn("name_tokens", F.array_join("name_tokens", "|"))


@query(
    with_ctes(
        _metric_rows(
            "norm",
            rows="count(*)",
            distinct_raw_names="count(DISTINCT name_raw)",
            distinct_norm_names="count(DISTINCT name_norm)",
            distinct_base_names="count(DISTINCT name_base)",
            avg_token_count="round(avg(len(toks)), 2)",
            avg_char_count="round(avg(name_char_count), 2)",
            pct_moral_with_legal_suffix_removed="round(avg(CASE WHEN entity_type = 'MORAL' AND "
            "removed_legal_suffix_pattern_count > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 2)",
        ),
        *_norm_ctes(),
    )
)
def normalization_report(spark, folder):
    return naming.normalization_report(views.normalized(spark, folder))


# ---- variants ------------------------------------------------------------------------------


@query(with_ctes("SELECT * FROM var", *VAR))
def name_variants(spark, folder):
    return views.variants(spark, folder)


@query(
    with_ctes(
        _metric_rows(
            "(SELECT (SELECT count(DISTINCT entity_id) FROM norm) AS e, count(*) AS v, count(DISTINCT name_variant) AS u FROM var)",
            entities_total="e",
            variants_total="v",
            avg_variants_per_entity="round(v::DOUBLE / greatest(e, 1), 4)",
            unique_variants="u",
        ),
        *VAR,
    )
)
def variant_report(spark, folder):
    norm = views.normalized(spark, folder)
    return naming.variant_report(norm, naming.name_variants(norm))


@query(with_ctes("SELECT variant_rule, count(*) AS count FROM var GROUP BY variant_rule", *VAR))
def rule_distribution(spark, folder):
    return naming.rule_distribution(views.variants(spark, folder))


@query(
    with_ctes(
        "SELECT * FROM var WHERE entity_id IN (SELECT DISTINCT entity_id FROM var ORDER BY entity_id LIMIT 5)", *VAR
    )
)
def variants_sample(spark, folder):
    return naming.first_entities(views.variants(spark, folder))


# ---- blocking ------------------------------------------------------------------------------


@query(
    with_ctes(
        "SELECT entity_id, name_variant, tokens AS variant_tokens, c1 AS variant_first_char, c2 AS variant_second_char, "
        "CAST(chars AS INT) AS variant_len_chars FROM feat",
        *FEAT,
    )
)
def blocking_features(spark, folder):
    return blocking.blocking_features(views.variants(spark, folder)).select(
        "entity_id", "name_variant", "variant_tokens", "variant_first_char", "variant_second_char", "variant_len_chars"
    )


_PAIR_OUT = ["pair_id", "entity_id_a", "entity_id_b", "variant_a", "variant_b", "rule_a", "rule_b"]


@query(with_ctes(_pairs(_PAIR_COLUMNS + ", a.country_code AS country_code"), *FEAT))
def blocking_candidates(spark, folder):
    pairs = blocking.candidate_pairs(views.variants(spark, folder), unique=True)
    return pairs.select(*_PAIR_OUT, "country_code")


@query(with_ctes(_pairs(_PAIR_COLUMNS + ", a.country_code AS country_code", 1, 8, _FAST), *FEAT))
def fast_candidates(spark, folder):
    pairs = blocking.fast_pairs(views.variants(spark, folder), unique=True)
    return pairs.select(*_PAIR_OUT, "country_code")


@query(
    with_ctes(
        f"SELECT rule_a, rule_b, count(*) AS count FROM ({_pairs(_PAIR_COLUMNS, country=False)}) GROUP BY rule_a, rule_b", *FEAT
    )
)
def blocking_relaxed(spark, folder):
    return blocking.rule_pair_distribution(views.variants(spark, folder), keys=("entity_type",), unique=True)


@query(
    with_ctes(
        _metric_rows(
            "(SELECT (SELECT count(*)::DOUBLE FROM feat) AS n, (SELECT count(*)::DOUBLE FROM cand) AS p, "
            "(SELECT count(DISTINCT e)::DOUBLE FROM (SELECT entity_id_a AS e FROM cand UNION SELECT entity_id_b FROM cand)) AS c, "
            "(SELECT count(DISTINCT entity_id)::DOUBLE FROM feat) AS e)",
            records_for_blocking="n",
            all_vs_all_pairs="n * (n - 1) / 2",
            blocked_pairs_strict="p",
            reduction_pct_vs_all_vs_all="round(100 * (1 - p / (n * (n - 1) / 2)), 4)",
            entity_coverage_pct="round(100 * c / e, 4)",
        ),
        *FEAT,
        ("cand", _pairs("a.entity_id AS entity_id_a, b.entity_id AS entity_id_b")),
    )
)
def blocking_summary(spark, folder):
    return blocking.blocking_summary(views.variants(spark, folder), unique=True)


@query(
    with_ctes(f"SELECT rule_a, rule_b, count(*) AS count FROM ({_pairs(_PAIR_COLUMNS)}) GROUP BY rule_a, rule_b", *FEAT)
)
def rule_pair_distribution(spark, folder):
    return blocking.rule_pair_distribution(views.variants(spark, folder), unique=True)


# ---- vectors and similarity ----------------------------------------------------------------


def _vocabulary(spark, folder) -> DataFrame:
    return tfidf.vocabulary(views.variants(spark, folder))


@query(with_ctes("SELECT DISTINCT name_variant AS variant FROM var", *VAR))
def variant_vocabulary(spark, folder):
    return _vocabulary(spark, folder).select("variant")


@query(with_ctes("SELECT md5(variant) AS text_key, gram, count(*) AS tf FROM grams GROUP BY variant, gram", *TFIDF[:-4]))
def char_ngrams(spark, folder):
    return tfidf.term_counts(_vocabulary(spark, folder))


@query(with_ctes("SELECT gram, df FROM df", *TFIDF[:-2]))
def tfidf_df(spark, folder):
    return tfidf.document_frequencies(_vocabulary(spark, folder))


@query(with_ctes("SELECT md5(variant) AS text_key, gram, round(weight, 6) AS weight FROM vec", *TFIDF))
def tfidf_vectors(spark, folder):
    weights = tfidf.tfidf_weights(_vocabulary(spark, folder))
    return weights.withColumn("weight", F.round("weight", 6))


@query(
    with_ctes(
        "SELECT (SELECT count(DISTINCT variant) FROM tf) AS rows, (SELECT count(*) FROM df) AS vocabulary_size, "
        "(SELECT count(DISTINCT variant) FROM tf) = (SELECT count(*) FROM texts) AS rows_match_texts",
        *TFIDF[:-2],
    )
)
def tfidf_shape(spark, folder):
    return tfidf.tfidf_shape(_vocabulary(spark, folder))


@query(
    "SELECT vec_id, i, round(x / CASE WHEN n = 0 THEN 1 ELSE n END, 6) AS component FROM (SELECT vec_id, "
    "sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n, "
    "unnest(embedding)::DOUBLE AS x, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS i FROM embeddings)"
)
def dense_l2_normalize(spark, folder):
    unit = views.dense_vectors(spark, folder).selectExpr("vec_id", f"posexplode({unit_length('vector')}) AS (i, x)")
    return unit.selectExpr("vec_id", "i", "round(x, 6) AS component")


_SIM_OUT = "pair_id, entity_id_a, entity_id_b, variant_a, variant_b, country_code, rule_a, rule_b, cosine_similarity"


@query(with_ctes(f"SELECT {_SIM_OUT} FROM sim", *SIM))
def pair_cosine_tfidf(spark, folder):
    table = similarity.similarity_table(views.variants(spark, folder))
    return similarity.named_pairs(similarity.entity_pairs(table), table)


_DENSE_PAIRS = (
    "SELECT a.vec_id AS vec_id_a, b.vec_id AS vec_id_b, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / "
    "(sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * "
    "sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 6) AS cosine_similarity "
    "FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"
)


@query(_DENSE_PAIRS)
def pair_cosine_dense(spark, folder):
    vectors = views.dense_vectors(spark, folder)
    pairs = vectors.select(F.col("vec_id").alias("variant_a"), (F.col("vec_id") + 1).alias("variant_b"))
    scored = similarity.score_pairs_dense(pairs, vectors.select(F.col("vec_id").alias("variant"), "vector"))
    return scored.withColumnsRenamed({"variant_a": "vec_id_a", "variant_b": "vec_id_b"})


@query(
    with_ctes(
        "SELECT (SELECT min(variant) FROM texts) AS query_variant, y.variant AS neighbor_variant, "
        "round(sum(x.weight * y.weight), 6) AS cosine_similarity FROM vec x JOIN vec y USING (gram) "
        "WHERE x.variant = (SELECT min(variant) FROM texts) AND y.variant <> x.variant GROUP BY y.variant "
        "ORDER BY cosine_similarity DESC, neighbor_variant LIMIT 10",
        *TFIDF,
    )
)
def top_neighbors(spark, folder):
    texts = written(_vocabulary(spark, folder), "vocabulary")
    demo = texts.agg(F.min("variant")).first()[0]
    return similarity.top_neighbors(tfidf.gram_index(texts), demo, texts, k=10)


@query(
    "SELECT * FROM (SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id, round(list_dot_product(q.embedding::DOUBLE[], "
    "v.embedding::DOUBLE[]) / (sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) * "
    "sqrt(list_dot_product(v.embedding::DOUBLE[], v.embedding::DOUBLE[]))), 6) AS cosine_similarity, "
    "CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY cosine_similarity DESC, v.vec_id) AS INT) AS rank "
    "FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id "
    "WHERE q.vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label)) WHERE rank <= 10"
)
def top_neighbors_dense(spark, folder):
    vectors = views.dense_vectors(spark, folder)
    asked = vectors.groupBy("label").agg(F.min("vec_id").alias("vec_id")).select("vec_id")
    return similarity.top_neighbors_dense(vectors.select("vec_id", "vector"), asked)


@query(
    with_ctes(
        "SELECT a.variant AS variant_a, b.variant AS variant_b, round(sum(a.weight * b.weight), 6) AS cosine_similarity "
        "FROM vec a JOIN vec b USING (gram) WHERE a.variant IN (SELECT variant FROM texts ORDER BY variant LIMIT 12) "
        "AND b.variant IN (SELECT variant FROM texts ORDER BY variant LIMIT 12) GROUP BY a.variant, b.variant",
        *TFIDF,
    )
)
def similarity_matrix(spark, folder):
    return similarity.similarity_matrix(_vocabulary(spark, folder))


@query(
    with_ctes(
        "SELECT entity_id_a, entity_id_b, variant_a, variant_b, cosine_similarity, CAST(row_number() OVER (PARTITION BY entity_id_a "
        "ORDER BY cosine_similarity DESC, pair_id) AS INT) AS rank_within_entity_a FROM sim QUALIFY rank_within_entity_a <= 5",
        *SIM,
    )
)
def top_matches(spark, folder):
    table = similarity.similarity_table(views.variants(spark, folder))
    return similarity.top_matches(table).select(
        "entity_id_a", "entity_id_b", "variant_a", "variant_b", "cosine_similarity", "rank_within_entity_a"
    )


# ---- decisions -----------------------------------------------------------------------------


def _scores(spark, folder) -> DataFrame:
    """How many pairs have each score, written: a table that does not grow with the pairs."""
    return written(similarity.similarity_table(views.variants(spark, folder)).counts, "score-counts")


def _classified(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Thresholds, classified scores with their numbers of pairs, and classified entity pairs."""
    table = similarity.similarity_table(views.variants(spark, folder))
    counts = written(table.counts, "score-counts")
    thresholds = written(decisions.similarity_thresholds(counts), "thresholds")
    pairs = similarity.named_pairs(decisions.classify(similarity.entity_pairs(table), thresholds), table)
    return thresholds, decisions.classify(counts, thresholds), pairs


@query(with_ctes("SELECT * FROM lim", *SIM))
def similarity_thresholds(spark, folder):
    return decisions.similarity_thresholds(_scores(spark, folder))


@query(
    with_ctes(
        f"SELECT {_SIM_OUT}, confidence_level, confidence_level = 'medium' AS requires_manual_review, "
        "confidence_level = 'high' AS auto_expand_query FROM cls",
        *SIM,
    )
)
def classify_pairs(spark, folder):
    return _classified(spark, folder)[2]


@query(
    with_ctes(
        "SELECT pair_id, cosine_similarity, CASE WHEN cosine_similarity >= medium_min + 0.10::DOUBLE THEN 'high' ELSE 'medium' END "
        "AS priority FROM cls, lim WHERE confidence_level = 'medium'",
        *SIM,
    )
)
def review_queue(spark, folder):
    thresholds, _, pairs = _classified(spark, folder)
    return decisions.review_queue(pairs, thresholds).select("pair_id", "cosine_similarity", "priority")


@query(
    with_ctes(
        "SELECT confidence_level, count(*) AS count, round(count(*)::DOUBLE / (SELECT count(*) FROM cls) * 100, 4) AS pct "
        "FROM cls GROUP BY confidence_level",
        *SIM,
    )
)
def decision_summary(spark, folder):
    return decisions.decision_summary(_classified(spark, folder)[1])


@query(
    with_ctes(
        _metric_rows(
            "cls",
            pairs_total="count(*)",
            pairs_high_auto_expand="count(*) FILTER (confidence_level = 'high')",
            pairs_medium_manual_review="count(*) FILTER (confidence_level = 'medium')",
            pairs_low_discard="count(*) FILTER (confidence_level = 'low')",
        ),
        *SIM,
    )
)
def coverage_summary(spark, folder):
    return decisions.coverage_summary(_classified(spark, folder)[1])


@query(
    with_ctes(
        _metric_rows(
            "sim",
            pairs_scored="count(*)",
            similarity_mean="round(avg(cosine_similarity), 6)",
            similarity_std="round(stddev_samp(cosine_similarity), 6)",
            similarity_p50="round(quantile_cont(cosine_similarity, 0.50), 6)",
            similarity_p75="round(quantile_cont(cosine_similarity, 0.75), 6)",
            similarity_p90="round(quantile_cont(cosine_similarity, 0.90), 6)",
            similarity_p95="round(quantile_cont(cosine_similarity, 0.95), 6)",
        ),
        *SIM,
    )
)
def similarity_report(spark, folder):
    return decisions.similarity_report(_scores(spark, folder))
