"""The input tables of the registered queries, read from the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namesieve.operators.naming import name_variants, normalize_names


# Columns that stand for findings and evidence; the same text serves both engines.
EVIDENCE_COUNT = (
    "CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END"
)
IDENTITY_SCORE = (
    "CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 7 THEN CAST('NaN' AS DOUBLE) "
    "ELSE CAST(l_discount AS DOUBLE) * CAST(l_quantity AS DOUBLE) / CAST(5 AS DOUBLE) END"
)
REVIEW_REQUIRED = (
    "CASE WHEN l_returnflag = 'R' AND l_quantity >= 43 THEN 'True' WHEN l_returnflag = 'A' THEN 'False' ELSE '1.0' END"
)

# Grows with the length without a bound at which it stops; cut, not rounded, to three digits, so that there are ties.
Y_SCORE = "CAST((n_chars * 1000 - (n_chars * 1000) % (n_chars + 600)) / (n_chars + 600) AS DOUBLE) / CAST(1000 AS DOUBLE)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def entities(spark: SparkSession, folder: str) -> DataFrame:
    """Entity list: the whole text of each document as its name, some with a legal form, language as country."""
    suffix = (
        "CASE WHEN doc_id % 3 <> 0 THEN '' WHEN doc_id % 5 = 0 THEN ' S.A.' WHEN doc_id % 5 = 1 THEN ' S. de R.L. de C.V.' "
        "WHEN doc_id % 5 = 2 THEN ' LLC' WHEN doc_id % 5 = 3 THEN ' Group Holdings' ELSE ' & Co.' END"
    )
    return table(spark, folder, "documents").selectExpr(
        "doc_id AS entity_id",
        f"concat(text, {suffix}) AS entity_name",
        "CASE WHEN doc_id % 3 = 0 THEN 'MORAL' ELSE 'FISICA' END AS entity_type",
        "nullif(lang, 'de') AS country_code",
    )


def normalized(spark: SparkSession, folder: str) -> DataFrame:
    return normalize_names(entities(spark, folder))


def variants(spark: SparkSession, folder: str) -> DataFrame:
    return name_variants(normalized(spark, folder))


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Entity catalog for facts and scores: customers with their nation."""
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey AS entity_id",
        "c_name AS entity_name",
        "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'MORAL' ELSE 'FISICA' END AS entity_type",
        "n_name AS country_code",
    )


def sources(spark: SparkSession, folder: str) -> DataFrame:
    """Source results per entity, with null evidence counts."""
    return table(spark, folder, "orders").selectExpr(
        "o_custkey AS entity_id", "o_orderpriority AS source", f"{EVIDENCE_COUNT} AS evidence_count"
    )


def evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Evidence items per entity, with null and NaN scores and a text that is not a review flag."""
    lineitem = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "o_custkey AS entity_id",
        f"{IDENTITY_SCORE} AS identity_score",
        f"{REVIEW_REQUIRED} AS review_required",
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions with tied scores; one model per language."""
    labels, documents = table(spark, folder, "labels"), table(spark, folder, "documents")
    return labels.join(documents.select("doc_id", "lang", "n_chars"), "doc_id").selectExpr(
        "doc_id AS id",
        "lang AS model",
        "CASE WHEN doc_id % 2 = 0 THEN 'train' ELSE 'validation' END AS split",
        "quality AS y_true",
        f"{Y_SCORE} AS y_score",
        "CASE WHEN n_chars >= 600 THEN 1 ELSE 0 END AS y_pred",
    )


def dense_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").selectExpr("vec_id", "embedding AS vector", "label")


# The same tables for the DuckDB side.
SQL = {
    "ent": r"""
SELECT doc_id AS entity_id,
  text || (CASE WHEN doc_id % 3 <> 0 THEN '' WHEN doc_id % 5 = 0 THEN ' S.A.' WHEN doc_id % 5 = 1 THEN ' S. de R.L. de C.V.'
         WHEN doc_id % 5 = 2 THEN ' LLC' WHEN doc_id % 5 = 3 THEN ' Group Holdings' ELSE ' & Co.' END) AS entity_name,
  CASE WHEN doc_id % 3 = 0 THEN 'MORAL' ELSE 'FISICA' END AS entity_type,
  nullif(lang, 'de') AS country_code
FROM documents""",
    "cat": """
SELECT c_custkey AS entity_id, c_name AS entity_name,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'MORAL' ELSE 'FISICA' END AS entity_type, n_name AS country_code
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "src": f"SELECT o_custkey AS entity_id, o_orderpriority AS source, {EVIDENCE_COUNT} AS evidence_count FROM orders",
    "evd": f"SELECT o_custkey AS entity_id, {IDENTITY_SCORE} AS identity_score, {REVIEW_REQUIRED} AS review_required "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "pred": f"""
SELECT d.doc_id AS id, d.lang AS model, CASE WHEN d.doc_id % 2 = 0 THEN 'train' ELSE 'validation' END AS split,
  l.quality AS y_true, {Y_SCORE} AS y_score,
  CASE WHEN d.n_chars >= 600 THEN 1 ELSE 0 END AS y_pred
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
}


def with_ctes(query: str, *ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes) + "\n" + query


def ctes(*names: str) -> list[tuple[str, str]]:
    return [(n, SQL[n]) for n in names]
