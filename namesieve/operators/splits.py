"""Stratified splits and folds by seeded hash order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesieve.operators.facts import LABEL
from namesieve.operators.ranking import one_row, shuffled_rank

SEED = 42


def stratified_split(df: DataFrame, label: str = LABEL, ident: str = "entity_id", seed: int = SEED) -> DataFrame:
    """Add ``split``: 60 % train, 20 % validation and 20 % test of each class, exact and repeatable."""
    ranked = shuffled_rank(df, seed, ident, [label])
    held = "CAST(ceil(group_size * 2 / 5) AS BIGINT)"
    split = (
        f"CASE WHEN shuffled_rank <= group_size - {held} THEN 'train' "
        f"WHEN shuffled_rank <= group_size - CAST(ceil({held} / 2) AS BIGINT) THEN 'validation' ELSE 'test' END"
    )
    return ranked.selectExpr(*df.columns, f"{split} AS split")


def stratified_folds(df: DataFrame, folds: int, label: str = LABEL, ident: str = "entity_id", seed: int = SEED) -> DataFrame:
    """Add ``fold`` 0..folds-1 with equal class shares."""
    ranked = shuffled_rank(df, seed + 1, ident, [label])
    return ranked.selectExpr(*df.columns, f"CAST(pmod(shuffled_rank - 1, {folds}) AS INT) AS fold")


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.expr("count(*) AS count"))
    every = one_row(counts.agg(F.expr("sum(count) AS n"), F.expr("count(*) AS k")))
    return counts.withColumn("_e", every).selectExpr(label, "count", "_e.n / (_e.k * count) AS weight")
