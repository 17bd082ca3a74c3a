"""Feature steps fitted with aggregates and stored as MLlib stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesieve.functions.text import sql_string
from namesieve.operators.profiling import long_numbers, numeric_columns
from namesieve.operators.ranking import exact_quantiles


def route_columns(df: DataFrame, candidates: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric and other columns among the candidates."""
    numeric = set(numeric_columns(df))
    return [c for c in candidates if c in numeric], [c for c in candidates if c not in numeric]


def impute_scale(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict[str, str]:
    """SQL of each prepared column, with parameters fitted on ``train``.

    ``num__x``: missing values become the exact median, then zero mean and unit population deviation.
    ``value__c``: missing values become the most frequent text, the smallest of several.
    Only one row per column reaches the driver. The MLlib imputer and scaler use an approximate median and
    the sample deviation, which give other numbers.
    """
    out = {}
    if numeric:
        medians = exact_quantiles(long_numbers(train, numeric), "value", {"median": 0.5}, ["column"])
        median = {r["column"]: r["median"] for r in medians.collect()}
        filled = {
            c: f"coalesce(nullif(CAST({c} AS DOUBLE), CAST('NaN' AS DOUBLE)), {median.get(c, 0.0)!r}D)" for c in numeric
        }
        sums = [F.expr(f"{f}({e}) AS {f}_{c}") for c, e in filled.items() for f in ("avg", "stddev_pop")]
        fitted = train.agg(*sums).first()
        for c, e in filled.items():
            out[f"num__{c}"] = f"({e} - {fitted[f'avg_{c}']!r}D) / {fitted[f'stddev_pop_{c}'] or 1.0!r}D"
    if categorical:
        counts = train.unpivot([], [F.col(c).cast("string").alias(c) for c in categorical], "column", "value")
        counts = counts.where("value IS NOT NULL").groupBy("column", "value").agg(F.expr("count(*) AS n"))
        modes = counts.groupBy("column").agg(F.expr("min_by(value, struct(-n, value)) AS value")).collect()
        mode = {r["column"]: r["value"] for r in modes}
        for c in categorical:
            out[f"value__{c}"] = f"coalesce(CAST({c} AS STRING), {sql_string(mode.get(c, ''))})"
    return out


def feature_pipeline(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> PipelineModel:
    """Fitted steps that add ``features``: scaled numbers and one slot per known category.

    A category unseen in training gets zeros. All stages can be saved with the model.
    """
    prepared = impute_scale(train, numeric, categorical)
    columns = ", ".join(f"{e} AS {name}" for name, e in prepared.items())
    stages = [SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")]
    if categorical:
        values, index, slots = ([f"{p}__{c}" for c in categorical] for p in ("value", "index", "cat"))
        stages += [
            StringIndexer(inputCols=values, outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=index, outputCols=slots, dropLast=True, handleInvalid="error"),
        ]
    inputs = [f"num__{c}" for c in numeric] + [f"cat__{c}" for c in categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return Pipeline(stages=stages).fit(train)


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the slots of an assembled vector, in order."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"].values()
    return [a["name"] for a in sorted((a for g in groups for a in g), key=lambda a: a["idx"])]
