"""Column profiles and descriptive statistics of any table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesieve.operators.facts import LABEL
from namesieve.operators.naming import metric_rows
from namesieve.operators.ranking import exact_quantiles, one_row
from namesieve.plans.storage import written

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")
# Columns that give the label away or only identify a row.
LEAKING = (
    "overall_decision",
    "run_id",
    "entity_id",
    "entity_name",
    "finding_summary",
    "context_summary",
    "source_breakdown_json",
    "supporting_evidence_json",
    "review_queue_json",
    "error_log_json",
)
WHISKER = 1.5


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]


def _as_text(df: DataFrame) -> DataFrame:
    """All columns as text; NaN counts as missing."""
    return df.selectExpr(
        *[f"CAST({'nanvl(' + c + ', NULL)' if t in ('float', 'double') else c} AS STRING) AS {c}" for c, t in df.dtypes]
    )


#: SQL of a 64-bit hash of ``value``, and of another one that tells values apart whose first hash is equal.
FIRST_HASH, SECOND_HASH = "xxhash64(value)", "xxhash64(1, value)"


def profile_columns(df: DataFrame, head: int | None = None) -> DataFrame:
    """Per column: type, nulls, distinct values, shares and whether it is constant; suspicious ones first.

    All columns, or the first ``head`` of that order. Distinct counts are exact, but no cell's text is shuffled: cells are
    counted by hash. Where cells of one hash have different second hashes, and only there, their texts are counted. Two
    values that agree in both 64-bit hashes would be one.
    """
    names = df.columns
    cells = _as_text(df).unpivot([], names, "column", "value")
    hashed = cells.selectExpr("column", f"if(value IS NULL, NULL, {FIRST_HASH}) AS h", f"if(value IS NULL, NULL, {SECOND_HASH}) AS g")
    values = written(hashed.groupBy("column", "h").agg(F.expr("count(*) AS n"), F.expr("min(g) AS low"), F.expr("max(g) AS high")), "hashed-cells")
    clashes = values.where("low <> high").select("column", "h")
    unique = F.expr("count(h)")
    if not clashes.isEmpty():
        texts = cells.where("value IS NOT NULL").withColumn("h", F.expr(FIRST_HASH)).join(clashes, ["column", "h"], "left_semi").distinct()
        more = texts.groupBy("column", "h").agg(F.expr("count(*) AS here"))
        values = values.join(more, ["column", "h"], "left")
        unique = F.expr("sum(if(h IS NULL, 0, coalesce(here, 1)))")
    per_column = values.groupBy("column").agg(
        F.expr("coalesce(sum(CASE WHEN h IS NULL THEN n END), 0) AS null_count"),
        unique.alias("n_unique"),
        F.expr("sum(n) AS n_rows"),
    )
    types = "map({})".format(", ".join(f"'{c}', '{t}'" for c, t in df.dtypes))
    profile = (
        per_column.selectExpr(
            "column",
            f"{types}[column] AS dtype",
            "null_count",
            "round(null_count / n_rows * 100, 4) AS null_pct",
            "n_unique",
            "round(n_unique / greatest(n_rows, 1) * 100, 4) AS unique_pct",
            "n_unique + CAST(null_count > 0 AS INT) <= 1 AS is_constant",
        )
        .orderBy(F.desc("is_constant"), F.desc("null_pct"), "n_unique", "column")
    )
    return profile if head is None else profile.limit(head)


def constant_columns(df: DataFrame) -> list[str]:
    """Names of columns with one value (nulls count as a value); one aggregate over the table, no distinct counts."""
    if not df.columns:
        return []
    ends = [F.struct(F.min(c).alias("low"), F.max(c).alias("high"), F.count(c).alias("n")).alias(c) for c in df.columns]
    found = _as_text(df).agg(F.count("*").alias("_rows"), *ends).first()
    return [c for c in df.columns if found[c]["n"] == 0 or found[c]["n"] == found["_rows"] and found[c]["low"] == found[c]["high"]]


def candidate_features(df: DataFrame, target: str = LABEL, excluded: Sequence[str] = LEAKING) -> list[str]:
    """Columns that may enter a model: not excluded, not the target, not constant."""
    out = {*excluded, target, *constant_columns(df)}
    return [c for c in df.columns if c not in out]


# The reasons in the feature catalog.
REASONS = {"target": "objetivo", "constant": "constante", "leaking": "leakage/identificador/texto-json crudo", "candidate": "candidata para modelado"}


def feature_catalog(df: DataFrame, target: str = LABEL, excluded: Sequence[str] = LEAKING) -> DataFrame:
    """Role of each column and why; one row per column."""
    constant = set(constant_columns(df))
    rows = []
    for c in df.columns:
        kind = "target" if c == target else "constant" if c in constant else "leaking" if c in excluded else "candidate"
        role = {"target": "target", "candidate": "candidate"}.get(kind, "excluded")
        rows.append((c, role, REASONS[kind]))
    return df.sparkSession.createDataFrame(rows, "feature string, role string, reason string").orderBy("role", "feature")


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """Rows that repeat an earlier row, and rows that repeat an earlier key (null is a key)."""
    rows = df.groupBy(*df.columns).agg(F.expr("count(*) AS n")).agg(F.expr("coalesce(sum(n - 1), 0) AS n"))
    keys = df.groupBy(key).agg(F.expr("count(*) AS n")).agg(F.expr("coalesce(sum(n - 1), 0) AS n"))
    both = rows.selectExpr("n AS duplicate_rows").join(keys.selectExpr("n AS duplicate_keys"), F.lit(True))
    return metric_rows(both)


def value_counts(df: DataFrame, column: str, top: int | None = None, keep_null: bool = False) -> DataFrame:
    """Counts and shares of the values of a column, largest first."""
    counts = (df if keep_null else df.where(f"{column} IS NOT NULL")).groupBy(column).agg(F.expr("count(*) AS count"))
    total = one_row(counts.agg(F.expr("sum(count) AS n")))
    out = counts.withColumn("_total", total).selectExpr(column, "count", "round(count / _total.n, 4) AS share")
    out = out.orderBy(F.desc("count"), column)
    return out if top is None else out.limit(top)


def long_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column and value, as double; NaN becomes null."""
    numbers = df.selectExpr(*[f"nullif(CAST({c} AS DOUBLE), CAST('NaN' AS DOUBLE)) AS {c}" for c in columns])
    return numbers.unpivot([], list(columns), "column", "value")


def describe(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max per column."""
    values = long_numbers(df, columns)
    plain = values.groupBy("column").agg(
        F.expr("count(value) AS count"),
        *[F.expr(f"round({f}(value), {digits}) AS {n}") for n, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))],
    )
    quartiles = exact_quantiles(values, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column"])
    return plain.join(quartiles, "column").selectExpr(
        "column", "count", "mean", "std", "min", *[f"round({q}, {digits}) AS {q}" for q in ("q25", "q50", "q75")], "max"
    )


def _with_fences(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values beside the quartile fences of their column; the fences are one row per column."""
    values = long_numbers(df, columns)
    quartiles = exact_quantiles(values, "value", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, ["column"])
    fences = quartiles.selectExpr("*", f"q1 - {WHISKER}D * (q3 - q1) AS low", f"q3 + {WHISKER}D * (q3 - q1) AS high")
    return values.join(fences, "column")


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Values outside 1.5 interquartile ranges per numeric column; shares are of all rows."""
    fenced = _with_fences(df, columns or numeric_columns(df))
    out = fenced.groupBy("column").agg(
        F.expr("count_if(value < low OR value > high) AS outlier_count"),
        F.expr("round(count_if(value < low OR value > high) / count(*) * 100, 4) AS outlier_pct"),
        F.expr("round(max(low), 6) AS low_bound"),
        F.expr("round(max(high), 6) AS high_bound"),
    )
    return out.orderBy(F.desc("outlier_pct"), "column")


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, and the last values inside the fences."""
    fenced = _with_fences(df, columns)
    inside = "value >= low AND value <= high"
    return fenced.groupBy("column").agg(
        F.expr(f"round(min(CASE WHEN {inside} THEN value END), 6) AS whisker_low"),
        *[F.expr(f"round(max({q}), 6) AS {q}") for q in ("q1", "q2", "q3")],
        F.expr(f"round(max(CASE WHEN {inside} THEN value END), 6) AS whisker_high"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20, weight: str = "1") -> DataFrame:
    """Counts in ``bins`` bins of equal width; the largest value belongs to the last bin."""
    ends = one_row(df.agg(F.expr(f"min({column}) AS low"), F.expr(f"max({column}) AS high")))
    width = f"((_ends.high - _ends.low) / {bins}D)"
    place = f"least(CAST(coalesce(floor(try_divide({column} - _ends.low, {width})), 0) AS INT), {bins - 1})"
    placed = df.where(f"{column} IS NOT NULL").withColumn("_ends", ends)
    return (
        placed.selectExpr(f"{place} AS bin", f"round(_ends.low + {width} * {place}, 6) AS bin_start", f"{weight} AS _w")
        .groupBy("bin", "bin_start")
        .agg(F.expr("CAST(sum(_w) AS BIGINT) AS count"))
        .orderBy("bin")
    )


def class_balance(df: DataFrame, label: str = LABEL, split: str = "split") -> DataFrame:
    """Rows and share of each class per split."""
    counts = df.groupBy(split, label).agg(F.expr("count(*) AS count"))
    return counts.selectExpr(
        split, label, "count", f"round(count / sum(count) OVER (PARTITION BY {split}), 4) AS share"
    ).orderBy(split, label)
