"""Ranks, running totals and quantiles over whole tables without a single-task sort.

Everything here works on two levels: rows fall into buckets that follow the wanted order,
per-bucket totals (a table with a fixed number of rows) give each bucket its offset, and only
the inside of a bucket is ordered by a window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namesieve.plans.storage import written

HASH_DIGITS = 4  # 16**4 = 65,536 buckets: some 150,000 rows in each of them at ten thousand million rows
LEAST_BUCKETS, ROOT_SHARE = 256, 64
EARLIER = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def one_row(df: DataFrame) -> Column:
    """The single row of ``df`` as a struct that other tables can use like a constant."""
    return df.select(F.struct(*df.columns).alias("row")).scalar()


def shuffle_key(seed: int | str, *parts: Column) -> Column:
    """Seeded pseudo-random text; the same in every engine that has md5."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def shuffled_rank(df: DataFrame, seed: int, ident: str, by: Sequence[str] = (), rank: str = "shuffled_rank") -> DataFrame:
    """Add the 1-based rank of each row in seeded random order inside ``by``, and ``group_size``.

    ``ident`` must be unique in each group. ``by`` should have few values (labels, folds); the
    size of a group does not matter.
    """
    keyed = df.withColumn("_key", shuffle_key(seed, F.col(ident)))
    keyed = keyed.withColumn("_bucket", F.substring("_key", 1, HASH_DIGITS))
    per_bucket = keyed.groupBy(*by, "_bucket").agg(F.expr("count(*) AS _n"))
    group = ", ".join(by) or "1"
    offsets = per_bucket.selectExpr(
        *[f"{c} AS _g_{c}" for c in by],
        "_bucket AS _b",
        f"coalesce(sum(_n) OVER (PARTITION BY {group} ORDER BY _bucket {EARLIER}), 0) AS _offset",
        f"sum(_n) OVER (PARTITION BY {group}) AS group_size",
    )
    same = " AND ".join(["_bucket = _b", *[f"{c} <=> _g_{c}" for c in by]])
    inside = f"row_number() OVER (PARTITION BY {', '.join([*by, '_bucket'])} ORDER BY _key, {ident}) AS _inside"
    ranked = keyed.selectExpr("*", inside).join(offsets, F.expr(same))
    return ranked.selectExpr(*df.columns, "group_size", f"_offset + _inside AS {rank}")


def ordered_rank(df: DataFrame, column: str, rank: str = "ordered_rank") -> DataFrame:
    """Distinct non-null values of ``column`` and their place in its order, counted from 1; works for any type that has an order."""
    values = df.where(f"{column} IS NOT NULL").select(column).distinct()
    ranged = written(values.repartitionByRange(column).withColumn("_part", F.spark_partition_id()), "ranged-values")
    sizes = ranged.groupBy("_part").agg(F.expr("count(*) AS _n"))
    offsets = sizes.selectExpr("_part", f"coalesce(sum(_n) OVER (ORDER BY _part {EARLIER}), 0) AS _offset")  # one row per task
    inside = ranged.selectExpr("*", f"row_number() OVER (PARTITION BY _part ORDER BY {column}) AS _inside")
    return inside.join(offsets, "_part").selectExpr(column, f"_offset + _inside AS {rank}")


def running_totals(
    df: DataFrame, value: str, totals: dict[str, str], by: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """One row per distinct ``value`` (and ``by``) with, for each named count in ``totals``:

    its own sum ``name``, ``name_before`` over the values that come earlier, and ``name_all``.
    ``totals`` are integer SQL expressions. Equal values are added up before the shuffle, and the value
    ranges come from approximate quantiles, so a value that holds a third of the rows is one row here.
    The result does not depend on how good the approximation is. The distinct values are written once, since
    they are read three times and are far fewer than the rows behind them.
    """
    counts = df.where(f"{value} IS NOT NULL AND NOT isnan(CAST({value} AS DOUBLE))")
    counts = counts.groupBy(*by, value).agg(*[F.expr(f"CAST(sum({c}) AS BIGINT) AS {n}") for n, c in totals.items()])
    counts = written(counts, "value-counts")
    # Each row is compared with all edges, so their number grows with the root of the number of values.
    buckets = max(LEAST_BUCKETS, math.isqrt(counts.count()) // ROOT_SHARE)
    shares = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    edges = counts.agg(F.expr(f"array_distinct(percentile_approx(CAST({value} AS DOUBLE), array({shares}), 10000)) AS edges"))
    bucket = f"size(filter(_edges.edges, e -> e <= CAST({value} AS DOUBLE)))"
    bucketed = counts.withColumn("_edges", one_row(edges)).selectExpr(*counts.columns, f"{bucket} AS _bucket")

    names, direction, group = list(totals), "DESC" if descending else "ASC", ", ".join(by) or "1"
    offsets = (
        bucketed.groupBy(*by, "_bucket")
        .agg(*[F.expr(f"sum({n}) AS {n}") for n in names])
        .selectExpr(
            *[f"{c} AS _g_{c}" for c in by],
            "_bucket AS _b",
            *[f"coalesce(sum({n}) OVER (PARTITION BY {group} ORDER BY _bucket {direction} {EARLIER}), 0) AS _{n}_offset" for n in names],
            *[f"sum({n}) OVER (PARTITION BY {group}) AS {n}_all" for n in names],
        )
    )
    inside = f"(PARTITION BY {', '.join([*by, '_bucket'])} ORDER BY {value} {direction} {EARLIER})"
    partial = bucketed.selectExpr("*", *[f"coalesce(sum({n}) OVER {inside}, 0) AS _{n}_inside" for n in names])
    same = " AND ".join(["_bucket = _b", *[f"{c} <=> _g_{c}" for c in by]])
    return partial.join(offsets, F.expr(same)).selectExpr(
        *by,
        value,
        *names,
        *[f"_{n}_offset + _{n}_inside AS {n}_before" for n in names],
        *[f"{n}_all" for n in names],
    )


def exact_quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = (), weight: str = "1"
) -> DataFrame:
    """Linearly interpolated quantiles, one column per name in ``probabilities``; nulls and NaN are left out.

    Holds no value list in one task, unlike ``percentile``.
    """
    totals = running_totals(df, value, {"n": weight}, by)
    wanted = []
    for name, p in probabilities.items():
        at = f"({float(p)}D * (n_all - 1))"
        ends = [
            f"max(CASE WHEN n_before <= {side}({at}) AND {side}({at}) < n_before + n THEN CAST({value} AS DOUBLE) END)"
            for side in ("floor", "ceil")
        ]
        wanted.append(F.expr(f"{ends[0]} + ({ends[1]} - {ends[0]}) * max({at} - floor({at})) AS {name}"))
    return totals.groupBy(*by).agg(*wanted)
