"""Which features matter: tables from fitted models and their agreement."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namesieve.operators.metrics import class_metrics
from namesieve.operators.ranking import shuffled_rank

TOP = 20
ZERO_COEFFICIENT = "1e-6D"


def base_feature_name(column: str, short: bool = False) -> str:
    """SQL for the input column behind a transformed feature name.

    Long rule: what follows the last ``__``. Short rule: ``num__`` is dropped; for ``cat__`` only the text up
    to the first ``_`` remains.
    """
    if not short:
        return f"element_at(split({column}, '__'), -1)"
    return (
        f"CASE WHEN startswith({column}, 'num__') THEN substr({column}, 6) "
        f"WHEN startswith({column}, 'cat__') THEN split(substr({column}, 6), '_')[0] ELSE {column} END"
    )


def importance_table(spark, names: Sequence[str], values: Sequence[float], column: str) -> DataFrame:
    """One row per model feature, largest value first; as long as the feature vector."""
    rows = [(n, float(v)) for n, v in zip(names, values, strict=True)]
    return spark.createDataFrame(rows, f"feature string, {column} double").orderBy(F.desc(column), "feature")


def top_features(importance: DataFrame, column: str, name: str, top: int = TOP) -> DataFrame:
    """Distinct base names of the ``top`` features."""
    best = importance.orderBy(F.desc(column), "feature").limit(top)
    return best.selectExpr(f"{name} AS feature").distinct()


def importance_consensus(linear: DataFrame, tree: DataFrame, permutation: DataFrame, top: int = TOP) -> DataFrame:
    """Membership of each feature in the three top lists and its votes, most votes first."""
    short = base_feature_name("feature", short=True)
    lists = {
        "in_logreg_top20": top_features(linear, "abs_coef", short, top),
        "in_tree_top20": top_features(tree, "tree_importance", short, top),
        "in_perm_top20": top_features(permutation, "perm_importance_mean", "feature", top),
    }
    out = None
    for flag, names in lists.items():
        marked = names.withColumn(flag, F.lit(True))
        out = marked if out is None else out.join(marked, "feature", "full")
    flags = [f"coalesce({f}, false)" for f in lists]
    votes = " + ".join(f"CAST({f} AS INT)" for f in flags)
    return out.selectExpr("feature", *[f"{e} AS {f}" for e, f in zip(flags, lists)], f"{votes} AS votes").orderBy(
        F.desc("votes"), "feature"
    )


def irrelevant_features(linear: DataFrame, tree: DataFrame, permutation: DataFrame) -> DataFrame:
    """Features without effect in all three tables."""
    names = [
        permutation.where("perm_importance_mean <= 0").select("feature"),
        tree.where("tree_importance = 0").select("feature"),
        linear.where(f"abs_coef < {ZERO_COEFFICIENT}").select("feature"),
    ]
    return names[0].intersect(names[1]).intersect(names[2]).orderBy("feature")


def permutation_importance(
    rows: DataFrame,
    features: Sequence[str],
    predict: Callable[[DataFrame], DataFrame],
    label: str,
    ident: str,
    metric: str = "f1",
    repeats: int = 10,
    seed: int = 42,
) -> DataFrame:
    """Mean and deviation of the metric's drop when one input column is shuffled.

    Row k of a fixed random order takes the value of row k of another random order: two ranks joined on k
    shuffle a column of any size. All repeats and columns are scored by one pass of the model.
    ``predict`` adds ``y_pred``.
    """
    kept = [ident, label, *features]
    base = shuffled_rank(rows.select(*kept), seed, ident, rank="_k").drop("group_size")
    donors = None
    for r in range(1, repeats + 1):
        donor = shuffled_rank(rows.select(ident, *features), seed + r, ident, rank="_k").selectExpr(
            "_k", f"{r} AS repeat", f"struct({', '.join(features)}) AS _donor"
        )
        donors = donor if donors is None else donors.unionByName(donor)
    which = ", ".join(f"'{f}'" for f in features)
    mixed = base.join(donors, "_k").selectExpr("*", f"explode(array({which})) AS feature")
    shuffled = mixed.selectExpr(
        ident, label, "repeat", "feature", *[f"if(feature = '{f}', _donor.{f}, {f}) AS {f}" for f in features]
    )
    whole = class_metrics(predict(rows.select(*kept)), label, "y_pred").selectExpr(f"{metric} AS whole")
    parts = class_metrics(predict(shuffled), label, "y_pred", ["feature", "repeat"])
    drops = parts.join(F.broadcast(whole), F.lit(True)).selectExpr("feature", f"whole - {metric} AS drop")  # one row
    return (
        drops.groupBy("feature")
        .agg(F.expr("avg(drop) AS perm_importance_mean"), F.expr("stddev_pop(drop) AS perm_importance_std"))
        .orderBy(F.desc("perm_importance_mean"), "feature")
    )
