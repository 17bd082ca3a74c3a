import random

import numpy as np
import pandas as pd
import pytest

from namesieve.operators import knn, metrics, profiling, risk, splits
from namesieve.operators.ranking import exact_quantiles, running_totals, shuffled_rank


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [0.5] * 50 + [1.5], list(np.random.default_rng(1).normal(size=3000))])
def test_quantiles_are_exact(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double")
    probabilities = {f"q{i}": p for i, p in enumerate((0.0, 0.25, 0.33, 0.5, 0.9, 1.0))}
    row = exact_quantiles(df, "x", probabilities).first()
    for name, p in probabilities.items():
        assert row[name] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_running_totals_by_group(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randint(0, 500)) for _ in range(4000)] + [("a", 7)] * 3000
    got = running_totals(spark.createDataFrame(rows, "g string, x int"), "x", {"n": "1"}, ["g"], descending=True).collect()
    frame = pd.DataFrame(rows, columns=["g", "x"])
    for r in got:
        group = frame[frame.g == r["g"]]
        assert (r["n"], r["n_before"], r["n_all"]) == ((group.x == r["x"]).sum(), (group.x > r["x"]).sum(), len(group))


def test_shuffled_rank_is_a_permutation(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 'a', 'b') AS g")
    ranked = shuffled_rank(df, 42, "id", ["g"]).toPandas()
    for _, part in ranked.groupby("g"):
        assert sorted(part.shuffled_rank) == list(range(1, len(part) + 1))
        assert (part.group_size == len(part)).all()


def test_split_is_exact_and_complete(spark):
    df = spark.range(1003).selectExpr("id AS entity_id", "CAST(id % 7 = 0 AS INT) AS riesgo_fraude_aml")
    counts = splits.stratified_split(df).groupBy("riesgo_fraude_aml").pivot("split").count().toPandas()
    for _, r in counts.iterrows():
        n = r.train + r.validation + r.test
        held = -(-n * 2 // 5)
        assert (r.train, r.test) == (n - held, -(-held // 2))


def test_metrics_with_one_class_and_no_positives(spark):
    rows = [("one", 1, 1, 0.9), ("one", 1, 0, 0.2), ("none", 0, 0, 0.4), ("none", 0, 0, 0.4)]
    q = metrics.quality(spark.createDataFrame(rows, "model string, y int, p int, s double"), "y", "p", "s", ["model"])
    got = {r["model"]: r for r in q.collect()}
    assert got["one"]["roc_auc"] is None and got["one"]["pr_auc"] == 1.0
    assert (got["none"]["precision"], got["none"]["recall_pos"], got["none"]["f1"], got["none"]["pr_auc"]) == (0, 0, 0, 0)


@pytest.mark.parametrize("cells", [1, 6, None])
def test_neighbours_equal_brute_force(spark, cells):
    rng = np.random.default_rng(2)
    train = np.round(rng.normal(size=(300, 3)), 1)
    train[:100] = train[0]  # a third of the points are copies
    asked = np.vstack([np.round(rng.normal(size=(40, 3)), 1), train[:5]])
    t = spark.createDataFrame([(i, i % 2, v.tolist()) for i, v in enumerate(train)], "id int, label int, vector array<double>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id int, vector array<double>")
    got = {}
    for r in knn.neighbours(t, q, 4, cells).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["id"]
    for i, v in enumerate(asked):
        d = np.round(np.sqrt(((train - v) ** 2).sum(axis=1)), 9)
        order = sorted(range(len(train)), key=lambda j: (d[j], j))[:4]
        assert [got[i][k] for k in (1, 2, 3, 4)] == order


def test_equal_scores_are_low(spark):
    df = spark.createDataFrame([(i, "x", 0.25) for i in range(5)], "entity_id int, entity_name string, osint_risk_score double")
    assert {r["risk_level"] for r in risk.risk_levels(df).collect()} == {"bajo"}


def test_profile_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (2.0, None)], "a double, b string")
    got = {r["column"]: r for r in profiling.profile_columns(df).collect()}
    assert (got["a"]["null_count"], got["a"]["n_unique"], got["a"]["is_constant"]) == (1, 2, False)
    assert (got["b"]["null_count"], got["b"]["n_unique"], got["b"]["is_constant"]) == (3, 0, True)


def test_neighbours_in_many_parts_few_points_and_none(spark, monkeypatch):
    monkeypatch.setattr(knn, "TILE_QUERIES", 7)
    monkeypatch.setattr(knn, "LEAF_POINTS", 2)  # most leaves have fewer than k points
    rng = np.random.default_rng(5)
    train = np.hstack([rng.integers(0, 4, (60, 2)), np.eye(4)[rng.integers(0, 4, 60)]]).astype(float)
    asked = np.vstack([train[:20], np.repeat(train[:1], 30, axis=0), rng.integers(-9, 9, (10, 6))])
    schemas = "id string, label int, vector array<double>", "query_id int, vector array<double>"
    t = spark.createDataFrame([(f"n{i}", i % 2, v.tolist()) for i, v in enumerate(train)], schemas[0])
    q = spark.createDataFrame([(i if i else None, v.tolist()) for i, v in enumerate(asked)], schemas[1])
    got = {(r["query_id"], r["rank"]): r["id"] for r in knn.neighbours(t, q, 5).collect()}
    assert len(got) == 5 * (len(asked) - 1)
    for i, v in list(enumerate(asked))[1:]:
        d = np.round(np.sqrt(((train - v) ** 2).sum(axis=1)), 9)
        order = sorted(range(len(train)), key=lambda j: (d[j], f"n{j}"))[:5]
        assert [got[i, k] for k in range(1, 6)] == [f"n{j}" for j in order]
    assert knn.neighbours(t.limit(0), q, 5).count() == 0
    assert knn.neighbours(t.limit(2), q, 5).count() == 2 * (len(asked) - 1)


def test_cuts_deal_points_into_small_leaves():
    """Points of two categories never share a leaf's box, and no query needs the distance to a reference point of each cell."""
    rng = np.random.default_rng(6)
    rows = np.hstack([rng.normal(size=(4000, 2)), 9 * np.eye(3)[rng.integers(0, 3, 4000)]])
    leaf = knn.leaf_of(rows, knn.cuts(rows[:512], 64))
    assert len(np.unique(leaf)) > 48 and np.bincount(leaf).max() < 400
    assert all(len(np.unique(rows[leaf == x, 2:], axis=0)) == 1 for x in np.unique(leaf))
