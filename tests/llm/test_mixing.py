import numpy as np
import pytest

from namesieve.llm import mixing


def test_raking_meets_feasible_margins():
    rng = np.random.default_rng(0)
    tokens = rng.integers(50, 1000, 60).astype(float)
    codes = [np.repeat(np.arange(5), 12), np.tile(np.repeat(np.arange(4), 3), 5), np.tile(np.arange(3), 20)]
    aims = [mixing._shares(np.bincount(c, tokens), [str(i) for i in range(c.max() + 1)], None, 0.7) for c in codes]
    budget = 0.3 * tokens.sum()
    weight = mixing.rake(tokens, codes, aims, budget)
    assert (weight <= tokens + 1e-6).all() and weight.sum() == pytest.approx(budget)
    for code, aim in zip(codes, aims):
        assert np.bincount(code, weight) == pytest.approx(aim * budget, rel=1e-4)
    # Raking keeps the odds ratios of the tokens as long as no cell is used up.
    x, t = weight.reshape(5, 4, 3), tokens.reshape(5, 4, 3)
    ratio = lambda a: a[0, 0, 0] * a[1, 1, 0] / (a[0, 1, 0] * a[1, 0, 0])
    assert ratio(x) == pytest.approx(ratio(t), rel=1e-4)


def test_fill_is_the_one_factor():
    tokens, weight = np.array([10.0, 100.0, 50.0, 0.0]), np.array([10.0, 1.0, 2.0, 5.0])
    got = mixing.fill(tokens, weight, 60.0)
    assert got.sum() == pytest.approx(60) and got[0] == 10 and got[3] == 0 and got[2] / got[1] == pytest.approx(2)
    assert mixing.fill(tokens, weight, 1000.0).sum() == 160
    assert mixing.fill(tokens, weight, 0.0).sum() == 0


def test_query_equals_brute_force(spark, folder):
    rows = mixing.op7_mixing(spark, folder).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} == set(docs)
    cells = {}
    for r in rows:
        d = docs[r["doc_id"]]
        assert r["tokens"] == len((d["text"] or "").split()) and (r["source"], r["lang"]) == (d["source"], d["lang"])
        cell = cells.setdefault((r["source"], r["lang"], r["topic"]), [0, set()])
        cell[0] += r["tokens"]
        cell[1].add(r["rate"])
    keys = sorted(cells)
    tokens = np.array([float(cells[k][0]) for k in keys])
    codes, aims = [], []
    for m, power in enumerate(mixing.POWERS.values()):
        values = sorted({k[m] for k in keys})
        codes.append(np.array([values.index(k[m]) for k in keys]))
        sums = np.bincount(codes[-1], tokens)
        aims.append(sums**power / (sums**power).sum())
    want = mixing.rake(tokens, codes, aims, mixing.KEEP * tokens.sum()) / np.maximum(tokens, 1)
    for k, rate in zip(keys, want):
        assert len(cells[k][1]) == 1 and next(iter(cells[k][1])) == pytest.approx(rate, abs=1e-9)
    expected = sum(r["tokens"] * r["rate"] for r in rows)
    assert expected == pytest.approx(mixing.KEEP * tokens.sum(), rel=0.02)


def test_draws_follow_rates_and_targets(spark):
    docs = spark.range(20000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 5) END AS source", "if(id % 2 = 0, 'en', 'fr') AS lang", "'t' AS topic", "100L AS tokens")
    rows = mixing.mix(docs, {"source": {"hot": 0.2, "s0": 0.3, "s1": 0.5, "unheard": 0.0}}, keep=0.2).where("drawn").groupBy("source").count().collect()
    share = {r["source"]: r["count"] / sum(x["count"] for x in rows) for r in rows}
    assert set(share) == {"hot", "s0", "s1"}
    for name, want in {"hot": 0.2, "s0": 0.3, "s1": 0.5}.items():
        assert share[name] == pytest.approx(want, abs=0.04)
    again = mixing.mix(docs.repartition(7), {"source": {"hot": 0.2, "s0": 0.3, "s1": 0.5}}, keep=0.2).where("drawn")
    assert again.count() == sum(r["count"] for r in rows)


def test_texts_under_one_id_are_drawn_each_at_its_rate(spark):
    rows = [(i, f"{kind} words number {i}", "en", kind, 10) for i in range(600) for kind in ("hot", "rare")]
    rows += [(10_000 + i, f"more hot words {i}", "en", "hot", 10) for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r["source"]: r["count"] for r in mixing.mixing_stage(spark, docs, "").where("doc_id < 600").groupBy("source").count().collect()}
    assert kept["rare"] == 600 and kept["hot"] < 500


def test_equal_small_values_get_one_rate(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id < 1500, 'big', concat('tiny', id)) AS source", "'en' AS lang", "'t' AS topic", "10L AS tokens")
    rates = {(r["source"] == "big", r["rate"]) for r in mixing.mix(docs).collect()}
    assert len(rates) == 2


def test_each_of_many_small_values_gets_its_target(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "if(id < 2000, 'hot', concat('s', id)) AS source", "if(id % 2 = 0, 'en', 'fr') AS lang", "'t' AS topic", "if(id < 2000, 500, 10 + id % 50) AS tokens")
    rows = mixing.mix(docs, keep=0.1).collect()
    want, got = {}, {}
    for r in rows:
        want[r["source"]] = want.get(r["source"], 0) + r["tokens"]
        got[r["source"]] = got.get(r["source"], 0.0) + r["tokens"] * r["rate"]
    budget, raw = 0.1 * sum(want.values()), sum(x**0.7 for x in want.values())
    # What a source cannot supply is not made up for; all others meet their own target.
    aims = {s: min(x, x**0.7 / raw * budget) for s, x in want.items()}
    assert got["s2000"] / got["s2049"] == pytest.approx(aims["s2000"] / aims["s2049"], rel=0.05)
    assert len({round(r["rate"], 6) for r in rows if r["source"] != "hot"}) > 20


def test_cells_as_a_table_give_the_same_rates(spark):
    docs = spark.range(600).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 40)) AS source", "if(id % 7 = 0, NULL, if(id % 2 = 0, 'en', 'fr')) AS lang", "'t' AS topic", "10 + id % 90 AS tokens")
    for targets in (None, {"source": {"hot": 0.2, "s1": 0.3, "s2": 0.5}}):
        here = {r["doc_id"]: r["rate"] for r in mixing.mix(docs, targets, keep=0.1).collect()}
        there = {r["doc_id"]: r["rate"] for r in mixing.mix(docs, targets, keep=0.1, held=0).collect()}
        assert there == {k: pytest.approx(v, abs=1e-6) for k, v in here.items()}


def test_odd_rows_and_empty_table(spark, odd_docs):
    weighed = mixing.weighed(odd_docs.drop("tokens", "topic"))
    assert weighed.where("topic = 'none'").count() == 9
    rows = mixing.mix(weighed).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["rate"] <= 1 for r in rows)
    assert mixing.mix(weighed.limit(0)).count() == 0
    stage = mixing.mixing_stage(spark, odd_docs, "")
    assert stage.columns == odd_docs.columns
    ids = [r["doc_id"] for r in stage.collect()]
    assert ids.count(1) in (0, 2)
