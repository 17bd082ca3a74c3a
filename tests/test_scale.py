"""Operators that work in parts: results do not depend on how many, and plans do not grow."""

import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from namesieve.functions.names import strip_accents
from namesieve.operators import blocking, profiling, similarity
from namesieve.sources import tables


def plan_lines(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("\n")


def test_dense_queries_in_tiles(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.integers(-3, 4, (300, 5)).astype(float)  # small whole numbers: many ties
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None)], "vec_id long, vector array<double>")
    unit = x / np.where((n := np.sqrt((x * x).sum(axis=1))) == 0, 1, n)[:, None]
    cosine = np.round(unit @ unit.T, 6) + 0.0
    plans = set()
    for asked in (3, 200):
        monkeypatch.setattr(similarity, "QUERY_BLOCK", 30)
        monkeypatch.setattr(similarity, "VECTOR_BLOCK", 70)
        found = similarity.top_neighbors_dense(vectors, vectors.where(f"vec_id < {asked} OR vec_id = 900"), k=4)
        plans.add(plan_lines(found))
        got = {(r["query_id"], r["rank"]): (r["neighbor_id"], r["cosine_similarity"] + 0.0) for r in found.collect()}
        for q in range(asked):
            order = [j for j in np.lexsort((np.arange(300), -cosine[q])) if j != q][:4]
            assert [got[q, r + 1] for r in range(4)] == [(j, cosine[q, j]) for j in order]
        assert len(got) == 4 * asked
    assert len(plans) == 1


def test_hangul_syllables_become_letters(spark):
    syllables = [chr(c) for c in range(0xAC00, 0xD7A4)]
    texts = ["".join(syllables[i : i + 500]) + " é" for i in range(0, len(syllables), 500)] + ["plain", "한 글 ﬁ", None]
    got = [r["t"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").selectExpr(f"{strip_accents('t')} AS t").collect()]
    wanted = [t and "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]
    assert got == wanted


@pytest.mark.parametrize("first", ["xxhash64(value)", "pmod(xxhash64(value), 3)"])
def test_profile_counts_distinct_values_by_hash(spark, monkeypatch, first):
    monkeypatch.setattr(profiling, "FIRST_HASH", first)
    rows = [(i % 7, None if i % 5 == 0 else f"text {i % 11}", float("nan") if i % 2 else 1.5, None) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b string, c double, d string")
    got = {r["column"]: (r["null_count"], r["n_unique"], r["is_constant"]) for r in profiling.profile_columns(df).collect()}
    assert got == {"a": (0, 7, False), "b": (12, 11, False), "c": (30, 1, False), "d": (60, 0, True)}


@pytest.mark.parametrize("block", ["700b", "128m"])
def test_quoted_line_breaks_in_blocks(spark, tmp_path, block):
    rng = random.Random(3)
    pieces = ["a", ",", '"', "\n", "\r\n", "é", " ", "\n\n", '""', "x,y", "\r"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 12))).strip() or None, rng.random()) for i in range(400)]
    rows.append((400, '"' + "line\n" * 500 + '"', 0.5))
    df = spark.createDataFrame(rows, "id long, text string, x double")
    for n, name in ((1, "one"), (3, "three")):
        tables.write_csv(df.repartition(n), str(tmp_path / name))
        whole = spark.read.options(header=True, multiLine=True, quote='"', escape='"').schema("id long, text string, x double").csv(str(tmp_path / name))
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        try:
            read = tables.read_csv(spark, str(tmp_path / name), "id long, text string, x double", multi_line=True, position="p")
            got = sorted((r["id"], r["text"], r["x"]) for r in read.collect())
            tasks = spark.read.text(str(tmp_path / name)).rdd.getNumPartitions()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert got == sorted(rows) == sorted(map(tuple, whole.collect()))
        assert block == "128m" or tasks > n


def test_places_follow_the_lines(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t\n{i}") for i in range(50)], "id long, text string").coalesce(1)
    tables.write_csv(df, str(tmp_path / "c"))
    read = tables.read_csv(spark, str(tmp_path / "c"), "id long, text string", multi_line=True, position="p")
    assert [r["id"] for r in read.orderBy("p").collect()] == list(range(50))
    assert read.where(F.col("text").isNull()).count() == 0


def test_near_cells_meet_by_bands_of_length(spark):
    """Two thousand lengths in one block: every row meets three bands of the gap's width, not all the others."""
    rows = [(i, "FISICA", "MX", "a " + "b" * (7 * i + 1), "base_canonical") for i in range(2000)]
    schema = "entity_id long, entity_type string, country_code string, name_variant string, variant_rule string"
    variants = spark.createDataFrame(rows, schema)
    cells = blocking.cells(blocking.blocking_features(variants), blocking.block_columns())
    keyed = blocking.near_join(cells, blocking.block_columns(), (2, 15))
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    assert "_band" in plan.split("Join Inner", 1)[1].split("\n")[0]
    near = sum(min(i + 2, 1999) - max(i - 2, 0) for i in range(2000)) // 2  # 7 characters apart: two on either side
    summary = {r["metric"]: r["value"] for r in blocking.blocking_summary(variants, unique=True).collect()}
    assert summary["blocked_pairs_strict"] == near
    counts = blocking.rule_pair_distribution(variants, unique=True).collect()
    assert [tuple(r) for r in counts] == [("base_canonical", "base_canonical", near)]


def test_only_differing_digits_of_ids_are_levels(spark):
    rows = [(i, "FISICA", "MX", "ana bo", "base_canonical") for i in (-(1 << 62), -1, 0, 5, 1 << 62, 1 << 62)]
    schema = "entity_id long, entity_type string, country_code string, name_variant string, variant_rule string"
    for some in (rows, rows[2:4], rows[:1]):
        ids = [r[0] for r in some]
        wanted = sum(a < b for a in ids for b in ids)
        found = blocking.rule_pair_distribution(spark.createDataFrame(some, schema), unique=True).collect()
        assert [r["count"] for r in found] == ([wanted] if wanted else [])
