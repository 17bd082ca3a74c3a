"""Validation pairs: how often the variants are made to draw them."""

import random

import pytest
from pyspark.sql import functions as F

from namesieve.operators import sampling

SCHEMA = "entity_id long, entity_type string, country_code string, name_variant string, variant_rule string"


def some_variants(entities=150):
    rng = random.Random(7)
    rows = []
    for e in [*range(entities), None, 3]:
        kind, country = rng.choice(["MORAL", "FISICA"]), rng.choice(["MX", None])
        rows += [(e, kind, country, f"name {e} {i} {country}", f"rule {i}") for i in range(rng.randint(1, 3))]
    return [*rows, (entities, "MORAL", "MX", "", "rule 0")]


@pytest.mark.parametrize("listed", [sampling.LISTED_IDS, 1])
def test_validation_pairs_make_each_variant_once_or_twice(spark, monkeypatch, listed):
    monkeypatch.setattr(sampling, "LISTED_IDS", listed)
    rows = some_variants()
    made = spark.sparkContext.accumulator(0)

    def spell(text):
        made.add(1)
        return text

    plain = spark.createDataFrame(rows, SCHEMA)
    pairs = sampling.validation_pairs(plain.withColumn("name_variant", F.udf(spell)("name_variant"))).collect()
    # Once to count the usable ones of each entity, and for the drawn entities (all, if they are not listed) once more.
    assert made.value <= len(rows) * (1.8 if listed > 1 else 2.2)
    assert sorted(r["position"] for r in pairs) == list(range(1, 41))
    assert sorted(r["same_entity"] for r in pairs) == [0] * 20 + [1] * 20
    held = {(r[0], r[3]) for r in rows}
    for r in pairs:
        assert {(r["entity_id_a"], r["variant_a"]), (r["entity_id_b"], r["variant_b"])} <= held
        assert (r["entity_id_a"] == r["entity_id_b"]) == (r["same_entity"] == 1) and r["variant_a"] != r["variant_b"]
