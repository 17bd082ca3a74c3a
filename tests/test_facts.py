import json

import pytest

from namesieve.operators import facts
from namesieve.operators.catalog import entity_catalog
from namesieve.operators.risk import priority_from_json
from namesieve.sources import tables


@pytest.mark.parametrize(
    "text, weight",
    [
        ("[]", 0.0), ("nonsense", 0.0), ('{"priority": "high"}', 0.0), ('[1, {"priority": "high"}]', 0.0), (None, 0.0),
        ('[{"priority": null}, {"priority": "high"}]', 0.0), ('[{"x": 1}, {"priority": "low"}]', 0.4), ('[{"priority": 3}]', 0.0),
        ('[{"priority": "HIGH"}]', 1.5), ('[{"priority": "medium"}, {"priority": "low"}]', 1.0), ("[{'priority': 'high'}]", 0.0),
        ('[{"priority": "high"}] tail', 0.0),
    ],
)
def test_priority(spark, text, weight):
    df = spark.createDataFrame([(text,)], "review_queue_json string")
    assert priority_from_json(df).first()["priority_score_raw"] == weight


def test_evidence_rules(spark):
    rows = [
        (1, 0.9, "True"), (1, float("nan"), "true"), (1, None, "1"), (1, 0.3, "False"),
        (2, 0.5, "1.0"), (None, 0.99, "True"),
    ]
    df = spark.createDataFrame(rows, "entity_id int, identity_score double, review_required string")
    got = {r["entity_id"]: r for r in facts.evidence_facts(df).collect()}
    assert set(got) == {1, 2}
    assert (got[1]["max_identity_score"], got[1]["evidence_items"], got[1]["review_items"]) == (0.9, 4, 3)
    assert (got[2]["review_items"], got[2]["max_identity_score"]) == (0, 0.5)
    queue = {r["entity_id"]: r["review_queue_json"] for r in facts.review_queue_json(df).collect()}
    assert [i["priority"] for i in json.loads(queue[1])] == ["high", "medium", "medium"]
    assert queue[2] == "[]"


def test_catalog_from_literals(spark):
    literals = [
        "[{'entity_id': 'A', 'query_value': 'Caf\\xe9 Uno', 'metadata': {'country_code': 'NA', 'entity_type': 'PM'}}]",
        "[{'entity_id': 'A', 'query_value': 'Later', 'metadata': {'country_code': 'MX', 'entity_type': 'PF'}}]",
        "[{'entity_id': 'B', 'query_value': \"O'Neil\", 'metadata': {'country_code': None, 'entity_type': 'PF'}}, {'entity_id': 'C'}]",
        "[{'entity_id': 'D', 'query_value': 'No meta'}]",
        "[{'entity_id': 'E', 'query_value': '', 'metadata': {}}]",
        "[{'entity_id': 'F', 'query_value': 'Bad meta', 'metadata': None}]",
        "{'entity_id': 'G', 'query_value': 'Not a list', 'metadata': {}}",
        "[{'entity_id': 'H', 'query_value': 'Foo, None, True Inc', 'parts': (1, 'x,',), 'metadata': {'country_code':None,'entity_type': 'PM', 'tags': ()}}]",
        repr([{"entity_id": "I", "query_value": 'He said "(None)", O\'Neil \\x41', "metadata": {}}]),
        "[]", "broken [", None,
    ]
    df = spark.createDataFrame(list(enumerate(literals)), "position int, query_used string")
    got = {r["entity_id"]: (r["entity_name"], r["entity_type"], r["country_code"]) for r in entity_catalog(df, order="position").collect()}
    assert got == {
        "A": ("Café Uno", "MORAL", "NA"),
        "B": ("O'Neil", "FISICA", None),
        "D": ("No meta", "", ""),
        "H": ("Foo, None, True Inc", "MORAL", None),
        "I": ('He said "(None)", O\'Neil \\x41', "", ""),
    }


def test_first_in_the_order_of_files_wins(spark, tmp_path):
    """The later file is larger, so its partition comes first."""
    line = lambda name, pad: '1,1,"[{{\'entity_id\': \'A\', \'query_value\': \'{}\', \'metadata\': {{}}}}]"{}'.format(name, pad)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part-0.csv").write_text("entity_id,evidence_count,query_used\n" + line("FIRST", "\n"))
    (tmp_path / "in" / "part-1.csv").write_text("entity_id,evidence_count,query_used\n" + line("SECOND", "\n") + "2,0,\n" * 20_000)
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        sources = tables.read_csv(spark, str(tmp_path / "in"), tables.SOURCE_RESULTS, position="place")
        assert sources.rdd.getNumPartitions() > 2
        assert [r["entity_name"] for r in entity_catalog(sources, "place").collect()] == ["FIRST"]
        sources.drop("place").repartition(3).write.parquet(f"{tmp_path}/same.parquet")
        assert tables.read_input(spark, f"{tmp_path}/same.parquet", tables.SOURCE_RESULTS, position="place").count() == sources.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_missing_columns_are_named(spark):
    with pytest.raises(KeyError, match="name_variant"):
        tables.require_columns(spark.range(1).withColumnRenamed("id", "entity_id"), ["entity_id", "name_variant"])


def test_csv_keeps_odd_text(spark):
    rows = [(1, 'say "hi", you\nthere', None), (2, "plain", 0.5)]
    df = spark.createDataFrame(rows, "id int, t string, x double")
    assert sorted(map(tuple, tables.csv_roundtrip(df, "odd").collect())) == rows
