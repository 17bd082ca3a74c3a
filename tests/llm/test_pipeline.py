"""Every stage on what its predecessor kept, and the whole run."""

import pytest

import corpus_pipeline
from namesieve.llm import neardups, privacy
from test_privacy import spans


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, folder).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "private_data", "mixing", "packing"]
    for name in ("language", "near_duplicates", "private_data", "mixing"):
        assert stages[name].dtypes == stages["documents"].dtypes


def test_language_keeps_what_has_one(stages):
    kept, all_rows = stages["language"].count(), stages["documents"].count()
    assert kept >= 0.99 * all_rows
    assert stages["language"].where("lang = 'und' OR lang IS NULL").count() == 0


def test_one_of_each_class_stays(stages):
    found = neardups.near_duplicates(stages["language"])
    classes = {r["class_id"] for r in found.collect()}
    assert sorted(r["doc_id"] for r in stages["near_duplicates"].collect()) == sorted(classes)


def test_no_personal_data_is_left(stages):
    before = {r["doc_id"]: r["text"] for r in stages["near_duplicates"].collect()}
    after = {r["doc_id"]: r for r in stages["private_data"].collect()}
    assert set(before) == set(after)
    for i, text in before.items():
        assert after[i]["n_chars"] == len(after[i]["text"])
        if spans(text):
            assert not spans(after[i]["text"]) and any(t in after[i]["text"] for t in privacy.TAGS.values())


def test_mixing_draws_a_share(stages):
    before = {r["doc_id"]: r["text"] for r in stages["private_data"].collect()}
    after = {r["doc_id"]: r["text"] for r in stages["mixing"].collect()}
    assert after.items() <= before.items()
    words = lambda t: sum(len(x.split()) for x in t.values())
    assert 0.35 * words(before) < words(after) < 0.85 * words(before)


def test_packing_places_all_tokens(stages, spark, folder):
    rows = stages["packing"].collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in stages["mixing"].collect()}
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 1024


def test_run_equals_the_stages(stages, spark, folder):
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, corpus_pipeline.run(spark, folder).collect())) == sorted(map(key, stages["packing"].collect()))
