import zlib

import numpy as np
import pyarrow as pa
import pytest

from namesieve.llm import language
from namesieve.llm.texts import chunks


def test_grams_equal_brute_force():
    texts = ["Ab cd", "", "é x", "  ", "abcdefgh"]
    for chunk in chunks(pa.array(texts)):
        got = [[] for _ in texts]
        for (bucket, ok), size in zip(language.grams(chunk), language.SIZES):
            for at in np.flatnonzero(ok):
                piece = language._FOLD[chunk.data[at : at + size]].tobytes()
                row = int(np.searchsorted(chunk.offsets, at, side="right")) - 1
                got[row].append(piece)
        for text, found in zip(texts, got):
            folded = language._FOLD[np.frombuffer(text.encode(), dtype=np.uint8)].tobytes() if text else b""
            want = [folded[i : i + n] for n in language.SIZES for i in range(len(folded) - n + 1) if b" " not in folded[i + 1 : i + n - 1] and folded[i : i + n].strip()]
            assert sorted(found) == sorted(want)


def test_mean_logits_are_means_over_grams():
    rng = np.random.default_rng(0)
    model = language.LanguageModel(["a", "b"], rng.normal(size=(language.BUCKETS, 2)).astype(np.float32), np.array([0.1, 0.0], dtype=np.float32), 1.0, 0.0)
    texts = ["hello world", "", "zz"]
    for chunk in chunks(pa.array(texts)):
        raw, seen = language.mean_logits(chunk, model)
        for row, text in enumerate(texts):
            (own,) = chunks(pa.array([text]))
            found = [bucket[ok] for bucket, ok in language.grams(own)]
            found = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
            mean = model.logits[found].mean(axis=0) if len(found) else 0
            assert seen[row] == len(found) and raw[row] == pytest.approx(mean + model.bias, rel=1e-5)


def test_held_out_accuracy(spark, folder):
    rows = {r["doc_id"]: r for r in language.op10_language_id(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    right = []
    for d in docs:
        r = rows[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        if r["held_out"]:
            right.append(r["lang_pred"] == d["lang"])
    assert np.mean(right) > 0.9
    assert np.mean([r["rejected"] for r in rows.values()]) < 0.01


def test_held_out_labels_are_not_learned(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit_languages(docs.limit(60))
    again = language.fit_languages(docs.limit(60))
    assert np.array_equal(model.logits, again.logits) and model.heat == again.heat


def test_odd_rows_and_empty_table(spark, odd_docs, folder):
    model = language.fit_languages(spark.read.parquet(f"{folder}/documents.parquet"))
    found = language.identify(odd_docs, model).collect()
    assert len(found) == odd_docs.count()
    for r in found:
        if r["doc_id"] in (2, 3, 4, 7):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in model.languages
    assert language.identify(odd_docs.limit(0), model).count() == 0
    assert language.fit_languages(odd_docs.limit(0)) is None
    assert {r["lang_pred"] for r in language.identify(odd_docs, None).collect()} == {"und"}
    kept = language.language_stage(spark, odd_docs, "")
    assert kept.columns == odd_docs.columns and kept.where("doc_id IN (2, 3, 4, 7)").count() == 0


def test_stage_passes_an_unlabelled_corpus_on(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "123", None), (3, None, None)], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in language.language_stage(spark, docs, "").collect()] == [(1, "some words", "und")]
