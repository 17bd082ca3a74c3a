"""What queries leave on disk on the way: packed grams instead of texts and vectors, no shuffles of ended steps."""

import random
import time
from collections import Counter

import numpy as np
import pytest

from namesieve.functions import grams
from namesieve.operators import blocking, similarity, tfidf
from namesieve.plans import storage

SCHEMA = "entity_id long, entity_type string, country_code string, name_variant string, variant_rule string"


def wordy_variants(entities=60, seed=4):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé日", k=rng.randint(1, 6))) for _ in range(60)]
    rows = []
    for e in range(entities):
        base = rng.choices(words, k=rng.choice([1, 2, 3, 40]))
        rows += [(e, "MORAL", "MX", " ".join(base), "base_canonical"), (e, "MORAL", "MX", " ".join(reversed(base)), "reverse_order")]
    return list({(r[0], r[3]): r for r in rows}.values())


def test_packed_grams_are_those_of_the_texts():
    rng = random.Random(1)
    for alphabet in ("abc", "abé日\U0001f600"):
        words = [["".join(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(rng.choice([0, 1, 2, 300]))] for _ in range(50)]
        padded = ["".join(f" {w} " for w in ws) for ws in words]
        rows, codes, counts = grams.gram_counts(padded)
        packed = grams.pack_grams(rows, codes, counts, len(padded))
        assert sum(map(len, packed)) < 4 * len(codes)
        for got, want in zip(grams.unpack_grams(packed), (codes, counts, rows)):
            assert np.array_equal(got, want)
    assert [len(x) for x in grams.unpack_grams(grams.pack_grams(*(np.zeros(0, dtype=np.int64),) * 3, 2))] == [0, 0, 0]


@pytest.mark.parametrize("held", [1 << 20, 0])
def test_counts_write_neither_texts_nor_vectors(spark, monkeypatch, held):
    monkeypatch.setattr(tfidf, "HELD_GRAMS", held)
    names = []
    for module in (similarity, tfidf, blocking):
        monkeypatch.setattr(module, "written", lambda df, name: names.append((name, dict(df.dtypes))) or storage.written(df, name))
    rows = wordy_variants()
    counts = {r["cosine_similarity"]: r["pairs"] for r in similarity.similarity_table(spark.createDataFrame(rows, SCHEMA)).counts.collect()}
    assert not {"variants", "texts", "gram-counts", "located-vectors"} & {name for name, _ in names}
    assert not any({"name_variant", "variant"} & set(kinds) for _, kinds in names)
    expected = Counter()
    vocabulary = tfidf.vocabulary(spark.createDataFrame(rows, SCHEMA))
    vectors = {r["variant"]: dict(zip(r["codes"], r["weights"])) for r in vocabulary.join(tfidf.packed_vectors(vocabulary, 1 << 20), "text_key").collect()}
    for a in rows:
        for b in rows:
            one, other = (x[3].replace(" ", "") for x in (a, b))
            near = abs(len(a[3].split()) - len(b[3].split())) <= 1 and abs(len(one) - len(other)) <= 8
            if a[0] < b[0] and one[:2] == other[:2] and near:
                expected[round(sum(w * vectors[b[3]].get(c, 0) for c, w in vectors[a[3]].items()), 5)] += 1
    rounded = Counter()
    for score, pairs in counts.items():
        rounded[round(score, 5)] += pairs
    assert sum(rounded.values()) == sum(expected.values())
    assert sum(k * v for k, v in rounded.items()) == pytest.approx(sum(k * v for k, v in expected.items()), abs=1e-4 * sum(expected.values()))


def test_long_texts_of_a_hot_block_are_copied_little(spark, monkeypatch):
    monkeypatch.setattr(similarity, "VECTOR_TILE_ROWS", 200)
    rows = [(i, "MORAL", "MX", "ab " + "cd" * (3 * i + 1), "base_canonical") for i in range(900)]
    placed = similarity.similarity_table(spark.createDataFrame(rows, SCHEMA)).placed
    assert placed.count() and placed.selectExpr("sum(size(_others)) AS n").first()["n"] < 1.5 * placed.count()


def test_a_written_table_drops_its_shuffles(spark):
    before = spark.conf.get(storage.CLEANUP)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {n for n in disk.getAllBlocks().mkString(" ").split() if n.startswith("shuffle_")}

    left = shuffles()
    out = storage.written(spark.range(1000).repartition(3, "id").groupBy("id").count(), "counts")
    for _ in range(50):  # they are dropped in the background
        if not (more := shuffles() - left):
            break
        time.sleep(0.1)
    assert not more
    assert out.count() == 1000 and spark.conf.get(storage.CLEANUP) == before


def test_an_index_keeps_counts_and_norms_instead_of_weights(spark, monkeypatch):
    texts = tfidf.vocabulary(spark.createDataFrame([(r[3],) for r in wordy_variants()] + [(" ",)], "name_variant string"))
    weights = {(r["text_key"], c): w for r in tfidf.packed_vectors(texts).collect() for c, w in zip(r["codes"], r["weights"])}
    monkeypatch.setattr(grams, "RUN_GRAMS", 50)
    for held in (1 << 20, 0):
        index = tfidf.gram_index(texts, held)
        assert not any("double" in kind for df in (index.counts, index.frequencies, index.postings) for _, kind in df.dtypes)
        norms = {r["text_key"]: r["norm"] for r in index.norms.collect()}
        df = {r["code"]: r["df"] for r in index.frequencies.collect()}
        got = {(r["text_key"], r["code"]): r["tf"] * (np.log((1 + index.total) / (1 + df[r["code"]])) + 1) / norms[r["text_key"]] for r in index.postings.collect()}
        assert got.keys() == weights.keys() and all(got[k] == pytest.approx(weights[k], rel=1e-12) for k in got)
        assert len(norms) == texts.count()


def test_only_texts_that_are_named_are_shuffled(spark, monkeypatch):
    tables = {}
    monkeypatch.setattr(similarity, "written", lambda df, name: tables.setdefault(name, storage.written(df, name)))
    rows = wordy_variants() + [(900 + i, "MORAL", "MX", f"{chr(97 + i)}{'xyzw'[i % 4] * (40 + 20 * i)}", "base_canonical") for i in range(20)]
    for bits in (1 << 24, 64):  # of few places, most are taken
        monkeypatch.setattr(blocking, "HASHED_BITS", bits)
        tables.clear()
        found = similarity.top_matches(similarity.similarity_table(spark.createDataFrame(rows, SCHEMA))).collect()
        named = {t for r in found for t in (r["variant_a"], r["variant_b"])}
        assert {r["variant"] for r in tables["texts"].collect()} == named and len(named) < len({r[3] for r in rows})


@pytest.mark.parametrize("bits", [1 << 24, 64])
def test_candidates_shuffle_only_texts_that_are_near_another(spark, monkeypatch, bits):
    monkeypatch.setattr(blocking, "HASHED_BITS", bits)
    sent = []
    whole = blocking.place_tiles
    monkeypatch.setattr(blocking, "place_tiles", lambda placed, *rest: sent.append(placed) or whole(placed, *rest))
    rows = [(i, "MORAL", None, "ab " + "c" * (20 * i), "base_canonical") for i in range(200)] + [(900 + i, "MORAL", None, f"ab {i}", "base_canonical") for i in range(9)]
    pairs = blocking.candidate_pairs(spark.createDataFrame(rows, SCHEMA), unique=True)
    got = {(r["entity_id_a"], r["entity_id_b"]) for r in pairs.collect()}
    near = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and abs(len(a[3].split()) - len(b[3].split())) <= 2 and abs(len(a[3].replace(" ", "")) - len(b[3].replace(" ", ""))) <= 15}
    assert got == near
    assert bits == 64 or sent[0].count() < 20
