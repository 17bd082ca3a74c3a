import random

import numpy as np
import pytest

from namesieve.llm import topics


def corpus(seed=5, n=400, copies=200):
    """Texts of four vocabularies that share half of their words, and many copies of one of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        pool = [f"common{rng.randrange(30)}" for _ in range(60)] + [f"{'abcd'[i % 4]}{rng.randrange(40)}" for _ in range(60)]
        rng.shuffle(pool)
        rows.append((i, " ".join(pool), i % 4))
    return rows + [(n + i, rows[0][1], 0) for i in range(copies)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id bigint, text string, subject int").withColumn("profile", topics.profile("text")).cache()


def test_profiles_equal_a_loop_over_words(docs):
    for r in docs.limit(5).collect():
        counts = np.zeros(topics.SLOTS)
        for w in r["text"].upper().lower().split():
            b = np.frombuffer(w.encode(), dtype=np.uint8)
            h = int(topics.segment_hashes(b, np.array([0]), np.array([len(b)]))[0])
            counts[h % topics.SLOTS] += 1 if h >> 63 else -1
        root = np.sign(counts) * np.sqrt(np.abs(counts))
        assert np.frombuffer(r["profile"], dtype=np.int8).tolist() == np.rint(127 * root / np.linalg.norm(root)).tolist()


def test_subjects_become_topics(docs):
    model = topics.learn(docs, topics=4)
    rows = docs.withColumn("topic", model.name(docs["profile"])).groupBy("topic", "subject").count().collect()
    pure = sum(max(r["count"] for r in rows if r["topic"] == t) for t in {r["topic"] for r in rows})
    assert len({r["topic"] for r in rows}) == 4 and pure >= 0.97 * docs.count()


def test_learning_equals_a_plain_loop_in_any_order(docs):
    model = topics.learn(docs, topics=6, rounds=5)
    other = topics.learn(docs.repartition(17), topics=6, rounds=5)
    assert np.array_equal(model.centres, other.centres) and np.array_equal(model.mean, other.mean)
    x = np.array([np.frombuffer(r["profile"], dtype=np.int8) for r in docs.collect()]) / 127
    y = x - x.mean(axis=0)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    centres = topics.learn(docs, topics=6, rounds=0).centres
    for _ in range(5):
        at = (y @ centres.T).argmax(axis=1)
        centres = np.array([y[at == k].sum(axis=0) / np.linalg.norm(y[at == k].sum(axis=0)) for k in range(len(centres))])
    assert np.allclose(model.centres, centres, atol=1e-6)


def test_odd_rows_and_empty_table(spark, odd_docs):
    rows = odd_docs.select("doc_id", "text").withColumn("profile", topics.profile("text"))
    model = topics.learn(rows)
    named = rows.withColumn("topic", model.name(rows["profile"])).collect()
    assert {r["doc_id"] for r in named if r["topic"] == topics.NO_TOPIC} == {1, 2, 3, 4, 6, 7, 8, None}
    assert [r["topic"] for r in named if r["doc_id"] == 5] == ["topic_00"]
    empty = topics.learn(rows.limit(0))
    assert len(empty.centres) == 0
    assert {r["topic"] for r in rows.select(empty.name(rows["profile"]).alias("topic")).collect()} == {topics.NO_TOPIC}
