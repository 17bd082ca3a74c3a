import re
from collections import Counter

import numpy as np
import pytest

from namesieve.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_equal_brute_force(spark, folder, odd_docs):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    extra = [(-1, "a a a a a"), (-2, "x\nx\n x\nx \n\n\nx"), (-3, "a b c\x00 a b c\x00"), (-4, "l\r\nl\r\nl"), (-5, "é é é é é é")]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id bigint, text string")).unionByName(odd_docs.select("doc_id", "text"))
    text = docs.collect()
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality.weak_quality(docs).collect())
    assert got == Counter((d["doc_id"], *brute(d["text"])) for d in text)


def test_query_verdict(spark, folder):
    rows = quality.op9_weak_supervision(spark, folder).collect()
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [(labels[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in labels and not r["base_failed"]]
    good = [k for q, k in judged if q == 1]
    bad = [k for q, k in judged if q == 0]
    assert np.mean(good) > 0.97 and (not bad or np.mean(bad) < 0.2)


def test_votes_become_posteriors_as_bayes_says():
    patterns = np.array([[2, 1], [0, 1], [2, 0], [1, 1]])
    counts = np.array([900.0, 50.0, 5.0, 45.0])
    believed = np.array([[[0.03, 0.9], [0.005, 0.0]], [[0.4, 0.5], [0.3, 0.0]]])
    post, rates = quality.learn(patterns, counts, believed, rounds=1, prior=0.8)
    start = np.maximum(believed, 1e-3)
    by_hand = 0.8 * start[0, 0, 1] / (0.8 * start[0, 0, 1] + 0.2 * start[1, 0, 1])
    assert post[0] == pytest.approx(by_hand) and post[3] == pytest.approx(0.8)
    post, rates = quality.learn(patterns, counts, believed)
    assert post[0] > 0.5 > post[2] and post[0] > post[1]
    assert rates[0, 0, 1] > rates[1, 0, 1]


def test_mean_log_likelihood_does_not_fall():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.85
    votes = np.where(truth[:, None], rng.choice([0, 1, 2], (4000, 5), p=[0.02, 0.2, 0.78]), rng.choice([0, 1, 2], (4000, 5), p=[0.5, 0.3, 0.2]))
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    believed = np.array([[[0.03, 0.9]] * 5, [[0.4, 0.5]] * 5])
    post, _ = quality.learn(patterns, counts.astype(float), believed)
    assert ((post[which.ravel()] >= 0.5) == truth).mean() > 0.95


def test_odd_rows_and_empty_table(spark, odd_docs):
    rows = quality.weak_quality(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["quality"] <= 1 for r in rows)
    assert len({(r["n_words"], r["quality"]) for r in rows if r["doc_id"] == 1}) == 1
    assert quality.weak_quality(odd_docs.limit(0)).count() == 0
