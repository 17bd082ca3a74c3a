import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from namesieve.llm import spellings
from namesieve.llm.texts import chunks

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(docs, shortest=6, fewest=5):
    n = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= shortest and k >= fewest}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(vocab):
    near = {w: [v for v in vocab if one_edit(w, v)] for w in vocab}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= 5 * vocab[w] else None
    out = []
    for w in vocab:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, vocab[w], len(near[w]), vocab[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def corpus(seed, n=400):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randrange(5, 9))) for _ in range(120)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "bbbbbb" * 20, "bbbbbb" * 20 + "b"]
    docs = []
    for k in range(n):
        docs.append((k, " ".join(rng.choice([str.upper, str])(rng.choice(stems[: rng.randrange(1, len(stems))])) + rng.choice(["", ",", "1", "ß", "ł"]) for _ in range(60))))
    return docs + [(None, "nullish " * 7), (5, None), (6, ""), (7, "Ünïcödé " * 9), (7, "Ünïcödé " * 9)]


def test_runs_checksums_and_damage():
    texts = ["AbÀÿ-cdĀef ×÷", None, "", "x" * 500 + " " + "y" * 9, "z"]
    for chunk in chunks(pa.array(texts)):
        starts, ends, length = spellings.runs(chunk)
        found = [bytes(chunk.data[i:j]).decode() for i, j in zip(starts, ends)]
        assert found == [r for t in texts for r in RUN.findall(t or "")] and length.tolist() == [len(x) for x in found]
        sums = spellings.checksums(chunk.data, starts, ends, spellings.np.array([zlib.crc32(b"12:")] * len(starts), dtype="u4"))
        assert sums.tolist() == [zlib.crc32(f"12:{x}".encode()) for x in found]


def test_near_pairs_equal_a_double_loop():
    rng = random.Random(2)
    for _ in range(60):
        size = rng.randrange(1, 5)
        long = sorted({"".join(rng.choice("abc") for _ in range(size)) for _ in range(rng.randrange(1, 25))})
        short = sorted({w[: size - 1] if rng.random() < 0.5 else "".join(rng.choice("abc") for _ in range(size - 1)) for w in long})
        x, y = spellings.near_pairs(long, short, "")
        every = long + short
        got = Counter(tuple(sorted((every[i], every[j]))) for i, j in zip(x, y))
        assert got == Counter(tuple(sorted((a, b))) for k, a in enumerate(every) for b in every[k + 1 :] if one_edit(a, b) and size in (len(a), len(b)))


@pytest.mark.parametrize("crowd", [2, 40, 4096])
def test_equals_brute_force(spark, crowd):
    docs = corpus(4)
    got = spellings.variants(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), crowd=crowd).collect()
    assert sorted(map(tuple, got), key=repr) == brute(brute_words(docs))


def test_counts_are_handed_on_before_they_are_many(spark, monkeypatch):
    monkeypatch.setattr(spellings, "HELD", 20)
    docs = corpus(9, 50)
    got = {r["word"]: r["n"] for r in spellings.vocabulary(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == brute_words(docs)


def test_odd_rows(spark, odd_docs):
    assert spellings.variants(odd_docs.limit(0)).count() == 0
    got = spellings.variants(odd_docs, shortest=4, fewest=2)
    assert {"words", "short", "plain"} <= {r["word"] for r in got.collect()}
    very_long = spark.createDataFrame([(1, ("q" * 3000 + " ") * 5 + ("q" * 3001 + " ") * 30)], "doc_id bigint, text string")
    assert [(len(r["word"]), r["n_near"], r["form_n"]) for r in spellings.variants(very_long).orderBy("word").collect()] == [(3000, 1, 30), (3001, 1, None)]
