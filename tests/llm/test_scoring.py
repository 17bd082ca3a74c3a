import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from namesieve.llm import contexttree as ct
from namesieve.llm import scoring
from namesieve.llm.texts import chunks

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall((text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))), b"\n"]


class Brute:
    """Context-tree weighting as it is defined: one recursion over whole counts for each binary decision."""

    def __init__(self, train, depth):
        self.depth, self.counts, self.cache = depth, defaultdict(lambda: [0, 0]), {}
        self.children = defaultdict(set)
        for text in train:
            for context, byte in self.steps(text):
                for k in range(8):
                    prior, bit = (1 << k) | byte >> (8 - k), byte >> (7 - k) & 1
                    for d in range(depth + 1):
                        self.counts[context[:d], prior][bit] += 1
                        if d < depth:
                            self.children[context[:d], prior].add(context[: d + 1])

    def steps(self, text):
        line = b" " + b" ".join(tokens(text))
        for i in range(1, len(line)):
            yield line[max(0, i - self.depth) : i][::-1].ljust(self.depth, b"\0"), line[i]

    def kt(self, a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def log_p(self, context, prior):
        key = context, prior
        if key not in self.cache:
            own = self.kt(*self.counts[key])
            if len(context) < self.depth:
                below = sum(self.log_p(c, prior) for c in self.children[key])
                self.cache[key] = np.logaddexp(own, below) - math.log(2)
            else:
                self.cache[key] = own
        return self.cache[key]

    def one(self, context, prior, d=0):
        key = context[:d], prior
        a, b = self.counts[key]
        estimate = (b + 0.5) / (a + b + 1)
        if d == self.depth or context[: d + 1] not in self.children[key]:
            return estimate
        weight = math.exp(self.kt(a, b) - math.log(2) - self.log_p(*key))
        return weight * estimate + (1 - weight) * self.one(context, prior, d + 1)

    def score(self, text):
        total = 0.0
        for context, byte in self.steps(text):
            for k in range(8):
                p = self.one(context, (1 << k) | byte >> (8 - k))
                total += math.log(p if byte >> (7 - k) & 1 else 1 - p)
        return total / math.log(10)


def test_kt_is_the_sequential_estimate():
    p, a, b = 0.0, 0, 0
    for bit in [1, 0, 0, 1, 1, 1, 0, 1]:
        p += math.log(((b if bit else a) + 0.5) / (a + b + 1))
        a, b = a + (1 - bit), b + bit
    assert ct.log_kt(np.array([a]), np.array([b]))[0] == pytest.approx(p)
    big = np.array([3_000_000]), np.array([2_000_000])
    assert ct.log_kt(*big)[0] == pytest.approx(math.lgamma(3e6 + 0.5) + math.lgamma(2e6 + 0.5) - math.lgamma(5e6 + 1) - math.log(math.pi))


def test_probabilities_of_all_next_bytes_sum_to_one():
    gram = np.unique(np.random.default_rng(0).integers(0, 1 << 16, 500).astype(np.uint64))
    tree = ct.levels(gram, np.ones(len(gram)), 1, 0)
    every = np.uint64(7 << 8) | np.arange(256, dtype=np.uint64)
    z = np.zeros((8, 256))
    assert np.exp(ct.log_probability(every, tree, z, z + 1, z + 0.5)).sum() == pytest.approx(1)


def test_scores_equal_brute_force(spark):
    rows = [(1, "The cat sat. the CAT", False), (2, "the dog Sat", False), (3, "a cat and a catalogue", True), (4, None, True), (5, "été the", False), (6, "", False), (7, "zzz the", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean")
    train = Counter(t for _, text, held in rows if held is False for t in tokens(text))
    model = Brute([text for _, text, held in rows if held is False], scoring.DEPTH)
    total, distinct = sum(train.values()), len(train)
    found = {r["doc_id"]: r for r in scoring.ctw_scores(docs).collect()}
    for doc_id, text, held in rows:
        r, own = found[doc_id], tokens(text)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held is not False, len(own), total)
        assert r["n_known"] == sum(train[t] > 0 for t in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((train[t] + 1) / (total + distinct + 1)) for t in own))
        assert r["score"] == pytest.approx(model.score(text))
        assert r["bits_per_byte"] == pytest.approx(-r["score"] / math.log10(2) / sum(len(t) + (t != b"\n") for t in own))


def test_pieces_and_blocks_do_not_change_scores(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", (F.col("doc_id") % 3 == 0).alias("held_out"))
    whole = {r["doc_id"]: r for r in scoring.ctw_scores(docs).collect()}
    monkeypatch.setattr(scoring, "BUCKET_GRAMS", 300)
    monkeypatch.setattr(scoring, "BUCKET_BYTES", 1 << 12)
    cut = scoring.ctw_scores(docs.repartition(5), piece_bytes=20_000, part_bytes=2_000).collect()
    assert len(cut) == len(whole)
    for r in cut:
        assert r["score"] == pytest.approx(whole[r["doc_id"]]["score"])
        assert r["base_score"] == pytest.approx(whole[r["doc_id"]]["base_score"])


def test_held_out_text_is_better_coded_than_noise(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).alias("held_out"))
    noise = spark.createDataFrame([(-1, "qzx vvk wqj xkcd zzq jjw qqv kxz", True)], "doc_id bigint, text string, held_out boolean")
    found = scoring.ctw_scores(docs.unionByName(noise)).where("held_out").collect()
    bits = {r["doc_id"]: r["bits_per_byte"] for r in found}
    own = sorted(v for k, v in bits.items() if k >= 0)
    assert own[len(own) // 2] < 3 < bits[-1]


def test_order_of_words_matters_and_context_beats_single_tokens(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).alias("held_out"))
    mixed_up = docs.where("held_out").select((-F.col("doc_id") - 1).alias("doc_id"), F.array_join(F.shuffle(F.split("text", " "), 1), " ").alias("text"), "held_out")
    found = {r["doc_id"]: r for r in scoring.ctw_scores(docs.unionByName(mixed_up)).where("held_out").collect()}
    own = [k for k in found if k >= 0 and found[k]["n_tokens"] > 20]
    assert sum(found[k]["score"] for k in own) > sum(found[-k - 1]["score"] for k in own)
    assert all(found[k]["base_score"] == pytest.approx(found[-k - 1]["base_score"]) for k in own)


def test_grams_hold_the_bytes_before():
    texts = [b"ab c", b"", b"\xc3\xa9 zz\x00zzzzzzzz"]
    column = [x.decode() for x in texts]
    (chunk,) = chunks(pa.array(column))
    _, _, _, _, line, lengths = scoring._parsed(chunk, chunk.data)
    want = [int.from_bytes(context + bytes([byte]), "big") for x in column for context, byte in Brute([], 6).steps(x)]
    assert np.concatenate(list(scoring.grams_of(line, lengths))).tolist() == want
    assert lengths.tolist() == [6, 1, 16]


def test_odd_rows_and_empty_table(spark, odd_docs):
    docs = odd_docs.withColumn("held_out", F.lit(False))
    found = scoring.ctw_scores(docs).collect()
    assert len(found) == odd_docs.count()
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert {r["n_tokens"] for r in found if r["doc_id"] in (2, 3, 4)} == {1}
    assert scoring.ctw_scores(docs.limit(0)).count() == 0
    untrained = scoring.ctw_scores(docs.limit(3).withColumn("held_out", F.lit(True))).collect()
    assert len(untrained) == 3 and all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in untrained)


def test_query_agrees_with_recomputed_base(spark, folder):
    found = {r["doc_id"]: r for r in scoring.op1_context_tree(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2 for d in docs}
    train = Counter(t for d in docs if not held[d["doc_id"]] for t in tokens(d["text"]))
    total, distinct = sum(train.values()), len(train)
    assert len(found) == len(docs)
    for d in docs:
        r = found[d["doc_id"]]
        assert r["held_out"] == held[d["doc_id"]] and r["n_known"] == sum(train[t] > 0 for t in tokens(d["text"]))
        assert r["base_score"] == pytest.approx(sum(math.log10((train[t] + 1) / (total + distinct + 1)) for t in tokens(d["text"])))


@pytest.mark.parametrize("symbols", [3, 40, 256])
def test_values_of_grams_by_ranks_and_by_places(symbols):
    rng = np.random.default_rng(symbols)
    data = rng.integers(0, symbols, 30_000).astype(np.uint8)
    offsets = np.sort(np.r_[0, rng.integers(0, len(data), 50), len(data)])
    _, _, _, _, line, lengths = scoring._parsed(scoring.Chunk(0, data, offsets), data)
    (_, pair_bits), (_, byte_bits) = ranks = scoring._ranks(line)
    gram = scoring._distinct(*[scoring._distinct(g) for g in scoring.grams_of(line, lengths)])
    log_p = rng.random(len(gram)).astype(np.float32)
    for some in scoring.grams_of(line, lengths):
        assert (3 * pair_bits + byte_bits + len(some).bit_length() > 64) == (symbols == 256)
        assert (scoring.values_of(some, gram, log_p, ranks) == log_p[np.searchsorted(gram, some)]).all()
        assert len(scoring.values_of(some[:0], gram, log_p, ranks)) == 0
