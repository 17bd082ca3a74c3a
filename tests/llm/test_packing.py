import zlib
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from namesieve.llm import packing


def check(rows, longest):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= longest
    return len(by_sequence)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=20))
def test_plan_uses_every_piece_once_and_few_sequences(counts):
    patterns = packing.plan(counts, 40)
    used = {}
    for lengths, times in patterns:
        assert sum(lengths) <= 40 and times > 0
        for x in lengths:
            used[x] = used.get(x, 0) + times
    assert used == counts
    tokens, sequences = sum(k * n for k, n in counts.items()), sum(t for _, t in patterns)
    assert sequences >= -(-tokens // 40)
    # Never worse than twice the least, which any best fit keeps to.
    assert sequences <= 2 * -(-tokens // 40) + 1


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 6), max_size=12))
def test_no_exact_combination_is_left(counts):
    have = [counts.get(x, 0) for x in range(31)]
    patterns = packing.exact(have, 30)
    assert all(sum(used) == 30 and len(used) <= 4 and times > 0 for used, times in patterns)
    for x in range(1, 31):
        assert have[x] + sum(used.count(x) * times for used, times in patterns) == counts.get(x, 0)
    pieces = [x for x in range(1, 31) for _ in range(min(have[x], 4))]
    assert not any(sum(some) == 30 for k in (1, 2, 3, 4) for some in set(combinations(pieces, k)))


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 3), max_size=15), st.integers(1, 39))
def test_index_finds_what_a_search_finds(counts, total):
    have = [counts.get(x, 0) for x in range(41)]
    pieces = [x for x in range(1, 41) for _ in range(have[x])]

    def first(k):
        return max((tuple(sorted(some, reverse=True)) for some in set(combinations(pieces, k)) if sum(some) == total), default=None)

    sums = packing.Sums(have, 40)
    assert sums.triple(total) == first(3)
    assert sums.pair(total) == first(2)
    assert sums.complement(total) == (first(1) or first(2) or first(3))


def test_exact_complements_leave_no_gap():
    assert sum(t for _, t in packing.plan({700: 10, 324: 10}, 1024)) == 10
    assert sum(t for _, t in packing.plan({500: 4, 300: 4, 224: 4}, 1024)) == 4
    assert sum(t for _, t in packing.plan({600: 2, 200: 2, 124: 2, 100: 2}, 1024)) == 2


def test_cut_shortens_the_first_piece_only():
    assert packing.cut(5, 8) == [(0, 5)]
    assert packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def test_pieces_are_the_tokenizers_ids(spark, folder):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    theirs = Tokenizer.from_file(path)
    theirs.encode_special_tokens = True
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, "<|endoftext|> a  b\n\n\tc   x" * 3), (-2, None), (-3, "")], "doc_id bigint, text string")
    docs = docs.unionByName(extra)
    rows = packing.pack(docs, path, keep_ids=True).collect()
    check(rows, 1024)
    text = {d["doc_id"]: d["text"] or "" for d in docs.collect()}
    got = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == len(got.setdefault(r["doc_id"], [])) and len(r["ids"]) == r["length"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        got[r["doc_id"]].extend(r["ids"])
    assert got == {k: [*theirs.encode(t, add_special_tokens=False).ids, 2] for k, t in text.items()}
    tokens = sum(map(len, got.values()))
    assert len({r["sequence_id"] for r in rows}) <= 1.05 * -(-tokens // 1024) + 2


def test_queries_pack_the_ids_of_the_tokenizer_as_loaded(spark, tmp_path):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = dict(enumerate(["a <|endoftext|> b", "<|endoftext|>", " \n <|endoftext|><|endoftext|>  x<|endoftext", "no token"]))
    docs = spark.createDataFrame(list(text.items()), "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = {k: [*theirs.encode(t, add_special_tokens=False).ids, 2] for k, t in text.items()}
    assert want[0] == [64, 220, 50256, 275, 2]
    for rows in (packing.op6_best_fit_packing(spark, str(tmp_path)).collect(), packing.packing_stage(spark, docs, "").collect()):
        assert {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in rows} == {k: (len(v), zlib.crc32(np.array(v, dtype="<u4").tobytes())) for k, v in want.items()}


def test_hot_length_is_split(spark):
    pieces = spark.range(5000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 24L ELSE 1000L END AS length")
    rows = packing.assigned(pieces, group_rows=100).collect()
    assert len(rows) == 5000 and check(rows, 1024) == 3333


def test_odd_rows_and_empty_table(spark, odd_docs):
    rows = packing.pack(odd_docs).collect()
    check(rows, 1024)
    assert sum(r["doc_id"] == 1 for r in rows) == 2
    assert [r["length"] for r in rows if r["doc_id"] in (2, 3)] == [1, 1]
    assert packing.pack(odd_docs.limit(0)).count() == 0
