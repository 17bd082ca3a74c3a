import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from namesieve.llm import alignment

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def sides():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    names = {i: t for t, i in a.get_vocab().items()}
    a_bytes = lambda i: bytes(byte[c] for c in names[i])
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return a, b, a_bytes, b_bytes


def brute(rows):
    a, b, a_bytes, b_bytes = sides()
    out, counts = [], Counter()
    for doc, text in rows:
        x = y = []
        if text:
            x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            whole = (" " + text).encode()
            if b"".join(map(a_bytes, x)) != whole or b"".join(map(b_bytes, y)) != whole:
                x = y = []
        ends = [dict(zip(np.cumsum([len(f(i)) for i in ids]).tolist(), range(len(ids)))) for ids, f in ((x, a_bytes), (y, b_bytes))]
        shared = sorted(set(ends[0]) & set(ends[1]))
        links = [(y[ends[1][e]], x[ends[0][e]]) for e in shared]
        counts.update(links)
        i, j, groups = 0, 0, []
        for e in shared:
            groups.append(",".join(map(str, x[i : ends[0][e] + 1])) + "|" + ",".join(map(str, y[j : ends[1][e] + 1])))
            i, j = ends[0][e] + 1, ends[1][e] + 1
        out.append((doc, len(x), len(y), len(links), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if x else ""))
    most = {}
    for (second, _), n in counts.items():
        most[second] = max(most.get(second, 0), n)
    return sorted(((d, n, m, k, k, sum(counts[p] == most[p[0]] for p in ps), sum(counts[p] for p in ps), h) for d, n, m, k, ps, h in out), key=repr)


def odd_texts(n, seed):
    rng = random.Random(seed)
    alphabet = [*" \n\t 　\u0085abcXYZ'1239.,!-éßłж語漢🙂\u0001\x7f́▁", "  ", " the", " <|endoftext|>", "</s>", "<0x41>", "'s", "\r\n", " ' ", " ре"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("block, fan", [(1 << 23, 64), (3000, 2)])
def test_equals_brute_force(spark, block, fan):
    rows = [(k, x) for k, x in enumerate(odd_texts(900, 3))] + [(None, "a row"), (None, None), (5, "twice"), (5, "twice"), (6, "one two " * 4000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = alignment.aligned(docs, A, B, block_bytes=block, fan=fan).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_merge_equals_a_counter():
    rng = np.random.default_rng(1)
    total, runs = Counter(), []
    for _ in range(9):
        keys = np.unique(rng.integers(0, 300, rng.integers(1, 200)))
        sums = rng.integers(1, 9, len(keys))
        total.update(dict(zip(keys.tolist(), sums.tolist())))
        runs.append(iter([(keys[i : i + 7], sums[i : i + 7]) for i in range(0, len(keys), 7)]))
    pages = list(alignment.merged(runs))
    keys, sums = np.concatenate([p[0] for p in pages]), np.concatenate([p[1] for p in pages])
    assert (np.diff(keys) > 0).all() and dict(zip(keys.tolist(), sums.tolist())) == total


def test_odd_rows(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, alignment.aligned(odd_docs, A, B).collect()), key=repr) == brute(rows)
    assert alignment.aligned(odd_docs.limit(0), A, B).count() == 0
