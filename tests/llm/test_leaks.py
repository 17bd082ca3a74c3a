import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from namesieve.llm import leaks
from tests.llm.conftest import words

SOLID = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return SOLID.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = split(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            wins.setdefault((size, tuple(w[i : i + size])), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for size in {s for s, _ in wins}:
            for i in range(len(w) - size + 1):
                if (size, tuple(w[i : i + size])) in wins:
                    hit |= set(range(i, i + size))
                    found |= wins[size, tuple(w[i : i + size])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def found(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted(map(tuple, leaks.contaminated(docs, items).drop("items").collect()), key=repr)


def test_winnowed_keeps_a_shared_minimum():
    rng = np.random.default_rng(1)
    for span in (1, 2, 6):
        keys = rng.integers(0, 50, 300).astype(np.uint64)
        kept = leaks.winnowed(keys, span)
        wanted = {i + int(k) for i in range(len(keys) - span + 1) for k in np.flatnonzero(keys[i : i + span] == keys[i : i + span].min())}
        assert set(np.flatnonzero(kept).tolist()) == wanted
    assert not leaks.winnowed(np.zeros(3, dtype=np.uint64), 4).any()


def test_equals_brute_force(spark):
    rng = random.Random(5)
    base = [words(k, rng.randrange(0, 60), 40) for k in range(30)]
    items = [(k, x) for k, x in enumerate(base)] + [(100 + n, words(200 + n, n, 30)) for n in range(1, 12)] + [(3, base[3]), (None, words(7, 25, 900)), (50, None), (51, "!!")]
    docs = []
    for k in range(150):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            w = rng.choice(base).split()
            i = rng.randrange(0, max(1, len(w) - 8))
            parts += [" ".join(w[i : i + rng.randrange(5, 30)]).upper(), words(rng.randrange(10**6), rng.randrange(0, 20), 40)]
        docs.append((k, ", ".join(parts)))
    docs += [(1, docs[1][1]), (None, base[2]), (None, None), (7, ""), (8, words(7, 25, 900))]
    assert found(spark, docs, items) == brute(docs, items)


def test_hot_fingerprint_meets_in_parts(spark, monkeypatch):
    monkeypatch.setattr(leaks, "HOT_SHARE", 1e-9)
    passage = words(1, 30, 500)
    docs = [(k, f"{words(k, 15, 300)} {passage if k % 3 == 0 else ''}") for k in range(4500)]
    got = found(spark, docs, [(1, passage), (2, passage), (3, words(9, 12, 77))])
    assert got == brute(docs, [(1, passage), (2, passage), (3, words(9, 12, 77))])


def test_odd_rows(spark, odd_docs):
    items = spark.createDataFrame([(1, "plain words of a short TEXT", "x"), (2, None, "y")], "item_id bigint, text string, doc_id string")
    got = leaks.contaminated(odd_docs, items)
    assert got.count() == odd_docs.count()
    assert {(r["doc_id"], r["n_hit"], tuple(r["items"])) for r in got.where("contaminated").collect()} == {(1, 6, ("1",))}
    assert leaks.contaminated(odd_docs.limit(0), items).count() == 0
    assert leaks.contaminated(odd_docs, items.limit(0)).where("contaminated").count() == 0


@pytest.mark.parametrize("size", [1, 3, 9, 10])
def test_schemes_cover_their_length(size):
    grams, span = leaks.scheme(size)
    assert grams + span - 1 == size and grams >= 1 and span >= 1


def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    cols = "doc_id, n_words, n_hit, n_items, items_sha256, contaminated"
    theirs = con.execute(f"SELECT {cols} FROM ({leaks.OP13_SQL}) ORDER BY doc_id").fetchall()
    assert [tuple(r) for r in leaks.op13_winnowing(spark, folder).select(*cols.split(", ")).orderBy("doc_id").collect()] == theirs
