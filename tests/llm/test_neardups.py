import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import words
from namesieve.llm import neardups
from namesieve.llm.texts import chunks


def bag(text):
    own = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
    if len(own) < 5:
        return Counter([tuple(own)] if own else [])
    return Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def similarity(a, b):
    every = set(a) | set(b)
    return sum(1 / sum(max(a[i] / a[x], b[i] / b[x]) for i in every) for x in set(a) & set(b))


def classes(rows, least=0.8):
    """Smallest id by component of all pairs that share a shingle."""
    bags = {i: bag(t) for i, t in rows}
    root = {i: i for i in bags}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(set)
    for i, b in bags.items():
        for x in b:
            holders[x].add(i)
    for i, b in bags.items():
        for j in {j for x in b for j in holders[x] if j > i}:
            if find(i) != find(j) and similarity(b, bags[j]) >= least:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in bags}


def edited(text, n, seed):
    rng, own = random.Random(seed), text.split()
    for _ in range(n):
        own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
    return " ".join(own)


def test_exact_similarity_equals_the_definition():
    rng = random.Random(3)
    for _ in range(50):
        a, b = (Counter({k: rng.randrange(1, 6) for k in rng.sample(range(30), rng.randrange(1, 20))}) for _ in range(2))
        pack = lambda c: (np.array(sorted(c), dtype=np.uint32), np.array([c[k] for k in sorted(c)]))
        assert neardups.probability_jaccard(*pack(a), *pack(b)) == pytest.approx(similarity(a, b))


def test_registers_collide_with_the_similarity():
    base = words(1, 300, 10_000)
    texts = [base, edited(base, 6, 1), edited(base, 25, 2), base + " " + words(9, 60, 3) + " ", words(4, 7), ""]
    (chunk,) = chunks(pa.array(texts))
    owner, keys, weights = neardups.shingles(chunk)
    for row, text in enumerate(texts):
        assert sorted(weights[owner == row]) == sorted(bag(text).values())
    size = 4000
    found = neardups.registers(owner, keys, weights, chunk.n, size)
    for i in range(5):
        for j in range(i):
            share = (found[i] == found[j]).mean()
            assert share == pytest.approx(similarity(bag(texts[i]), bag(texts[j])), abs=4 * 0.5 / size**0.5)
    assert (found[5] == 0).all() and (found[:5] != 0).all()


def test_classes_equal_brute_force(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = neardups.op5_probminhash(spark, folder).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == classes(rows)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in found)


def test_large_groups_of_copies_and_chains(spark):
    base, other = words(11, 200, 5000), words(12, 200, 5000)
    rows = [(i, base) for i in range(300)]
    rows += [(1000 + i, edited(base, 2, i)) for i in range(120)]
    chain = other
    for i in range(25):  # each link is near the last, the ends are far apart
        rows.append((2000 + i, chain))
        chain = edited(chain, 3, 100 + i)
    rows += [(3000 + i, edited(base, 40, 500 + i)) for i in range(60)]
    rows += [(4000 + i, words(600 + i, 80, 5000)) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    distinct = {}
    for i, t in rows:
        distinct.setdefault(t, i)
    small = classes([(i, t) for t, i in distinct.items()])
    want = {i: small[distinct[t]] for i, t in rows}
    assert {r["doc_id"]: r["class_id"] for r in neardups.near_duplicates(docs).collect()} == want


def test_tiles_join_what_leaders_leave_apart(spark, monkeypatch):
    """Far from the most central text, but near to each other; small tiles find the same."""
    base = words(21, 150, 5000)
    rows = []
    for g in range(6):
        far = edited(base, 6, 50 + g)
        rows += [(100 * g + i, edited(far, 1, 1000 * g + i)) for i in range(8)]
    rows += [(1000 + i, edited(base, 1, 7000 + i)) for i in range(30)]
    want = classes(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert len(set(want.values())) == 7
    assert {r["doc_id"]: r["class_id"] for r in neardups.near_duplicates(docs).collect()} == want
    monkeypatch.setattr(neardups, "TILE_TEXTS", 10)
    assert {r["doc_id"]: r["class_id"] for r in neardups.near_duplicates(docs).collect()} == want


def test_links_of_a_tile_equal_all_pairs():
    rng = random.Random(5)
    groups = [Counter({rng.randrange(40): rng.choice([1, 1, 1, 2, 5]) for _ in range(25)}) for _ in range(4)]
    bags = []
    for i in range(40):
        own = Counter(groups[i % 4])
        for _ in range(rng.randrange(4)):
            own[rng.randrange(40, 60)] = 1
            own.pop(rng.choice(list(own)), None)
        bags.append(own)
    pack = lambda c: (np.array(sorted(c), dtype="<u4").tobytes(), np.array([c[k] for k in sorted(c)], dtype="<u4").tobytes())
    rows = [(True, i, *pack(b)) for i, b in enumerate(bags)] + [(False, i, *pack(b)) for i, b in enumerate(bags)]
    tile = pa.table([pa.array([r[0] for r in rows]), pa.array([bytes([r[1]]) for r in rows]), pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary())], names=["left", "label", "keys", "weights"])
    root = list(range(40))

    def find(x):
        return x if root[x] == x else find(root[x])

    for i in range(40):
        for j in range(i):
            if similarity(bags[i], bags[j]) >= 0.8:
                root[max(find(i), find(j))] = min(find(i), find(j))
    want = [find(i) for i in range(40)]
    root = list(range(40))
    for a, b in neardups.tile_links(tile, 0.8):
        assert a < 40 <= b and similarity(bags[a], bags[b - 40]) >= 0.8 and find(a) != find(b - 40)
        root[max(find(a), find(b - 40))] = min(find(a), find(b - 40))
    assert [find(i) for i in range(40)] == want


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)]
    df = spark.createDataFrame([(a.to_bytes(2, "big"), b.to_bytes(2, "big")) for a, b in edges], "x binary, y binary")
    got = {int.from_bytes(r["node"], "big"): int.from_bytes(r["label"], "big") for r in neardups.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}}


def test_odd_rows_and_empty_table(spark, odd_docs):
    found = neardups.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert all(r["class_id"] == r["doc_id"] and r["kept"] for r in found)
    assert neardups.near_duplicates(odd_docs.limit(0)).count() == 0
    kept = neardups.near_duplicate_stage(spark, odd_docs, "")
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "6", "7", "8", "None"])
    copies = odd_docs.union(odd_docs.where("doc_id IS NULL").withColumn("doc_id", F.lit(99).cast("bigint")))
    left = neardups.near_duplicate_stage(spark, copies, "").collect()
    assert "None" not in {str(r["doc_id"]) for r in left} and 99 in {r["doc_id"] for r in left}


def test_stage_keeps_different_texts_under_one_id(spark):
    a, b, c = ("one plain text about rivers and hills", "quite another story of ships at sea", "a third note on bread, salt and wine")
    rows = [(1, a), (1, b), (1, a), (2, b), (2, c), (3, a), (3, c), (4, "?"), (4, "!"), (5, "?")]
    left = neardups.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "").collect()
    assert sorted(map(tuple, left)) == sorted([(1, a), (1, b), (2, c), (4, "?"), (4, "!")])
