"""Near-duplicate classes by ProbMinHash.

Texts are weighted sets of five-word shingles, weighted by how often they occur. Every shingle is a Poisson process whose
arrivals fall on random registers; a register keeps its first arrival, and a shingle stops once its next arrival is later
than all registers. Two texts agree in a register with the probability Jaccard similarity of their weights. Registers make
bands; texts that share a band are candidates, and only pairs whose similarity, computed from the shingles, is at least the
threshold are links.

Copies count once: bands, links and components are between distinct texts. A bucket is never paired with itself: its texts
meet the most central of them (the one whose buckets are largest), which links nearly all texts that belong together. Where
a leader's texts are still in several classes, those outside the largest class meet all of the leader's texts in tiles: a
task counts common shingles by their postings and emits no more links than join two classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namesieve.llm.texts import LOWER, MULT, Chunk, chunks, mixed, owners, segment_hashes, windows, word_bounds
from namesieve.plans.storage import written

WORDS, LEAST = 5, 0.8
BANDS, ROWS = 25, 5
#: Texts and shingles on one side of a tile, about.
TILE_TEXTS, TILE_SHINGLES = 4096, 1_000_000


def shingles(chunk: Chunk, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle (64-bit hash) and weight, sorted by text and shingle; a text of fewer words is one shingle."""
    data = LOWER[chunk.data]
    starts, ends = word_bounds(chunk)
    text_of = owners(starts, chunk.offsets)
    hashes = segment_hashes(data, starts, ends)
    n_words = np.bincount(text_of, minlength=chunk.n)
    keys, at = windows(hashes, text_of, words)
    texts = text_of[at]
    first = np.cumsum(n_words) - n_words
    for size in range(1, words):
        short = np.flatnonzero(n_words == size)
        total = np.zeros(len(short), dtype=np.uint64)
        for k in range(size):
            total = total * MULT + hashes[first[short] + k]
        keys, texts = np.concatenate([keys, mixed(total)]), np.concatenate([texts, short])
    order = np.lexsort((keys, texts))
    keys, texts = keys[order], texts[order]
    new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1])]) if len(keys) else np.zeros(0, dtype=np.int64)
    return texts[new], keys[new], np.diff(np.append(new, len(keys)))


def registers(texts: np.ndarray, keys: np.ndarray, weights: np.ndarray, n: int, size: int) -> np.ndarray:
    """For each of ``n`` texts the shingle that arrives first at each of ``size`` registers; texts without shingles stay 0."""
    first = np.full(n * size, np.inf)
    winner = np.zeros(n * size, dtype=np.uint64)
    texts, keys, rate = texts.astype(np.int64), keys.copy(), weights.astype(float)
    time, drawn, block = np.zeros(len(keys)), 0, 1
    while len(keys):
        for _ in range(block):
            drawn += 1
            draw = mixed(keys + np.uint64(drawn * int(MULT) & 0xFFFFFFFFFFFFFFFF))
            time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / rate
            slot = texts * size + (mixed(draw) % np.uint64(size)).astype(np.int64)
            np.minimum.at(first, slot, time)
            won = first[slot] == time
            winner[slot[won]] = keys[won]
        latest = first.reshape(n, size).max(axis=1)
        alive = time <= latest[texts]
        texts, keys, rate, time = texts[alive], keys[alive], rate[alive], time[alive]
        # Only few shingles last long, those of short texts: look less often whether their time is over.
        block = min(block * 2, 32) if drawn > 2 else 1
    return winner.reshape(n, size)


def band_hashes(winners: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * MULT, (len(winners), 1))
    for k in range(rows):
        out = mixed(out * MULT + winners[:, k::rows][:, :bands])
    return out.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``node`` (16 bytes that stand for the text) and ``bands``, empty if the text has no word."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                texts, keys, weights = shingles(chunk)
                found = band_hashes(registers(texts, keys, weights, chunk.n, BANDS * ROWS))
                worded = np.bincount(texts, minlength=chunk.n) > 0
                ends = np.concatenate([[0], np.cumsum(np.where(worded, BANDS, 0))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(found[worded].ravel()))
                rows = slice(chunk.first, chunk.first + chunk.n)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[rows], batch.column("node")[rows], bands], names=["doc_id", "node", "bands"])

    kind = docs.schema["doc_id"].dataType
    return docs.mapInArrow(run, T.StructType([T.StructField("doc_id", kind), T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]))


def probability_jaccard(a: np.ndarray, u: np.ndarray, b: np.ndarray, v: np.ndarray) -> float:
    """Sum over common shingles x of 1 / sum over all i of max(u_i / u_x, v_i / v_x); keys are distinct."""
    keys, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = np.zeros(len(keys)), np.zeros(len(keys))
    left[at[: len(a)]], right[at[len(a) :]] = u, v
    with np.errstate(divide="ignore"):
        ratio = left / right
    order = np.argsort(ratio, kind="stable")
    left, right, ratio = left[order], right[order], ratio[order]
    both = np.flatnonzero((left > 0) & (right > 0))
    if not len(both):
        return 0.0
    # Where u_i / v_i is at least the ratio of x, u_i / u_x is the larger one; before that v_i / v_x.
    cut = np.searchsorted(ratio, ratio[both], side="left")
    below = np.concatenate([[0], np.cumsum(right)])[cut]
    above = left.sum() - np.concatenate([[0], np.cumsum(left)])[cut]
    return float((1 / (above / left[both] + below / right[both])).sum())


def weighted_sets(docs: DataFrame) -> DataFrame:
    """``node``, ``keys`` (sorted 32-bit shingles) and ``weights`` of each row of ``docs`` (``node``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                texts, keys, weights = shingles(chunk)
                bounds = np.searchsorted(texts, np.arange(chunk.n + 1))
                small, weights = (keys >> np.uint64(32)).astype("<u4"), weights.astype("<u4")
                rows = [(small[i:j].tobytes(), weights[i:j].tobytes()) for i, j in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(chunk.first, chunk.n), *(pa.array(x, pa.binary()) for x in zip(*rows))], names=["node", "keys", "weights"])

    return docs.select("node", "text").mapInArrow(run, "node binary, keys binary, weights binary")


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (``x``, ``y``) with ``sim``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [batch.column(c) for c in ("xk", "xw", "yk", "yw")]
            sims = [probability_jaccard(*(np.frombuffer(c[row].as_buffer(), dtype="<u4") for c in cells)) for row in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.array(sims, pa.float64())], names=["x", "y", "sim"])

    x, y = (sets.select(F.col("node").alias(c), F.col("keys").alias(f"{c}k"), F.col("weights").alias(f"{c}w")) for c in "xy")
    return pairs.join(x, "x").join(y, "y").select("x", "y", "xk", "xw", "yk", "yw").mapInArrow(run, "x binary, y binary, sim double")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node) of every component of ``edges`` (``x``, ``y``), by alternating stars."""
    least = lambda df: df.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x <> y").distinct()
    edges, before = written(least(edges), "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.groupBy(F.col("y").alias("node")).agg(F.min("x").alias("label"))
        before = now
        both = edges.select("x", "y").union(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        lowest = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.join(lowest, "x").where("y > x").select("m", F.col("y").alias("x"))
        nearest = large.groupBy("x").agg(F.min("m").alias("low"))
        small = large.join(nearest, "x").select(F.col("m").alias("x"), F.col("low").alias("y")).union(nearest.select("x", F.col("low").alias("y")))
        edges = written(least(small), "edges")


def _relabel(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (``node``, ``label``) after joining what ``edges`` link."""
    at = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    between = edges.join(at("x"), "x").join(at("y"), "y").select(F.col("x_label").alias("x"), F.col("y_label").alias("y"))
    merged = components(between).select(F.col("node").alias("label"), F.col("label").alias("root"))
    return written(labels.join(merged, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "labels")


def links(nodes: DataFrame, docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``node`` and ``label`` of every node that shares a band with another; linked nodes have one label.

    ``nodes``: ``node``, ``low`` (smallest ``doc_id``) and ``bands``, one row per distinct text; ``docs`` has the texts.
    """
    members = nodes.select("node", F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(members.join(buckets, "band"), "shared")
    central = shared.groupBy("node").agg(F.sum("n").alias("weight"))
    leaders = shared.join(central, "node").groupBy("band").agg(F.max_by("node", F.struct("weight", "node")).alias("leader"))
    groups = written(shared.select("node", "band").join(leaders, "band").select("leader", "node").distinct(), "groups")

    # By id as well as text: the many copies of one text do not meet in one task.
    holders = central.select("node").join(nodes.select("node", "low"), "node")
    holder = (F.col("d.node") == F.col("h.node")) & F.col("d.doc_id").eqNullSafe(F.col("h.low"))
    wanted = docs.withColumn("node", F.unhex(F.md5("text"))).alias("d").join(holders.alias("h"), holder, "left_semi").dropDuplicates(["node"])
    sets = written(weighted_sets(wanted), "sets")

    stars = groups.where("leader <> node").select(F.col("leader").alias("x"), F.col("node").alias("y"))
    near = written(similarities(stars, sets).where(F.col("sim") >= least).select("x", "y"), "links")
    labels = _relabel(central.select("node", F.col("node").alias("label")), near)

    known = groups.join(labels, "node")
    apart = known.groupBy("leader").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("leader")
    placed = written(known.join(apart, "leader"), "placed")
    return _relabel(labels, written(_tiles(placed, sets, least), "links"))


def _tiles(placed: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links between the labels of each leader's texts, enough to join what belongs together.

    ``placed`` has ``leader``, ``node`` and ``label``. Texts outside the leader's most frequent label are on one side of the
    tiles, all of its texts on the other; both sides are dealt into parts of bounded size by hash.
    """
    sizes = written(sets.select("node", F.octet_length("keys").alias("bytes")), "set-sizes")
    sized = placed.join(sizes, "node")
    often = sized.groupBy("leader", "label").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    sides = often.groupBy("leader").agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max_by(F.struct("n", "bytes"), F.struct("n", "label")).alias("whole"))
    parts = lambda n, size: F.greatest(F.ceil(n / TILE_TEXTS), F.ceil(size / (4 * TILE_SHINGLES)), F.lit(1)).cast("int")
    sides = sides.select("leader", "most", parts(F.col("n"), F.col("bytes")).alias("columns"), parts(F.col("n") - F.col("whole.n"), F.col("bytes") - F.col("whole.bytes")).alias("rows"))
    dealt = placed.join(sides, "leader").withColumn("own", F.xxhash64("node"))
    column = F.pmod("own", "columns").cast("int")
    row = F.pmod("own", "rows").cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    left = dealt.where("label <> most").select("leader", row.alias("i"), F.explode(every("columns")).alias("j"), "node", "label", F.lit(True).alias("left"))
    right = dealt.select("leader", F.explode(every("rows")).alias("i"), column.alias("j"), "node", "label", F.lit(False).alias("left"))
    filled = left.unionByName(right).join(sets, "node")

    def run(tile: pa.Table) -> pa.Table:
        pairs = tile_links(tile, least)
        node = tile["node"].combine_chunks()
        x, y = (node.take(pa.array(np.array(side, dtype=np.int64))) for side in (zip(*pairs) if pairs else ((), ())))
        return pa.table([x, y], names=["x", "y"])

    return filled.groupBy("leader", "i", "j").applyInArrow(run, "x binary, y binary")


def tile_links(tile: pa.Table, least: float) -> list[tuple[int, int]]:
    """Pairs of rows of ``tile`` (``left``, ``label``, ``keys``, ``weights``) with at least this similarity, a left row first.

    Of all pairs whose labels differ, only those that join classes which no pair before them joined. A pair's similarity is
    at most the weight that the two share, each one's weights scaled to sum to one; where all weights are one it follows from
    the number of common shingles, and elsewhere it is computed for pairs that pass this bound.
    """
    left = np.asarray(tile["left"]).astype(bool)
    keys = [np.frombuffer(x.as_buffer(), dtype="<u4") for x in tile["keys"]]
    weights = [np.frombuffer(x.as_buffer(), dtype="<u4").astype(float) for x in tile["weights"]]
    labels = tile["label"].to_pylist()
    plain = np.array([bool((w == 1).all()) for w in weights])
    size = np.array([len(k) for k in keys])
    total = np.array([w.sum() for w in weights])
    right = np.flatnonzero(~left)
    flat = np.concatenate([keys[r] for r in right]) if len(right) else np.zeros(0, dtype="<u4")
    share = np.concatenate([weights[r] / total[r] for r in right]) if len(right) else np.zeros(0)
    owner = np.repeat(np.arange(len(right)), size[right])
    order = np.argsort(flat, kind="stable")
    flat, share, owner = flat[order], share[order], owner[order]
    code = {x: i for i, x in enumerate(dict.fromkeys(labels))}
    root = list(range(len(code)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    label = np.array([code[x] for x in labels])
    out = []
    for row in np.flatnonzero(left):
        first, last = np.searchsorted(flat, keys[row], side="left"), np.searchsorted(flat, keys[row], side="right")
        count = last - first
        at = np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)
        own = np.repeat(weights[row] / total[row], count)
        common = np.bincount(owner[at], np.minimum(share[at], own), len(right))
        for k in np.flatnonzero((common >= least - 1e-9) & (label[right] != label[row])):
            other = right[k]
            a, b = find(label[row]), find(label[other])
            if a == b:
                continue
            if plain[row] and plain[other]:
                same = round(common[k] * max(size[row], size[other]))
                sim = same / (size[row] + size[other] - same)
            else:
                sim = probability_jaccard(keys[row], weights[row], keys[other], weights[other])
            if sim >= least:
                root[max(a, b)] = min(a, b)
                out.append((int(row), int(other)))
    return out


def near_duplicates(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """Class of every document: ``doc_id``, ``class_id`` (smallest id in its class), ``kept`` (it is that one).

    Classes are the components of links: equal texts, and texts whose five-word shingles (words are split at white space, A-Z
    in lower case; fewer than five words are one shingle) have a probability Jaccard similarity of at least ``least``. Texts
    without a word, null ones included, are classes of their own. One row per row of ``docs``; repeated rows are in one class
    and all ``kept`` if one is; other columns are ignored. A null id is never the smallest, and kept if its class has no other.
    Two texts with exactly the least similarity share no band, and may be missed, in one of 20,000 cases.
    """
    return _classified(docs, least).drop("node", "label")


def _classified(docs: DataFrame, least: float = LEAST) -> DataFrame:
    docs = docs.select("doc_id", "text")
    signed = written(signatures(docs), "signatures")
    nodes = signed.where(F.size("bands") > 0).groupBy("node").agg(F.min("doc_id").alias("low"), F.first("bands").alias("bands"))
    nodes = written(nodes, "nodes")
    labels = links(nodes, docs, least)
    classes = nodes.select("node", "low").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    classes = written(classes, "classes")
    lowest = classes.groupBy("label").agg(F.min("low").alias("class_id"))
    found = classes.join(lowest, "label").select("node", "label", "class_id", F.lit(True).alias("worded"))
    out = signed.select("doc_id", "node").join(found, "node", "left")
    class_id = F.when(F.col("worded"), F.col("class_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "node", "label", class_id.alias("class_id"), F.coalesce(F.col("doc_id") == class_id, class_id.isNull()).alias("kept"))


def op5_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, that with the smallest id; of repeated rows one.

    Different texts under one id are documents of their own; of those in one class, that with the smallest hash stays. Rows
    without an id cannot be told apart: they stay if nothing in their class has one.
    """
    kept = written(_classified(docs).where("kept").select("doc_id", "node", "label"), "kept")
    rows = docs.withColumn("__node", F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))))
    one = kept.where("doc_id IS NOT NULL").groupBy("doc_id", F.coalesce("label", "node").alias("class")).agg(F.min("node").alias("__node"))
    named = rows.join(one.select("doc_id", "__node"), ["doc_id", "__node"], "left_semi").dropDuplicates(["doc_id", "__node"])
    nameless = rows.where("doc_id IS NULL").join(kept.where("doc_id IS NULL").select(F.col("node").alias("__node")).distinct(), "__node", "left_semi")
    return named.select(*docs.columns).unionByName(nameless.select(*docs.columns))
