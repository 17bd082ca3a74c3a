"""Language-model scores of whole texts by context-tree weighting over their bytes.

A text is coded as its lower-cased tokens, each with a blank after it, and an end. The context of a byte are the bytes before
it in the text, across tokens; before the start there are zeros. The steps, each a Spark job over all texts:

1. Texts become pieces of some megabytes. A piece asks for its distinct tokens and for its distinct grams (a byte and its
   context), with their occurrences in training texts, in packed lists dealt to buckets.
2. Tokens and grams are summed bucket by bucket; a bucket that many pieces ask is several parts.
3. Distinct grams are grouped by their nearest three context bytes, which makes deep subtrees local to a task; the shallow
   levels are sums of sums, the last two bounded at 256 contexts. Each gram gets its probability.
4. Each list is answered in its order, and a piece adds up its texts. Nothing is joined per occurrence.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namesieve.llm import contexttree as ct
from namesieve.llm.texts import LOWER, SPACES, Chunk, chunks, owners, segment_hashes, word_bounds
from namesieve.plans.storage import written

DEPTH, LOCAL_FROM = 6, 3
#: Text in a piece, packed lists in a part of a bucket, and text whose square root is the number of buckets.
PIECE_BYTES, PART_BYTES, BUCKET_BYTES = 12 << 20, 32 << 20, 1 << 18
BUCKET_GRAMS = 40_000
CHUNK_BYTES, BLOCK, MERGE_GRAMS = 1 << 18, 1 << 19, 1 << 19
START, END = 0x20, 0x0A
#: Zero bytes before each text, so that a window of eight bytes ends at each of its bytes.
PAD = 7


def _zipped(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unzipped(cell: bytes) -> bytes:
    size = int.from_bytes(cell[:8], "little")
    return pa.decompress(cell[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _packed(values: np.ndarray) -> bytes:
    """Numbers as one compressed cell, their first bytes first."""
    return _zipped(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes())


def _unpacked(cell: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(_unzipped(cell), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _keys(cell: bytes) -> np.ndarray:
    """An ascending list of grams, packed as steps."""
    return np.cumsum(_unpacked(cell, np.uint64), dtype=np.uint64)


def _tokens(data: bytes, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def coded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text_of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``n`` texts as they are coded, each after ``PAD`` zeros and a blank, and how many are coded of each text."""
    size = ends - starts + 1
    lengths = np.bincount(text_of, size, n).astype(np.int64) + 1
    begin = np.cumsum(lengths + PAD + 1) - (lengths + PAD + 1)
    line = np.full(int(lengths.sum()) + (PAD + 1) * n, START, dtype=np.uint8)
    line[(begin[:, None] + np.arange(PAD)).ravel()] = 0
    line[begin + PAD + lengths] = END
    solid = np.flatnonzero(~SPACES[data])
    line[solid + np.repeat(np.cumsum(size) - size + (PAD + 2) * text_of + PAD + 1 - starts, ends - starts)] = data[solid]
    return line, lengths


def grams_of(line: np.ndarray, lengths: np.ndarray, depth: int = DEPTH) -> Iterator[np.ndarray]:
    """The grams of all coded bytes in order, some at a time: ``depth`` bytes before, nearest highest, and the byte lowest."""
    begin = np.cumsum(lengths + PAD + 1) - (lengths + PAD + 1)
    coded_at = np.ones(len(line), dtype=bool)
    coded_at[(begin[:, None] + np.arange(PAD + 1)).ravel()] = False
    window = np.ndarray(len(line) - PAD, dtype="<u8", buffer=line, strides=(1,))
    low, byte = np.uint64((1 << 56) - 1), np.uint64(8)
    for at in range(0, len(window), BLOCK):
        eight = window[at : at + BLOCK][coded_at[at + PAD : at + PAD + BLOCK]]
        yield (eight & low) >> np.uint64(8 * (PAD - depth)) << byte | eight >> np.uint64(56)


def _parsed(chunk: Chunk, data: np.ndarray) -> tuple[np.ndarray, ...]:
    starts, ends = word_bounds(chunk)
    text_of = owners(starts, chunk.offsets).astype(np.int64)
    return starts, ends, text_of, segment_hashes(data, starts, ends), *coded(data, starts, ends, text_of, chunk.n)


#: Spreads a number below 2^24 over 35 bits; the same in NumPy and in SQL.
_SPREAD = 1540483477
_NEAR = 8 * (DEPTH + 1 - LOCAL_FROM)


def _gram_bucket(gram: np.ndarray, buckets: int) -> np.ndarray:
    return ((gram >> np.uint64(_NEAR)) * np.uint64(_SPREAD) >> np.uint64(20)) % np.uint64(buckets)


def gram_bucket(gram: Column, buckets: int) -> Column:
    """Bucket of a gram, by its nearest three context bytes."""
    return F.pmod(F.shiftright(F.shiftrightunsigned(gram, _NEAR) * F.lit(_SPREAD).cast("long"), 20), F.lit(buckets)).cast("int")


def _dealt(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order by bucket, kept inside each, and the bucket, begin and end of each run in it."""
    order = np.argsort(bucket, kind="stable")
    at = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=bucket.dtype)).tolist()
    return order, [(b, i, j) for b, (i, j) in enumerate(zip(at, at[1:])) if i < j]


class _Piece:
    """Passes chunks of texts on and collects their distinct tokens and grams, with their occurrences in training texts."""

    def __init__(self, buckets: int) -> None:
        self.id, self.buckets, self.chunks = random.getrandbits(62), buckets, 0
        self.hashes: list[np.ndarray] = []
        self.tokens: list[pa.Array] = []
        self.trained: list[np.ndarray] = []
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        self.bytes = 0

    def add(self, chunk: Chunk, ids: pa.Array, held: np.ndarray) -> pa.RecordBatch:
        """Counts a chunk; the row with its texts, numbered in place of a bucket."""
        data = LOWER[chunk.data]
        starts, ends, text_of, word, line, lengths = _parsed(chunk, data)
        hashes, first, inverse = np.unique(word, return_index=True, return_inverse=True)
        at, size = starts[first], ends[first] - starts[first]
        where = np.arange(int(size.sum())) + np.repeat(at - (np.cumsum(size) - size), size)
        self.tokens.append(_tokens(data[where].tobytes(), size))
        self.hashes.append(hashes)
        self.trained.append(np.bincount(inverse, ~held[text_of], len(hashes)).astype(np.int64))
        learned, done = np.repeat(~held, lengths), 0
        for gram in grams_of(line, lengths):
            own = learned[done : done + len(gram)]
            done += len(gram)
            seen, n = np.unique(gram[own], return_counts=True)
            other = _distinct(gram[~own])
            self.grams += [(seen, n), (other, np.zeros(len(other), dtype=np.int64))]
            if sum(len(x) for x, _ in self.grams[1:]) > MERGE_GRAMS:
                self.grams = [_merged(self.grams)]
        self.bytes += len(data)
        self.chunks += 1
        return self._batch([("text", self.chunks, _zipped(data.tobytes()), _packed(held), _packed(np.diff(chunk.offsets)), int((~held).sum()))], ids)

    def _batch(self, rows: list[tuple], ids: pa.Array) -> pa.RecordBatch:
        """``rows`` of a kind, the first of them with ``ids``."""
        kinds, buckets, keys, train, sizes, docs = zip(*rows)
        lists = pa.ListArray.from_arrays(pa.array([0] + [len(ids)] * len(rows), pa.int32()), ids)
        cells = (pa.array(x, pa.binary()) for x in (keys, train, sizes))
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds), pa.array([self.id] * len(rows)), pa.array(buckets, pa.int32()), lists, *cells, pa.array(docs, pa.int64())],
            names=["kind", "piece", "bucket", "ids", "keys", "train", "sizes", "train_docs"],
        )

    def asks(self, no_ids: pa.Array) -> Iterator[pa.RecordBatch]:
        """A row per bucket of tokens, then of grams; what was collected goes as soon as it is packed."""
        for lists in (self._token_lists, self._gram_lists):
            rows = lists()
            if rows:
                yield self._batch(rows, no_ids)
            del rows
            pa.default_memory_pool().release_unused()

    def _token_lists(self) -> list[tuple]:
        hashes, first, inverse = np.unique(np.concatenate(self.hashes), return_index=True, return_inverse=True)
        trained = np.bincount(inverse, np.concatenate(self.trained), len(hashes)).astype(np.int64)
        order, bounds = _dealt(hashes % np.uint64(self.buckets), self.buckets)
        tokens = pa.concat_arrays(self.tokens).take(pa.array(first[order]))
        self.hashes, self.tokens, self.trained = [], [], []
        sizes = np.asarray(pc.binary_length(tokens)).astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        data = memoryview(tokens.buffers()[2] or b"")
        return [("token", b, _zipped(bytes(data[ends[i] : ends[j]])), _packed(trained[order[i:j]]), _packed(sizes[i:j]), 0) for b, i, j in bounds]

    def _gram_lists(self) -> list[tuple]:
        gram, n = _merged(self.grams)
        self.grams = []
        order, bounds = _dealt(_gram_bucket(gram, self.buckets), self.buckets)
        return [("gram", b, _packed(np.diff(gram[order[i:j]], prepend=np.uint64(0))), _packed(n[order[i:j]]), None, 0) for b, i, j in bounds]


def _distinct(*lists: np.ndarray) -> np.ndarray:
    # Several lists are sorted ones: a stable sort merges their runs.
    x = np.sort(lists[0]) if len(lists) == 1 else np.sort(np.concatenate(lists), kind="stable")
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def _merged(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return ct.summed(np.concatenate([x for x, _ in lists]), np.concatenate([n for _, n in lists]))


def pieces(docs: DataFrame, buckets: int, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Texts of ``docs`` (``doc_id``, ``text``, ``held_out``) in pieces, and what each asks for, as rows of three kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, ids = _Piece(buckets), None
        for batch in batches:
            held, ids = np.asarray(batch.column("held_out").to_pylist(), dtype=bool), batch.column("doc_id")
            for chunk in chunks(batch.column("text"), CHUNK_BYTES):
                yield piece.add(chunk, ids.slice(chunk.first, chunk.n), held[chunk.first : chunk.first + chunk.n])
                if piece.bytes >= piece_bytes:
                    yield from piece.asks(ids[:0])
                    piece = _Piece(buckets)
        if piece.chunks:
            yield from piece.asks(ids[:0])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"kind string, piece bigint, bucket int, ids array<{kind}>, keys binary, train binary, sizes binary, train_docs bigint")


def _parted(asks: DataFrame, part_bytes: int) -> tuple[DataFrame, DataFrame]:
    """``asks`` with the ``part`` of its bucket, and ``parts`` of each bucket: as many rows as buckets, at most."""
    held = F.sum(F.length("keys") + F.length("train") + F.coalesce(F.length("sizes"), F.lit(0)))
    parts = written(asks.groupBy("bucket").agg(F.ceil(held / part_bytes).cast("int").alias("parts")), "parts")
    part = F.pmod(F.xxhash64("piece"), F.col("parts")).cast("int").alias("part")
    return asks.join(F.broadcast(parts), "bucket").select("bucket", part, "piece", "keys", "train", "sizes"), parts


def gram_totals(asks: DataFrame) -> DataFrame:
    """``gram`` and ``n``: the distinct grams of all texts, with their occurrences in training texts."""

    def add(part: pa.Table) -> pa.Table:
        lists = [(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))]
        for keys, train in zip(part["keys"], part["train"]):
            lists.append((_keys(keys.as_py()), _unpacked(train.as_py(), np.int64)))
            if sum(len(x) for x, _ in lists[1:]) > MERGE_GRAMS:
                lists = [_merged(lists)]
        gram, n = _merged(lists)
        return pa.table([pa.array(gram.view(np.int64)), pa.array(n)], names=["gram", "n"])

    return asks.groupBy("bucket", "part").applyInArrow(add, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def token_totals(asks: DataFrame) -> DataFrame:
    """``bucket``, ``token`` and ``n``: the distinct tokens of all texts, with their occurrences in training texts."""

    def add(part: pa.Table) -> pa.Table:
        total = pa.table([pa.array([], pa.binary()), pa.array([], pa.int64())], names=["token", "n"])
        fresh = [total]
        for k in range(part.num_rows):
            data, train, sizes = (part[c][k].as_py() for c in ("keys", "train", "sizes"))
            fresh.append(pa.table([_tokens(_unzipped(data), _unpacked(sizes, np.int32)), pa.array(_unpacked(train, np.int64))], names=["token", "n"]))
            if k == part.num_rows - 1 or sum(x.num_rows for x in fresh[1:]) > MERGE_GRAMS:
                total = pa.concat_tables(fresh).group_by("token").aggregate([("n", "sum")]).select(["token", "n_sum"]).rename_columns(["token", "n"])
                fresh = [total]
        return total.add_column(0, "bucket", pa.array(np.full(total.num_rows, part["bucket"][0].as_py(), dtype=np.int32)))

    return asks.groupBy("bucket", "part").applyInArrow(add, "bucket int, token binary, n bigint").groupBy("bucket", "token").agg(F.sum("n").alias("n"))


ANSWERS = "piece bigint, kind string, bucket int, answer binary"


def _answered(part: pa.Table, kind: str, answers: list[bytes]) -> pa.Table:
    return pa.table([part["piece"], pa.array([kind] * part.num_rows, pa.string()), part["bucket"], pa.array(answers, pa.binary())], names=["piece", "kind", "bucket", "answer"])


def gram_answers(asks: DataFrame, scores: DataFrame) -> DataFrame:
    """For each list of grams their log probabilities, in its order; ``scores`` has the ``part`` of the lists."""

    def answer(part: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(known["gram"]).view(np.uint64))
        gram, log_p = np.asarray(known["gram"]).view(np.uint64)[order], np.asarray(known["log_p"])[order].astype(np.float32)
        return _answered(part, "gram", [_packed(log_p[np.searchsorted(gram, _keys(x.as_py()))]) for x in part["keys"]])

    asks = asks.select("bucket", "part", "piece", "keys")
    return asks.groupBy("bucket", "part").cogroup(scores.groupBy("bucket", "part")).applyInArrow(answer, ANSWERS)


def token_answers(asks: DataFrame, totals: DataFrame) -> DataFrame:
    """For each list of tokens their occurrences in training texts, in its order; ``totals`` has the ``part`` of the lists."""

    def answer(part: pa.Table, known: pa.Table) -> pa.Table:
        token, n = known["token"].combine_chunks(), np.asarray(known["n"])
        lists = (_tokens(_unzipped(x.as_py()), _unpacked(sizes.as_py(), np.int32)) for x, sizes in zip(part["keys"], part["sizes"]))
        return _answered(part, "token", [_packed(n[np.asarray(pc.index_in(x, value_set=token))]) for x in lists])

    asks = asks.select("bucket", "part", "piece", "keys", "sizes")
    return asks.groupBy("bucket", "part").cogroup(totals.groupBy("bucket", "part")).applyInArrow(answer, ANSWERS)


NODES = "bucket int, node bigint, zeros bigint, ones bigint, log_p double"


def _ascending(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Grams in their order, so that sorts of their nodes find runs and searches for them go forward, and their counts."""
    gram = np.asarray(part["gram"]).view(np.uint64)
    order = np.argsort(gram)
    return gram[order], np.asarray(part["n"])[order]


def _wanted(gram: np.ndarray, tree: ct.Level, drop: int) -> tuple[np.ndarray, ...]:
    """All nodes that grams ask for at the tree's top level, with zero counts where training texts have none."""
    nodes = np.unique(ct.decisions(gram, drop)[0])
    at = np.minimum(np.searchsorted(tree.nodes, nodes), max(len(tree.nodes) - 1, 0))
    seen = tree.nodes[at] == nodes if len(tree.nodes) else np.zeros(len(nodes), dtype=bool)
    pick = lambda x: np.where(seen, x[at], 0) if len(tree.nodes) else np.zeros(len(nodes))
    return nodes, pick(tree.zeros).astype(np.int64), pick(tree.ones).astype(np.int64), pick(tree.log_p).astype(float)


def _deep(gram: np.ndarray, n: np.ndarray) -> list[ct.Level]:
    return ct.levels(gram[n > 0], n[n > 0], DEPTH, LOCAL_FROM)


def _up(nodes: DataFrame) -> DataFrame:
    """The level above: counts and children's log probabilities summed by the node without its farthest byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            zeros, ones, below = (np.asarray(batch.column(c), dtype=float) for c in ("zeros", "ones", "below"))
            log_p, weight = ct.weighted(zeros, ones, np.where(zeros + ones > 0, below, np.nan))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.where(zeros + ones > 0, log_p, 0.0)), pa.array(np.where(zeros + ones > 0, weight, 0.0))], names=["node", "zeros", "ones", "log_p", "weight"])

    parent = F.expr("shiftleft(shiftrightunsigned(node, 16), 8) | (node & 255)")
    return nodes.groupBy(parent.alias("node")).agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_p").alias("below")).mapInArrow(run, "node bigint, zeros bigint, ones bigint, log_p double, weight double")


def _down(zeros, ones, weight, one, left, held):
    """Mixture so far, weight left and estimate of the deepest seen node, one level further down."""
    seen = zeros + ones > 0
    estimate = np.where(seen, (ones + 0.5) / (zeros + ones + 1), held)
    return one + left * weight * estimate, left * (1 - weight), estimate


def gram_scores(table: DataFrame) -> DataFrame:
    """``gram`` and ``log_p`` (natural) of every row of ``table`` (``gram``, ``n``), by the weighted tree of all counts."""
    buckets = max(1, -(-table.count() // BUCKET_GRAMS))
    near = F.shiftrightunsigned("gram", 8 * (DEPTH + 1 - LOCAL_FROM))
    table = table.withColumn("bucket", F.pmod(F.xxhash64(near), F.lit(buckets)).cast("int"))

    def trees(part: pa.Table) -> pa.Table:
        gram, n = _ascending(part)
        found = _wanted(gram, _deep(gram, n)[-1], DEPTH - LOCAL_FROM)
        return pa.table([pa.array(np.full(len(found[0]), part["bucket"][0].as_py(), dtype=np.int32)), pa.array(found[0].view(np.int64)), *map(pa.array, found[1:])], names=["bucket", "node", "zeros", "ones", "log_p"])

    third = written(table.groupBy("bucket").applyInArrow(trees, NODES), "nodes")
    second = written(_up(third.select("node", "zeros", "ones", "log_p")), "nodes")
    # At most 256 contexts of 255 decisions each, and then 255: small by construction.
    first = _up(second)
    first_rows = sorted(first.collect())
    root = {}
    for node, zeros, ones, log_p, _ in first_rows:
        z, o, p = root.get(node & 255, (0, 0, 0.0))
        root[node & 255] = (z + zeros, o + ones, p + log_p)
    at_root = np.zeros((256, 3))
    at_root[:, 2] = 0.5
    for k, (z, o, p) in root.items():
        if z + o:
            weight = ct.weighted(np.array([float(z)]), np.array([float(o)]), np.array([p]))[1]
            at_root[k] = [x[0] for x in _down(np.array([z]), np.array([o]), weight, np.array([0.0]), np.array([1.0]), np.array([0.5]))]
        else:
            at_root[k] = [0.0, 1.0, 0.5]
    keys = np.array([r[0] for r in first_rows], dtype=np.int64)
    at_first = np.stack(_down(*(np.array([r[k] for r in first_rows], dtype=float) for k in (1, 2, 4)), *at_root[keys & 255].T), axis=1) if len(keys) else np.zeros((0, 3))

    def open_second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = np.asarray(batch.column("node"))
            zeros, ones, weight = (np.asarray(batch.column(c), dtype=float) for c in ("zeros", "ones", "weight"))
            parent = (node.view(np.uint64) >> np.uint64(16) << np.uint64(8)).view(np.int64) | node & 255
            above = at_first[np.searchsorted(keys, parent)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *(pa.array(x) for x in _down(zeros, ones, weight, *above.T))], names=["parent", "above", "rest", "held"])

    opened = second.mapInArrow(open_second, "parent bigint, above double, rest double, held double")
    parent = F.expr("shiftleft(shiftrightunsigned(node, 16), 8) | (node & 255)")
    upper = third.select("bucket", "node", parent.alias("parent")).join(opened, "parent").select("bucket", "node", "above", "rest", "held")

    def score(part: pa.Table, top: pa.Table) -> pa.Table:
        gram, n = _ascending(part)
        order = np.argsort(np.asarray(top["node"]).view(np.uint64))
        node = np.asarray(top["node"]).view(np.uint64)[order]
        at = np.searchsorted(node, ct.decisions(gram, DEPTH - LOCAL_FROM)[0])
        above, rest, held = (np.asarray(top[c])[order][at] for c in ("above", "rest", "held"))
        log_p = ct.log_probability(gram, _deep(gram, n), above, rest, held)
        return pa.table([pa.array(gram.view(np.int64)), pa.array(log_p)], names=["gram", "log_p"])

    return table.groupBy("bucket").cogroup(upper.groupBy("bucket")).applyInArrow(score, "gram bigint, log_p double")


def _ranks(line: np.ndarray) -> tuple[tuple[np.ndarray, int], tuple[np.ndarray, int]]:
    """Ranks of the pairs of neighbouring bytes and of the bytes that a line has, as tables, and the bits that hold them."""
    tables = []
    for size, seen in ((1 << 16, line[1:].astype(np.uint16) << 8 | line[:-1]), (1 << 8, line)):
        present = np.zeros(size, dtype=bool)
        present[seen] = True
        tables.append((np.cumsum(present, dtype=np.uint64) - np.uint64(1), int(present.sum()).bit_length()))
    return tables[0], tables[1]


def values_of(some: np.ndarray, gram: np.ndarray, log_p: np.ndarray, ranks: tuple) -> np.ndarray:
    """The ``log_p`` of the grams ``some``, each of which is in the ascending ``gram``; ``ranks`` of the line that they are from.

    A gram's bytes as ranks leave room for its place in the same number, so one plain sort, much faster than one of places,
    brings equal grams together. Where they do not, places are sorted.
    """
    (pair, pair_bits), (byte, byte_bits) = ranks
    place = len(some).bit_length()
    if DEPTH // 2 * pair_bits + byte_bits + place > 64:
        own, at = np.unique(some, return_inverse=True)
        return log_p[np.searchsorted(gram, own)][at]
    code = np.zeros(len(some), dtype=np.uint64)
    for shift in range(8 * DEPTH - 8, 0, -16):
        code <<= np.uint64(pair_bits)
        code |= pair[(some >> np.uint64(shift)).astype(np.uint16)]
    code = (code << np.uint64(byte_bits) | byte[some.astype(np.uint8)]) << np.uint64(place) | np.arange(len(some), dtype=np.uint64)
    code.sort()
    at = (code & np.uint64((1 << place) - 1)).astype(np.int64)
    code >>= np.uint64(place)
    first = np.r_[True, code[1:] != code[:-1]][: len(code)]
    out = np.empty(len(some), dtype=log_p.dtype)
    out[at] = log_p[np.searchsorted(gram, some[at[first]])][np.cumsum(first) - 1]
    return out


def _received(found: pa.Table, kind: str, number) -> np.ndarray:
    """The answers of one kind, in the order of their buckets."""
    mine = found.filter(pc.equal(found["kind"], kind)).sort_by("bucket")
    return np.concatenate([np.zeros(0, dtype=number), *(_unpacked(x.as_py(), number) for x in mine["answer"])])


def ctw_scores(docs: DataFrame, piece_bytes: int = PIECE_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """Scores of ``docs`` (``doc_id``, ``text``, ``held_out``) under a model of the texts of those not held out.

    One row per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` and ``bits_per_byte`` (code length of the tokens, with a blank after each and the end, per byte). A null or
    empty text is its end alone; a null ``held_out`` counts as held out; with no training text every estimate is even odds.
    Repeated rows are scored each, and count each as training; an empty table gives no row.
    """
    kind = docs.schema["doc_id"].dataType
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce("held_out", F.lit(True)).alias("held_out"))
    size = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    buckets = max(1, math.isqrt(size // BUCKET_BYTES))
    rows = written(pieces(docs, buckets, piece_bytes), "pieces")
    texts = rows.where("kind = 'text'").select("piece", "ids", "keys", "train", "sizes")
    train_docs = int(rows.where("kind = 'text'").agg(F.sum("train_docs")).first()[0] or 0)
    tokens, token_parts = _parted(rows.where("kind = 'token'"), part_bytes)
    grams, gram_parts = _parted(rows.where("kind = 'gram'"), part_bytes)
    spread = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")

    totals = written(token_totals(tokens), "tokens")
    known = totals.where("n > 0").agg(F.sum("n"), F.count("*")).first()
    total, distinct = int(known[0] or 0) + train_docs, int(known[1]) + (train_docs > 0)
    scored = gram_scores(written(gram_totals(grams), "grams")).withColumn("bucket", gram_bucket(F.col("gram"), buckets))
    answers = gram_answers(grams, scored.join(F.broadcast(gram_parts), "bucket").select("bucket", spread, "gram", "log_p")).unionByName(
        token_answers(tokens, totals.join(F.broadcast(token_parts), "bucket").select("bucket", spread, "token", "n"))
    )

    def settle(piece: pa.Table, found: pa.Table) -> pa.Table:
        def parsed(k: int) -> tuple[np.ndarray, ...]:
            data, sizes = np.frombuffer(_unzipped(piece["keys"][k].as_py()), dtype=np.uint8), _unpacked(piece["sizes"][k].as_py(), np.int64)
            return _parsed(Chunk(0, data, np.concatenate([[0], np.cumsum(sizes)])), data)[2:]

        # The texts are parsed once; their grams are made twice, first for what is distinct in the piece, then for its values.
        texts, words, grams_seen = [], [], [np.zeros(0, dtype=np.uint64)]
        for k in range(piece.num_rows):
            text_of, word, line, lengths = parsed(k)
            texts.append((text_of.astype(np.int32), word, line, lengths))
            words.append(_distinct(word))
            for some in grams_of(line, lengths):
                grams_seen.append(_distinct(some))
                if sum(map(len, grams_seen[1:])) > MERGE_GRAMS:
                    grams_seen = [_distinct(*grams_seen)]
        token, gram = _distinct(np.zeros(0, dtype=np.uint64), *words), _distinct(*grams_seen)
        del words, grams_seen
        n, log_p = np.empty(len(token), dtype=np.int64), np.empty(len(gram), dtype=np.float32)
        n[_dealt(token % np.uint64(buckets), buckets)[0]] = _received(found, "token", np.int64)
        log_p[_dealt(_gram_bucket(gram, buckets), buckets)[0]] = _received(found, "gram", np.float32)
        base_of = np.log10((n + 1.0) / (total + distinct + 1.0))
        n_tokens, n_known, base, score, length = [], [], [], [], []
        for k in range(piece.num_rows):
            text_of, word, line, lengths = texts[k]
            texts[k] = None
            which = np.searchsorted(token, word)
            n_tokens.append(np.bincount(text_of, minlength=len(lengths)) + 1)
            n_known.append(np.bincount(text_of, n[which] > 0, len(lengths)).astype(np.int64) + int(train_docs > 0))
            base.append(np.bincount(text_of, base_of[which], len(lengths)) + np.log10((train_docs + 1.0) / (total + distinct + 1.0)))
            ranks = _ranks(line)
            each = [values_of(some, gram, log_p, ranks) for some in grams_of(line, lengths)]
            score.append(np.add.reduceat(np.concatenate(each), np.cumsum(lengths) - lengths, dtype=np.float64) / ct.LN10)
            length.append(lengths)
        del gram, log_p
        pa.default_memory_pool().release_unused()
        scores = np.concatenate(score)
        held = np.concatenate([_unpacked(x.as_py(), bool) for x in piece["train"]])
        return pa.table(
            [
                piece["ids"].combine_chunks().flatten(),
                pa.array(held),
                pa.array(np.concatenate(n_tokens).astype(np.int64)),
                pa.array(np.concatenate(n_known)),
                pa.array(np.full(len(held), total, dtype=np.int64)),
                pa.array(np.concatenate(base)),
                pa.array(scores),
                pa.array(-scores / np.log10(2) / np.concatenate(length)),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
        )

    counts, doubles = ("n_tokens", "n_known", "train_tokens"), ("base_score", "score", "bits_per_byte")
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType()), *(T.StructField(c, T.LongType()) for c in counts), *(T.StructField(c, T.DoubleType()) for c in doubles)])
    return texts.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(settle, schema)


def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document; those whose id hashes to 2 of 7 are held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    return ctw_scores(docs.withColumn("held_out", F.coalesce(part == 2, F.lit(False))))
