"""Alignment of two tokenizers on the same texts, with corpus-wide counts of the token pairs that end together.

Every task encodes blocks of texts. Texts are cut at blanks where neither tokenizer looks across, and a distinct segment of a
block is encoded and aligned once. The pairs of a block become records (pair, document, times), dealt by a radix of the
second tokenizer's id into runs that are sorted by that id, then by the first one's, and packed with zstd; they stay where
they are written. What is shuffled are the runs' pairs with their sums: merges of a bounded number of runs, driven by a heap
over their next pages, until each radix is one run. As that one is in the order of the second tokenizer's ids, the largest
count of each id is known as soon as its pairs have passed. The counts then go to the blocks, whose runs are read once more
and turned into sums of each document.

A pair covers the same bytes up to its end, so the bytes of one token end with those of the other: there are at most as many
pairs as the tokens of both vocabularies have bytes, however large the corpus (and as many times more as a vocabulary
spells the same bytes). This bounds the table of counts that all tasks get.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namesieve.llm.packing import tokenizer
from namesieve.llm.texts import chunks
from namesieve.plans.storage import written

BLOCK_BYTES = 8 << 20
RADIX = 16
#: Runs that one merge reads, about, and pairs on a page of a run.
FAN, PAGE = 64, 1 << 14
#: Bytes of distinct segments that are encoded in one call.
CALL_BYTES = 1 << 16

ZSTD = pa.Codec("zstd")


class Pair:
    """Two tokenizers: the byte-level one of ``a_path`` and the piece model of ``b_path``, with their tokens' bytes."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece

        self.a, self.b = tokenizer(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_size, self.b_size = self.a.n_vocab, self.b.get_piece_size()
        known = dict(zip(self.a._mergeable_ranks.values(), self.a._mergeable_ranks)) | {i: t.encode() for t, i in self.a._special_tokens.items()}
        self.a_bytes = [known.get(i, b"") for i in range(self.a_size)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b_size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        #: A blank after another character starts a piece, so texts can be cut there.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_width, self.b_width = (np.array([len(x) for x in tokens], dtype=np.int64) for tokens in (self.a_bytes, self.b_bytes))

    def encoded(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``text``, which starts with a blank that the piece model adds by itself."""
        whole = text.decode()
        a = self.a.encode_to_numpy(whole, allowed_special=set(), disallowed_special=()).astype(np.int64)
        return a, np.array(self.b.encode(whole[1:], num_threads=1), dtype=np.int64)

    def faithful(self, text: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        return b"".join(map(self.a_bytes.__getitem__, a.tolist())) == text and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == text


@lru_cache(maxsize=2)
def pair_of(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def segments(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the texts at ``starts``, each with a blank before it, can be cut, and which segments end in a character.

    A segment starts with a blank that follows a character which is surely no white space: one of ASCII, or of two bytes
    from U+00C0 on. A blank at the end of a text starts none.
    """
    before, second = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    second[2:] = (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
    before[1:] = (data[:-1] > 0x20) & (data[:-1] < 0x7F)
    firm = before | second
    cut = firm & (data == 0x20)
    cut[np.append(starts, len(data))[1:] - 1] = False  # the piece model adds no blank to nothing
    cut[starts] = True
    at = np.flatnonzero(cut)
    last = np.append(at[1:], len(data))[: len(at)] - 1
    end = np.append(firm, False)
    end[len(data)] = bool(len(data)) and (0x20 < data[-1] < 0x7F or len(data) > 1 and 0xC3 <= data[-2] <= 0xDF)
    return at, end[last + 1]


class Aligned:
    """Distinct segments with their ids, aligned: counts, pairs and spelled groups of each."""

    def __init__(self, pair: Pair, texts: list[bytes], joins: np.ndarray) -> None:
        a_parts, b_parts = [np.zeros(0, dtype=np.int64)] * len(texts), [np.zeros(0, dtype=np.int64)] * len(texts)
        self.good = np.ones(len(texts), dtype=bool)
        held, size = [], 0
        for k, text in enumerate(texts):
            if joins[k] and pair.cuts:
                held.append(k)
                size += len(text)
                if size >= CALL_BYTES:
                    self._call(pair, texts, held, a_parts, b_parts)
                    held, size = [], 0
            else:
                self._call(pair, texts, [k], a_parts, b_parts)
        self._call(pair, texts, held, a_parts, b_parts)
        self.n_a, self.n_b = (np.array([len(x) for x in parts], dtype=np.int64) for parts in (a_parts, b_parts))
        a, b = (np.concatenate([np.zeros(0, dtype=np.int64), *parts]) for parts in (a_parts, b_parts))
        # Both sides spell the same bytes, so ends count from the first segment on.
        a_ends, b_ends = np.cumsum(pair.a_width[a]), np.cumsum(pair.b_width[b])
        _, x, y = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        owner = np.repeat(np.arange(len(texts)), self.n_a)[x]
        self.n_groups = np.bincount(owner, minlength=len(texts))
        self.first = np.cumsum(self.n_groups) - self.n_groups
        self.codes = b[y] * pair.a_size + a[x]
        self.spelled = self._spelled(a, b, x, y, owner, len(texts))

    def _call(self, pair: Pair, texts: list[bytes], which: list[int], a_parts: list[np.ndarray], b_parts: list[np.ndarray]) -> None:
        """Encode the segments ``which`` together and deal the ids out, or one by one if the ids don't spell them."""
        if not which:
            return
        whole = b"".join([texts[k] for k in which])
        a, b = pair.encoded(whole)
        ends = np.cumsum([len(texts[k]) for k in which])
        if pair.faithful(whole, a, b):
            a_at, b_at = (np.searchsorted(np.cumsum(width[ids]), ends, side="right") for ids, width in ((a, pair.a_width), (b, pair.b_width)))
            for k, i, j, m, n in zip(which, np.append(0, a_at[:-1]), a_at, np.append(0, b_at[:-1]), b_at):
                a_parts[k], b_parts[k] = a[i:j], b[m:n]
        elif len(which) > 1:
            for k in which:
                self._call(pair, texts, [k], a_parts, b_parts)
        else:
            self.good[which[0]] = False

    @staticmethod
    def _spelled(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, owner: np.ndarray, n: int) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each segment: ids of a group by commas, its sides by a bar, groups by semicolons."""
        a_text, b_text = (np.array([str(i) for i in range(int(ids.max(initial=0)) + 1)], dtype=bytes) for ids in (a, b))
        parts = []
        for ids, text, last, mark in ((a, a_text, x, b"|"), (b, b_text, y, b";")):
            marks = np.full(len(ids), b",")
            marks[last] = mark
            parts.append(np.char.add(text[ids], marks) if len(ids) else np.zeros(0, dtype="S1"))
        width = max(p.dtype.itemsize for p in parts)
        # A token's place: after all tokens of the groups before its own, and b's after a's.
        a_group, b_group = (np.searchsorted(last, np.arange(len(ids))) for ids, last in ((a, x), (b, y)))
        a_before, b_before = np.append(0, x + 1), np.append(0, y + 1)
        flat = np.zeros((len(a) + len(b), width), dtype=np.uint8)
        for part, place in zip(parts, (np.arange(len(a)) + b_before[a_group], np.arange(len(b)) + a_before[b_group + 1])):
            flat[place] = part.astype(f"S{width}").view(np.uint8).reshape(-1, width)
        used = flat != 0
        ends = np.cumsum(np.append(0, used.sum(axis=1)))
        groups = np.bincount(owner, minlength=n)
        upto = np.cumsum(groups)
        tokens = (x + 1 + y + 1)  # tokens of both sides up to the end of each group
        stops = np.where(upto > 0, ends[np.append(0, tokens)[upto]], 0)
        raw, starts = flat[used].tobytes(), np.append(0, stops[:-1])
        return [raw[i : j - 1] if j > i else b"" for i, j in zip(starts.tolist(), stops.tolist())]


def packed(values: np.ndarray, kind: str) -> bytes:
    raw = values.astype(kind).tobytes()
    return len(raw).to_bytes(8, "little") + (ZSTD.compress(raw, asbytes=True) if raw else b"")


def unpacked(cell: pa.Scalar, kind: str) -> np.ndarray:
    buffer = cell.as_buffer()
    n = int.from_bytes(buffer[:8].to_pybytes(), "little")
    return np.frombuffer(ZSTD.decompress(buffer[8:], n) if n else b"", dtype=kind).astype(np.int64)


def runs_of(codes: np.ndarray, docs: np.ndarray, n_docs: int, a_size: int, radix: int) -> list[tuple[bytes, ...]]:
    """For each radix of the second id: keys (steps), sums, and documents of each key, those documents, and their times."""
    both, times = np.unique(codes * n_docs + docs, return_counts=True)
    keys, doc = both // n_docs, both % n_docs
    part = (keys // a_size) % radix
    out = []
    for k in range(radix):
        own = np.flatnonzero(part == k)
        new = np.flatnonzero(np.diff(keys[own], prepend=-1))
        sums = np.add.reduceat(times[own], new) if len(new) else np.zeros(0, dtype=np.int64)
        sizes = np.diff(np.append(new, len(own)))
        out.append((packed(np.diff(keys[own][new], prepend=0), "<u8"), packed(sums, "<u8"), packed(sizes, "<u4"), packed(doc[own], "<u4"), packed(times[own], "<u4")))
    return out


RUN = ("keys", "sums", "sizes", "docs", "times")
SINGLE = ("n_a", "n_b", "n_groups", "n_links")


def blocks(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES, radix: int = RADIX) -> DataFrame:
    """A row per block of texts: lists of each document's results so far, and the runs of its pairs, one per radix."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["block", "doc_id", *SINGLE, "groups_sha256", *RUN]
    schema = f"block bigint, doc_id array<{kind}>, " + ", ".join(f"{c} array<bigint>" for c in SINGLE) + ", groups_sha256 array<string>, " + ", ".join(f"{c} array<binary>" for c in RUN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, block = pair_of(a_path, b_path), TaskContext.get().partitionId() << 32
        for batch in batches:
            for chunk in chunks(batch.column("text"), block_bytes):
                sizes = np.diff(chunk.offsets)
                worded = np.flatnonzero(sizes)
                # A blank before each text.
                starts = chunk.offsets[worded] + np.arange(len(worded))
                data = np.insert(chunk.data, chunk.offsets[worded], 0x20)
                at, joins = segments(data, starts)
                if not pair.cuts:
                    at, joins = starts, np.zeros(len(starts), dtype=bool)
                bounds = np.append(at, len(data)).astype(np.int32)
                found = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
                which = np.asarray(found.indices).astype(np.int64)
                joined = np.ones(len(found.dictionary), dtype=bool)
                joined[which[~joins]] = False
                aligned = Aligned(pair, found.dictionary.to_pylist(), joined)
                owner = np.searchsorted(starts, at, side="right") - 1
                first = np.searchsorted(owner, np.arange(len(worded) + 1))
                bad = np.bincount(owner, ~aligned.good[which], len(worded)) > 0
                single = {c: np.zeros(chunk.n, dtype=np.int64) for c in SINGLE}
                for c in ("n_a", "n_b", "n_groups"):
                    single[c][worded] = np.where(bad, 0, np.bincount(owner, getattr(aligned, c)[which], len(worded)).astype(np.int64))
                single["n_links"] = single["n_groups"]  # tokens have bytes, so one of each side ends at a place
                digests = [""] * chunk.n
                for k, text in enumerate(worded.tolist()):
                    if not bad[k]:
                        digests[text] = hashlib.sha256(b";".join([aligned.spelled[s] for s in which[first[k] : first[k + 1]].tolist()])).hexdigest()
                kept = ~bad[owner]
                count = aligned.n_groups[which[kept]]
                place = np.arange(int(count.sum())) + np.repeat(aligned.first[which[kept]] - (np.cumsum(count) - count), count)
                parts = runs_of(aligned.codes[place], np.repeat(worded[owner[kept]], count), chunk.n, pair.a_size, radix)
                ids = batch.column("doc_id").slice(chunk.first, chunk.n)
                lists = [ids, *(pa.array(single[c]) for c in SINGLE), pa.array(digests, pa.string())]
                row = [pa.array([block], pa.int64()), *(pa.ListArray.from_arrays(pa.array([0, chunk.n], pa.int32()), x) for x in lists)]
                row += [pa.array([list(column)], pa.list_(pa.binary())) for column in zip(*parts)]
                yield pa.RecordBatch.from_arrays(row, names=names)
                block += 1

    return docs.mapInArrow(run, schema)


def merged(runs: list[Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """One sorted run of distinct keys and their sums, in pages, from sorted ``runs`` of pages.

    The heap has the last key of each run's page: up to the smallest of them all runs are read, so these keys are complete.
    """
    pages: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def load(k: int) -> None:
        page = next(runs[k], None)
        if page is None:
            pages.pop(k, None)
        else:
            pages[k] = page
            heapq.heappush(heap, (int(page[0][-1]), k))

    for k in range(len(runs)):
        load(k)
    while heap:
        last, parts = heap[0][0], []
        for k, (keys, sums) in pages.items():
            n = int(np.searchsorted(keys, last, side="right"))
            parts.append((keys[:n], sums[:n]))
            pages[k] = keys[n:], sums[n:]
        keys = np.concatenate([p[0] for p in parts])
        order = np.argsort(keys, kind="stable")
        keys, sums = keys[order], np.concatenate([p[1] for p in parts])[order]
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        yield keys[new], np.add.reduceat(sums, new)
        while heap and heap[0][0] <= last:
            load(heapq.heappop(heap)[1])


def _pages(keys: pa.Scalar, sums: pa.Scalar) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    key, total = np.cumsum(unpacked(keys, "<u8")), unpacked(sums, "<u8")
    for k in range(0, len(key), PAGE):
        yield key[k : k + PAGE], total[k : k + PAGE]


def pair_counts(found: DataFrame, n_blocks: int, a_size: int, fan: int = FAN) -> DataFrame:
    """One row per radix: ``keys``, ``sums`` and ``most`` (a pair has the largest sum of its second id), from all blocks."""

    def merge(group: pa.Table) -> pa.Table:
        pages = list(merged([_pages(k, s) for k, s in zip(group["keys"], group["sums"])]))
        keys, sums = (np.concatenate([np.zeros(0, dtype=np.int64), *(p[i] for p in pages)]) for i in (0, 1))
        # In this order an id's pairs are neighbours: its largest sum is known when they end.
        new = np.flatnonzero(np.diff(keys // a_size, prepend=-1))
        most = np.repeat(np.maximum.reduceat(sums, new), np.diff(np.append(new, len(keys)))) if len(new) else sums
        cells = [pa.array([packed(x, kind)]) for x, kind in ((np.diff(keys, prepend=0), "<u8"), (sums, "<u8"), (sums == most, "u1"))]
        return pa.table([group["radix"][:1], group["block"][:1], *cells], names=["radix", "block", "keys", "sums", "most"])

    runs = found.select("block", F.posexplode(F.arrays_zip("keys", "sums")).alias("radix", "run")).select("radix", "block", "run.keys", "run.sums")
    groups = n_blocks
    while True:
        groups = -(-groups // fan)
        runs = runs.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
        runs = runs.groupBy("radix", "group").applyInArrow(merge, "radix int, block bigint, keys binary, sums binary, most binary")
        if groups <= 1:
            return runs
        runs = written(runs, "merged").drop("most")


def aligned(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES, radix: int = RADIX, fan: int = FAN) -> DataFrame:
    """How the tokens of ``a_path`` and ``b_path`` meet in every row of ``docs``, with counts over all rows.

    ``doc_id``; ``n_a`` and ``n_b`` tokens; ``n_groups`` between places where tokens of both end; ``n_links`` pairs of tokens
    that end together; ``n_best`` of them whose count is the largest of their second id; ``count_sum`` of their counts; and
    ``groups_sha256`` of the groups' ids. Null and empty texts, and texts that a tokenizer's tokens do not spell (the piece
    model reads U+2581 as a blank), have no tokens: zeros and an empty digest; they count for nothing. Repeated rows and ids
    are rows of their own. Special tokens in a text are plain text. Other columns are ignored; no rows give no rows.
    """
    found = written(blocks(docs, a_path, b_path, block_bytes, radix), "blocks")
    a_size = pair_of(a_path, b_path).a_size
    counts = pair_counts(found, max(found.count(), 1), a_size, fan).select("keys", "sums", "most").toArrow()
    # Bounded by the bytes of the two vocabularies' tokens, see above.
    parts = [(np.cumsum(unpacked(k, "<u8")), unpacked(s, "<u8"), unpacked(m, "u1")) for k, s, m in zip(*(counts[c] for c in ("keys", "sums", "most")))]
    keys, sums, most = (np.concatenate([np.zeros(0, dtype=np.int64), *(p[i] for p in parts)]) for i in range(3))
    order = np.argsort(keys)
    keys, sums, most = keys[order], sums[order], most[order].astype(bool)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *SINGLE, "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cell = {c: batch.column(c)[row].values for c in batch.schema.names}
                n_best, count_sum = np.zeros((2, len(cell["doc_id"])), dtype=np.int64)
                for k in range(len(cell["keys"])):
                    key, size, doc, times = (unpacked(cell[c][k], kind) for c, kind in zip(("keys", "sizes", "docs", "times"), ("<u8", "<u4", "<u4", "<u4")))
                    at = np.searchsorted(keys, np.cumsum(key))
                    np.add.at(count_sum, doc, np.repeat(sums[at], size) * times)
                    np.add.at(n_best, doc, np.repeat(most[at], size) * times)
                out = [cell["doc_id"], *(cell[c] for c in SINGLE), pa.array(n_best), pa.array(count_sum), cell["groups_sha256"]]
                yield pa.RecordBatch.from_arrays(out, names=names)

    wanted = found.select("doc_id", *SINGLE, "groups_sha256", *(c for c in RUN if c != "sums"))
    return wanted.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in names[1:-1]) + ", groups_sha256 string")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level tokens against pieces in all documents."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
