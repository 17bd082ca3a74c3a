"""Best-fit packing with exact-complement hashing.

Only lengths decide what fits, so the plan needs no more than how many pieces there are of each length: at most as many
numbers as a sequence has tokens, counted over all pieces. Pair and triple sums of the available lengths are indexed by their
sum; a single length, pair or triple that fills the gap of the longest open length exactly is used as often as its counts
allow, and best fit takes the rest. Pieces then meet the plan by their rank within their length, which has two
levels (hash groups and ranks inside a group), so that a length shared by most pieces is still many tasks.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namesieve.plans.storage import written

LONGEST = 1024
END_ID = 2


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """An encoder with the vocabulary, merges and splitting pattern of the byte-level tokenizer file at ``path``.

    It gives the ids that ``tokenizers`` gives (``tests/llm`` compares them) about three times as fast. The file's added
    tokens are its special ones; those with options that ``tiktoken`` has not are refused.
    """
    import json

    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}
    for token in model["added_tokens"]:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"added token with options: {token}")
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def cut(n: int, longest: int) -> list[tuple[int, int]]:
    """Start and length of each piece of ``n`` ids: all of ``longest``, but that the first may be shorter."""
    head = n % longest
    ends = [*([head] if head else []), *range(head + longest, n + 1, longest)]
    return [(a, b - a) for a, b in zip([0, *ends], ends)]


def tokenized(docs: DataFrame, path: str, longest: int = LONGEST, end_id: int = END_ID, keep_ids: bool = False, encode_special_tokens: bool = True) -> DataFrame:
    """Pieces of every document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.

    A null text is an empty one: the end id alone. Repeated rows are packed each for itself. ``encode_special_tokens``
    is that of ``tokenizers``, which has it off: an added token in a text is spelled like any text instead of getting its id.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)
        allowed = set() if encode_special_tokens else "all"
        for batch in batches:
            rows, pieces, starts, lengths, sums, tokens = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                ids = np.append(encoder.encode_to_numpy(text.as_py() or "", allowed_special=allowed, disallowed_special=()), np.uint32(end_id)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), longest)):
                    part = ids[start : start + length]
                    rows.append(row)
                    pieces.append(k)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        tokens.append(part.astype(np.int32))
            out = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
            if keep_ids:
                out.append(pa.array(tokens, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(out)])

    return docs.mapInArrow(run, schema)


class Sums:
    """Index of the pair and triple sums of the available lengths, for sums below ``longest``.

    ``pairs[s]`` holds the larger lengths of the pairs that sum to ``s`` and ``triples[s]`` the lengths that leave a pair sum to
    ``s``, ascending. Counts only fall, so an entry that is used up is taken out when it is met, once. With d different
    lengths there are at most d * longest entries of each kind, however many pieces there are.
    """

    def __init__(self, have: list[int], longest: int):
        self.have = have
        lengths = [x for x in range(1, longest) if have[x]]
        self.pairs: dict[int, list[int]] = {}
        self.triples: dict[int, list[int]] = {}
        for high in lengths:
            for low in lengths[: bisect.bisect_right(lengths, min(high, longest - 1 - high))]:
                self.pairs.setdefault(high + low, []).append(high)
        sums = sorted(self.pairs)
        for x in lengths:
            for two in sums[: bisect.bisect_right(sums, longest - 1 - x)]:
                self.triples.setdefault(x + two, []).append(x)

    def pair(self, total: int) -> tuple[int, int] | None:
        """Two available lengths with this sum, the larger as large as can be."""
        entries = self.pairs.get(total, [])
        while entries:
            high, low = entries[-1], total - entries[-1]
            if self.have[high] and self.have[low] and (high != low or self.have[high] > 1):
                return high, low
            entries.pop()
        return None

    def triple(self, total: int) -> tuple[int, int, int] | None:
        """Three available lengths with this sum, the largest as large as can be."""
        entries = self.triples.get(total, [])
        while entries:
            x = entries[-1]
            if self.have[x]:
                rest = total - x
                for high in reversed(self.pairs[rest] if self.pair(rest) else ()):
                    needs = (x, high, rest - high)
                    if all(self.have[y] >= needs.count(y) for y in needs):
                        return needs
            entries.pop()
        return None

    def complement(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that sum to ``gap``; fewer and larger ones first."""
        return (gap,) if self.have[gap] else self.pair(gap) or self.triple(gap)


def _use(have: list[int], used: tuple[int, ...]) -> int:
    """Takes ``used`` off the counts as often as they allow; how often that is."""
    times = min(have[x] // used.count(x) for x in set(used))
    for x in used:
        have[x] -= times
    return times


def exact(have: list[int], longest: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of up to four lengths that fill sequences without a gap, taken off the counts in ``have``.

    Lengths are filled from the longest on, each by complements from the index until there is none. A combination was seen
    at its longest member, so none of up to four lengths is left that would fill a sequence.
    """
    out = [((longest,), have[longest])] if have[longest] else []
    have[longest] = 0
    sums = Sums(have, longest)
    for length in range(longest - 1, 0, -1):
        while have[length]:
            have[length] -= 1  # the one to be filled is not its own partner
            found = sums.complement(longest - length)
            have[length] += 1
            if found is None:
                break
            used = (length, *found)
            out.append((used, _use(have, used)))
    return out


def best_fit(have: list[int], longest: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns for all that is left: each sequence takes the longest length that goes in, again and again."""
    out = []
    left = [x for x in range(1, longest + 1) if have[x]]
    while left:
        used, room = [], longest
        while (at := bisect.bisect_right(left, room)) and (fits := [x for x in left[:at] if have[x] > used.count(x)]):
            used.append(fits[-1])
            room -= fits[-1]
        out.append((tuple(used), _use(have, tuple(used))))
        left = [x for x in left if have[x]]
    return out


def plan(counts: dict[int, int], longest: int = LONGEST) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence) and how many sequences have each; together they use every count.

    Exact complements first, as often as the counts allow; what none fits is best fit, many like sequences at a time.
    """
    have = [counts.get(x, 0) for x in range(longest + 1)]
    return exact(have, longest) + best_fit(have, longest)


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, in the order in which its pieces are dealt out: first rank, first sequence and place of each slot."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for used, times in patterns:
        place = 0
        for length in used:
            slots.setdefault(length, []).append((taken.get(length, 0), first, place))
            taken[length] = taken.get(length, 0) + times
            place += length
        first += times
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*rows)) for length, rows in slots.items()}


def assigned(pieces: DataFrame, longest: int = LONGEST, group_rows: int = 20_000) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``longest`` each) with ``sequence_id`` and ``offset``; of these, input columns are replaced.

    Every row is placed once, rows of equal length in any order. An empty table gives none. ``pieces`` is read three times
    and must be the same each time: pass a written table. The driver gets a count per length, and one per ``group_rows`` rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    counts = {int(r["length"]): r["count"] for r in pieces.groupBy("length").count().collect()}
    split = F.element_at(F.array(*(F.lit(max(1, -(-counts.get(x, 0) // group_rows))) for x in range(1, longest + 1))), F.col("length").cast("int"))
    marked = pieces.withColumn("__group", F.pmod(F.xxhash64(*names), split).cast("long"))
    before: dict[int, dict[int, int]] = {}
    done: dict[int, int] = {}
    for r in sorted(marked.groupBy("length", "__group").count().collect()):
        before.setdefault(r["length"], {})[r["__group"]] = done.get(r["length"], 0)
        done[r["length"]] = done.get(r["length"], 0) + r["count"]
    slots = _slots(plan(counts, longest))
    ranked = marked.withColumn("__rank", F.row_number().over(Window.partitionBy("length", "__group").orderBy(*names)).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, group, rank = (np.asarray(batch.column(c)) for c in ("length", "__group", "__rank"))
            sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
            for x in np.unique(length):
                rows = np.flatnonzero(length == x)
                start, first, place = slots[int(x)]
                at = rank[rows] - 1 + np.array([before[int(x)][int(g)] for g in group[rows]], dtype=np.int64)
                slot = np.searchsorted(start, at, side="right") - 1
                sequence[rows], offset[rows] = first[slot] + at - start[slot], place[slot]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def pack(docs: DataFrame, path: str | None = None, longest: int = LONGEST, keep_ids: bool = False, encode_special_tokens: bool = True) -> DataFrame:
    """All documents as pieces in sequences of at most ``longest`` tokens; ``keep_ids`` adds the token ids of each piece.

    ``encode_special_tokens`` as in ``tokenized``; the query and the pipeline have it off, as a tokenizer has when loaded.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = written(tokenized(docs, path, longest, keep_ids=keep_ids, encode_special_tokens=encode_special_tokens), "pieces")
    return assigned(pieces, longest)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the table, packed."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), encode_special_tokens=False)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage of the pipeline: what is left, packed."""
    return pack(docs.select("doc_id", "text"), encode_special_tokens=False)
