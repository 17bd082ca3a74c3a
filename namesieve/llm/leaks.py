"""Benchmark passages in documents, found by winnowing.

Texts become words. Of every ``span`` successive runs of ``grams`` words that with the smallest hash is kept as a fingerprint
(all of them, if several are smallest), so two texts that share ``grams + span - 1`` words share a fingerprint inside them.
Fingerprints of both sides are joined and each hit is extended word by word, in both directions; what is then at least as
long as a window is an occurrence of it. A window lies at most ``window - grams`` words beyond the fingerprint in it, so that
many words on both sides travel with a fingerprint, not its text.

A filter of bounded size, made of the benchmark's fingerprints, keeps others from leaving their task; it only spares work:
beyond its size more fingerprints get through to the join. A fingerprint that very many documents have meets the benchmark
in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namesieve.llm.texts import LOWER, Chunk, chunks, owners, segment_hashes, windows
from namesieve.plans.storage import written

WINDOW = 10
#: Bits of the filter for each fingerprint, and the most bits it may have (16 MB).
FILTER_SHARE, FILTER_BITS = 16, 1 << 27
#: A fingerprint with more than this share of all document hits is split into parts; there can be only so many such ones.
HOT_SHARE, PARTS = 1 / 256, 64

#: Word characters: digits, a to z after A-Z are lower-cased, and all that is not ASCII.
SOLID = np.zeros(256, dtype=bool)
SOLID[0x30:0x3A] = SOLID[0x41:0x5B] = SOLID[0x61:0x7B] = SOLID[0x80:] = True

HIT = "size int, key bigint, at bigint, first bigint, words string"


def scheme(length: int) -> tuple[int, int]:
    """Words of a gram and grams of a span, so that any ``length`` shared words hold a shared fingerprint."""
    grams = (length + 1) // 2
    return grams, length - grams + 1


def bounds(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts; words do not cross texts."""
    edge = np.zeros(len(chunk.data) + 1, dtype=bool)
    edge[chunk.offsets] = True
    solid = np.concatenate([[False], SOLID[chunk.data], [False]])
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    return starts, ends


def winnowed(keys: np.ndarray, span: int) -> np.ndarray:
    """Which ``keys`` are the smallest of some ``span`` successive ones."""
    n = len(keys) - span + 1
    if n <= 0:
        return np.zeros(len(keys), dtype=bool)
    least = keys[:n].copy()
    for k in range(1, span):
        np.minimum(least, keys[k : k + n], out=least)
    # A key is some span's smallest if the largest of the minima around it is the key itself.
    around = np.concatenate([np.zeros(span - 1, dtype=keys.dtype), least, np.zeros(span - 1, dtype=keys.dtype)])
    most = around[: len(keys)].copy()
    for k in range(1, span):
        np.maximum(most, around[k : k + len(keys)], out=most)
    return keys == most


class Filter:
    """A bit for the leading bits of each key, in cells of 32."""

    def __init__(self, bits: int, cells: np.ndarray) -> None:
        self.shift, self.cells = np.uint64(64 - bits), cells

    def passes(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.cells[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0


def hits(chunk: Chunk, sizes: list[int], only: Filter | None = None, exact: bool = False) -> tuple[np.ndarray, list[tuple[int, int, int, int, int, str]]]:
    """Number of words of each text, and (text, size, key, place, first, words) of each fingerprint that passes the filter.

    ``place`` and ``first`` count words of the text: where the gram starts and where ``words`` start. ``exact`` is for
    benchmark items: those of fewer words than the longest size have fingerprints of their own size only.
    """
    data = LOWER[chunk.data]
    starts, ends = bounds(chunk)
    text_of = owners(starts, chunk.offsets)
    hashes = segment_hashes(data, starts, ends)
    n_words = np.bincount(text_of, minlength=chunk.n)
    base = np.cumsum(n_words) - n_words
    raw, found = None, []
    for size in sizes:
        grams, span = scheme(size)
        keys, at = windows(hashes, text_of, grams)
        keep = winnowed(keys, span)
        if exact:
            own = n_words[text_of[at]]
            keep &= (own == size) if size < max(sizes) else (own >= size)
        keep &= n_words[text_of[at]] >= size
        if only is not None and len(keys):
            chosen = np.flatnonzero(keep)
            keep = chosen[only.passes(keys[chosen])]
        else:
            keep = np.flatnonzero(keep)
        for key, word in zip(keys[keep].view(np.int64).tolist(), at[keep].tolist()):
            text = int(text_of[word])
            first = max(word - (size - grams), int(base[text]))
            last = min(word + size, int(base[text] + n_words[text]))
            if raw is None:
                raw = data.tobytes()
            words = b" ".join([raw[starts[i] : ends[i]] for i in range(first, last)]).decode()
            found.append((text, size, key, word - int(base[text]), first - int(base[text]), words))
    return n_words, found


def fingerprinted(rows: DataFrame, sizes: list[int], only: Filter | None = None, exact: bool = False) -> DataFrame:
    """``row``, ``id``, ``n_words`` and ``hits`` of every row of ``rows`` (``row``, ``id``, ``text``)."""
    kind = rows.schema["id"].dataType.simpleString()
    hit = pa.struct([("size", pa.int32()), ("key", pa.int64()), ("at", pa.int64()), ("first", pa.int64()), ("words", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                n_words, found = hits(chunk, sizes, only, exact)
                lists: list[list[dict]] = [[] for _ in range(chunk.n)]
                for text, size, key, at, first, words in found:
                    lists[text].append({"size": size, "key": key, "at": at, "first": first, "words": words})
                part = slice(chunk.first, chunk.first + chunk.n)
                cells = [batch.column("row")[part], batch.column("id")[part], pa.array(n_words, pa.int64()), pa.array(lists, pa.list_(hit))]
                yield pa.RecordBatch.from_arrays(cells, names=["row", "id", "n_words", "hits"])

    return rows.select("row", "id", "text").mapInArrow(run, f"row bigint, id {kind}, n_words bigint, hits array<struct<{HIT.replace(' ', ':').replace(',:', ',')}>>")


def _numbered(df: DataFrame, id_column: str) -> DataFrame:
    return df.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col("text").cast("string").alias("text"))


def _filter(keys: DataFrame) -> Filter:
    """The filter of the distinct ``key``; its cells, at most ``FILTER_BITS`` / 32, come to the driver."""
    n = keys.count()
    bits = min(max(16, (FILTER_SHARE * n).bit_length()), FILTER_BITS.bit_length() - 1)
    at = F.expr(f"shiftrightunsigned(key, {64 - bits})")
    cells = keys.select(F.shiftright(at, 5).alias("cell"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - bits}) & 31 as int))").alias("bit"))
    rows = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 5), dtype=np.uint32)
    table[np.asarray(rows["cell"])] = np.asarray(rows["bits"]).astype(np.uint32)
    return Filter(bits, table)


def extension(words: list[str], at: int, other: list[str], place: int) -> tuple[int, int]:
    """How many words before ``at``, and from it on, are those before ``place`` and from it on."""
    before = 0
    while before < at and before < place and words[at - before - 1] == other[place - before - 1]:
        before += 1
    after = 0
    while at + after < len(words) and place + after < len(other) and words[at + after] == other[place + after]:
        after += 1
    return before, after


def _occurrences(pairs: DataFrame) -> DataFrame:
    """``row``, ``item``, ``start`` and ``stop`` (words of the document) of the extended ``pairs`` that are long enough."""
    kind = pairs.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.to_pydict()
            kept, starts, stops = [], [], []
            for k, size in enumerate(cells["size"]):
                at, place = cells["at"][k] - cells["first"][k], cells["item_at"][k] - cells["item_first"][k]
                before, after = extension(cells["words"][k].split(" "), at, cells["item_words"][k].split(" "), place)
                # The run must hold the whole gram: an equal hash of other words ends here.
                if before + after >= size and after >= scheme(size)[0]:
                    kept.append(k)
                    starts.append(cells["at"][k] - before)
                    stops.append(cells["at"][k] + after)
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row").take(at), batch.column("item").take(at), pa.array(starts, pa.int64()), pa.array(stops, pa.int64())], names=["row", "item", "start", "stop"])

    return pairs.mapInArrow(run, f"row bigint, item {kind}, start bigint, stop bigint")


def _parted(found: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``part``: of hot keys the documents' hits are dealt into parts and the items' ones are in each part."""
    total = found.count()
    often = found.groupBy("size", "key").agg(F.count("*").alias("n")).where(F.col("n") > max(1000, int(total * HOT_SHARE)))
    # At most 1 / HOT_SHARE rows by construction.
    hot = F.broadcast(written(often.select("size", "key", F.lit(True).alias("hot")), "hot"))
    part: Column = F.when(F.col("hot"), F.pmod(F.xxhash64("row", "at"), F.lit(PARTS))).otherwise(0)
    dealt = found.join(hot, ["size", "key"], "left").withColumn("part", part.cast("int")).drop("hot")
    last = F.when(F.col("hot"), PARTS - 1).otherwise(0)
    copied = items.join(hot, ["size", "key"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), last))).drop("hot")
    return dealt, copied


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` and ``items`` of every row of ``docs``.

    Words are runs of digits, a-z (A-Z count as them) and all that is not ASCII. A benchmark item's windows are its runs of
    ``window`` words, or the whole item if it has fewer; a document's word is hit if it is in an occurrence of a window.
    ``items`` are the sorted ids, as text, of the items that have one. Null and empty texts have no words: nothing is hit,
    and an item without words has no window. Repeated rows of ``docs``, null ids and ids with several texts are judged row by
    row; repeated items count once, and the words of an item without an id are hit but it is in no list. Other columns are
    ignored.
    """
    items = _numbered(benchmark, "item_id")
    listed = written(fingerprinted(items, list(range(1, window + 1)), exact=True), "item-fingerprints")
    items = listed.select("row", F.col("id").alias("item"), F.inline("hits"))
    items = items.select("item", "size", "key", F.col("at").alias("item_at"), F.col("first").alias("item_first"), F.col("words").alias("item_words")).distinct()
    sizes = sorted(r[0] for r in listed.select(F.least("n_words", F.lit(window)).alias("size")).where("size > 0").distinct().collect())
    only = _filter(items.select("key").distinct())
    signed = written(fingerprinted(_numbered(docs, "doc_id"), sizes, only), "document-fingerprints")
    found = signed.where(F.size("hits") > 0).select("row", F.inline("hits"))
    dealt, copied = _parted(found, items)
    pairs = dealt.join(copied, ["size", "key", "part"]).select("row", "item", "size", "at", "first", "words", "item_at", "item_first", "item_words")
    spans = _occurrences(pairs).distinct()
    # A document's spans are no more than its words; each of its rows is one task's small group.
    joined = spans.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"), F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, s: F.struct(F.greatest(acc.upto, s.stop).alias("upto"), (acc.n + F.greatest(F.lit(0), s.stop - F.greatest(s.start, acc.upto))).alias("n")),
        lambda acc: acc.n,
    )
    joined = joined.select("row", covered.alias("n_hit"), "items")
    out = signed.select("row", F.col("id").alias("doc_id"), "n_words").join(joined, "row", "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), ids.alias("items"))


def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in all documents."""
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs, benchmark).drop("items")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
grams AS (
  SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM d, (SELECT DISTINCT size FROM wins) AS s, unnest(range(1, len(w) - size + 2)) AS t(i)),
found AS (SELECT r, i, grams.size AS size, item_id FROM grams JOIN wins ON grams.size = wins.size AND grams.words = wins.words),
words_hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + size)) AS u(j) GROUP BY r),
items_hit AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words_hit USING (r) LEFT JOIN items_hit USING (r)
"""
