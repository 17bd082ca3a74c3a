"""TF-IDF weights of character n-grams."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namesieve.functions.grams import (
    bag_words,
    count_batches,
    frequency_batches,
    gram_text,
    list_batches,
    listed_vectors,
    norm_batches,
    pack_batches,
    packed_vectors_of,
    padded_words,
    posting_batches,
    project_batches,
    weight_batches,
)
from namesieve.operators.ranking import one_row
from namesieve.plans.storage import written

#: Distinct grams whose frequencies go to every task (16 bytes each); of more, only those of the most frequent grams do.
HELD_GRAMS = 1 << 20
#: Beyond that a gram counts as frequent with more than this share of all rows (text, gram): there are at most so many.
FREQUENT_SHARE = 1 / 4096
#: Components of a dense vector made from a text.
PROJECTED = 256
VECTORS = "text_key string, codes array<bigint>, weights array<double>"


def vocabulary(variants: DataFrame, text: str = "name_variant") -> DataFrame:
    """Distinct non-null texts: ``text_key`` (md5) and ``variant``, hash-partitioned by the key.

    Texts can be long; the key stands for them wherever there is more than one row per text. The number of
    tasks is given: the texts are few bytes, but each becomes many gram rows.
    """
    texts = variants.where(f"{text} IS NOT NULL").selectExpr(f"md5({text}) AS text_key", f"{text} AS variant")
    tasks = int(variants.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.repartition(tasks, "text_key").groupBy("text_key").agg(F.first("variant").alias("variant"))


def gram_counts(texts: DataFrame) -> DataFrame:
    """One row per distinct text: ``text_key``, its distinct gram ``codes`` in order, and how often each occurs (``counts``).

    A text's grams are counted where the text is, in one sort per batch, so there are no rows of single grams to shuffle.
    """
    words = texts.selectExpr("text_key", f"{padded_words('variant')} AS words")
    return words.mapInArrow(count_batches, "text_key string, codes array<bigint>, counts array<int>")


def term_counts(texts: DataFrame) -> DataFrame:
    """How often each gram occurs in each distinct text: ``text_key, gram, tf``."""
    rows = gram_counts(texts).selectExpr("text_key", "inline(arrays_zip(codes, counts)) AS (code, tf)")
    return rows.selectExpr("text_key", f"{gram_text('code')} AS gram", "CAST(tf AS BIGINT) AS tf")


def code_frequencies(counts: DataFrame) -> DataFrame:
    """``code`` and ``df``, the number of texts with it, from ``gram_counts``."""
    return counts.selectExpr("explode(codes) AS code").groupBy("code").agg(F.count("*").alias("df"))


def document_frequencies(texts: DataFrame) -> DataFrame:
    """``gram`` and ``df``, the number of distinct texts that have it."""
    return code_frequencies(gram_counts(texts)).selectExpr(f"{gram_text('code')} AS gram", "df")


def packed_vectors(texts: DataFrame, held: int | None = None) -> DataFrame:
    """One row per text: ``text_key``, sorted gram codes and their unit-length weights.

    weight = tf * (ln((1 + texts) / (1 + df)) + 1), divided by the Euclidean norm of the text.

    Grams are counted once and written. Up to ``held`` distinct grams, all frequencies go to every task and nothing is
    shuffled. Beyond it those of the frequent grams do, whose number is bounded; the rows of the others, of which none has
    many, meet their frequencies in a join.
    """
    return _weighted(texts, held)[0]


def _weighted(texts: DataFrame, held: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The vectors and, if there are no more than ``held`` grams, all of them with their frequencies (``code, df``, written)."""
    held = HELD_GRAMS if held is None else held
    counts = written(gram_counts(texts), "gram-counts")
    total = counts.count()
    frequencies = written(code_frequencies(counts), "document-frequencies")
    if frequencies.count() <= held:
        return counts.mapInArrow(weight_batches(total, *_at_hand(frequencies)), VECTORS), frequencies
    return _joined_weights(counts, frequencies, total), None


def _joined_weights(counts: DataFrame, frequencies: DataFrame, total: int) -> DataFrame:
    """The vectors of ``counts`` if there are too many grams for all frequencies to go to every task."""
    rows = frequencies.agg(F.sum("df")).first()[0]
    often = frequencies.where(F.col("df") > rows * FREQUENT_SHARE)  # fewer than 1 / FREQUENT_SHARE
    rare = counts.selectExpr("text_key", "explode(codes) AS code").join(F.broadcast(often.select("code")), "code", "left_anti")
    others = rare.join(frequencies, "code").groupBy("text_key").agg(F.collect_list(F.struct("code", "df")).alias("others"))
    return counts.join(others, "text_key", "left").mapInArrow(weight_batches(total, *_at_hand(often)), VECTORS)


@dataclass(frozen=True)
class PackedGrams:
    """Grams of distinct texts by their bag of words, written. ``rows``: ``bag, grams, copies`` (packed grams, number of texts).

    ``rows`` has ``codes, weights`` instead of ``grams`` if there are more than ``HELD_GRAMS`` distinct grams. ``vectors`` gives the codes, weights and
    row numbers of an Arrow table with ``column`` in it.
    """

    rows: DataFrame
    columns: tuple[str, ...]
    vectors: Callable


def with_packed_grams(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``bag`` and ``grams`` instead of the column ``text``; equal bags have their grams once per batch.

    Grams are counted where the text is and leave as a byte or two each, so that no text and no list of numbers is shuffled.
    """
    kept = [f for f in rows.schema.fields if f.name != text]
    words, bag = bag_words(text)
    schema = T.StructType([*kept, T.StructField("bag", T.BinaryType()), T.StructField("grams", T.BinaryType())])
    return rows.selectExpr(*[f.name for f in kept], f"{bag} AS bag", f"{words} AS words").mapInArrow(pack_batches, schema)


def packed_grams(rows: DataFrame, held: int | None = None) -> PackedGrams:
    """Grams of the distinct texts of ``rows`` (``text_key, bag, grams``, written), whose document frequencies go by texts."""
    held = HELD_GRAMS if held is None else held
    copies = rows.groupBy("bag", "text_key").agg(F.expr("1 AS _one")).groupBy("bag").agg(F.expr("count(*) AS copies"))
    bags = rows.where("grams IS NOT NULL").groupBy("bag").agg(F.expr("first(grams) AS grams")).join(copies, "bag")
    bags = written(bags, "bags")
    total = bags.agg(F.expr("coalesce(sum(copies), 0)")).first()[0]
    frequencies = bags.select("grams", "copies").mapInArrow(frequency_batches, "code bigint, df bigint")
    frequencies = written(frequencies.groupBy("code").agg(F.expr("sum(df) AS df")), "document-frequencies")
    if frequencies.count() <= held:
        return PackedGrams(bags, ("grams",), packed_vectors_of(total, *_at_hand(frequencies)))
    counts = bags.selectExpr("hex(bag) AS text_key", "grams").mapInArrow(list_batches, "text_key string, codes array<bigint>, counts array<int>")
    vectors = _joined_weights(counts, frequencies, total).selectExpr("unhex(text_key) AS bag", "codes", "weights")
    return PackedGrams(written(vectors, "bag-vectors"), ("codes", "weights"), listed_vectors)


def _at_hand(frequencies: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = frequencies.toArrow()
    codes, df = np.asarray(table["code"]), np.asarray(table["df"])
    order = np.argsort(codes)
    return codes[order], df[order].astype(float)


def tfidf_weights(texts: DataFrame) -> DataFrame:
    """Long form of the vectors: ``text_key, gram, weight``. Up to ``HELD_GRAMS`` distinct grams, each is spelled once and looked up."""
    vectors, grams = _weighted(texts)
    rows = vectors.selectExpr("text_key", "inline(arrays_zip(codes, weights)) AS (code, weight)")
    if grams is not None:
        spelled = grams.selectExpr("code", f"{gram_text('code')} AS gram")
        return rows.join(F.broadcast(spelled), "code").select("text_key", "gram", "weight")  # at most HELD_GRAMS rows
    return rows.selectExpr("text_key", f"{gram_text('code')} AS gram", "weight")


def projected_vectors(texts: DataFrame, size: int = PROJECTED) -> DataFrame:
    """Dense vectors of the texts themselves: ``text_key, vector``, a signed random projection of the TF-IDF weights.

    Their cosine is that of the weights in expectation, with a deviation of about one by the root of ``size``. The projection
    is a hash of the grams, so there is no model to send; a text without grams has the zero vector.
    """
    return packed_vectors(texts).mapInArrow(project_batches(size), "text_key string, vector array<double>")


def tfidf_shape(texts: DataFrame) -> DataFrame:
    """Rows and columns of the text-by-gram matrix, and whether every text has a row."""
    counts = written(gram_counts(texts), "gram-counts")
    rows = one_row(counts.where("size(codes) > 0").agg(F.count("*").alias("n")))["n"]
    grams = one_row(code_frequencies(counts).agg(F.count("*").alias("n")))["n"]
    return counts.agg(F.count("*").alias("texts")).select(
        rows.alias("rows"), grams.alias("vocabulary_size"), (rows == F.col("texts")).alias("rows_match_texts")
    )


@dataclass(frozen=True)
class GramIndex:
    """Written tables for lookups of single texts.

    ``counts`` (``text_key, codes, counts``), ``frequencies`` (``code, df``) of ``total`` texts, ``norms`` (``text_key, norm``: the length of a text's
    weights) and ``postings`` (``code, text_key, tf``), made of segments, one or a few per task, each in the order of code and text.
    A weight is ``tf`` times a number that depends on the code only, divided by the norm, so that no weights are kept. A filter on codes
    reads only the pages of each segment that can have it. Nothing is shuffled for the index, and a file names each of its texts in its dictionary.
    """

    counts: DataFrame
    frequencies: DataFrame
    total: int
    norms: DataFrame
    postings: DataFrame


def gram_index(texts: DataFrame, held: int | None = None) -> GramIndex:
    """The index of all ``texts``, made once for any number of lookups."""
    held = HELD_GRAMS if held is None else held
    counts = written(gram_counts(texts), "gram-counts")
    total = counts.count()
    frequencies = written(code_frequencies(counts), "document-frequencies")
    if frequencies.count() <= held:
        norms = counts.mapInArrow(norm_batches(total, *_at_hand(frequencies)), "text_key string, norm double")
    else:
        # A text's first weight times its norm is what it was before.
        vectors = _joined_weights(counts, frequencies, total).selectExpr("text_key", "get(codes, 0) AS code", "get(weights, 0) AS weight")
        first = vectors.join(counts.selectExpr("text_key", "get(counts, 0) AS tf"), "text_key").join(frequencies, "code", "left")
        norms = first.selectExpr("text_key", f"coalesce(tf * (ln({1 + total}D / (1 + df)) + 1) / weight, 0D) AS norm")
    norms = written(norms, "text-vectors")
    # A frequent gram's postings are in every segment, and so many tasks.
    postings = counts.mapInArrow(posting_batches, "code bigint, text_key string, tf int")
    return GramIndex(counts, frequencies, total, norms, written(postings, "postings"))
