"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

Byte n-grams of two to four inside words are hashed into ``buckets``; a text is the mean of their embeddings. Embeddings
and the softmax are trained together by stochastic gradient descent in NumPy on a bounded sample of labelled rows. As both
are linear, scoring needs only their product, one small table of a logit per bucket and language, and a mean per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namesieve.llm.texts import Chunk, chunks

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
SIZES = (2, 3, 4)
UNKNOWN = "und"
#: Lower-case ASCII letters and all bytes of longer characters stay; everything else is a word boundary.
_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


@dataclass
class LanguageModel:
    """``logits[bucket, language]``; ``heat`` scales the mean logit; scores under ``floor`` are rejected."""

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    heat: float
    floor: float


def grams(chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the bucket of the n-gram at each byte, and which of them count.

    Blanks only stand at either end of an n-gram, and texts are not crossed. Up to four bytes are one 32-bit number, so
    the numbers of one size are those of the last, shifted.
    """
    folded = _FOLD[chunk.data]
    solid = folded != 0x20
    left = np.repeat(chunk.offsets[1:], np.diff(chunk.offsets)) - np.arange(len(folded))
    wide = folded.astype(np.uint32)
    key, inner = wide, np.ones(len(folded), dtype=bool)
    for size in SIZES:
        n = len(folded) - size + 1
        if n <= 0:
            return
        key = (key[:n] << np.uint32(8)) | wide[size - 1 :]
        inner = inner[:n] & (solid[size - 2 : size - 2 + n] if size > 2 else True)
        ok = inner & (left[:n] >= size) & (solid[:n] | solid[size - 1 :])
        yield ((key + np.uint32(size)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS), ok


def mean_logits(chunk: Chunk, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Mean logit of each text and the number of its n-grams."""
    n, k = chunk.n, len(model.languages)
    total, seen = np.zeros((n, k)), np.zeros(n, dtype=np.int64)
    table = np.vstack([model.logits, np.zeros((1, k), dtype=np.float32)])
    for bucket, ok in grams(chunk):
        bucket = np.where(ok, bucket, BUCKETS)
        filled = np.flatnonzero(chunk.offsets[:-1] < np.minimum(chunk.offsets[1:], len(bucket)))
        if len(filled):
            total[filled] += np.add.reduceat(table[bucket], chunk.offsets[filled], axis=0, dtype=np.float64)
            seen += chunk.totals(np.append(ok, np.zeros(len(chunk.data) - len(ok), dtype=bool)))
    return total / np.maximum(seen, 1)[:, None] + model.bias, seen


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each sampled text: its n-gram counts as a whole, and of three short passages of it."""
    for batch in batches:
        ids, counts, langs, draws = [], [], [], []
        for chunk in chunks(batch.column("text"), 1):  # one text at a time
            row = chunk.first
            lang, draw = batch.column("lang")[row].as_py(), batch.column("draw")[row].as_py()
            size, rng = len(chunk.data), np.random.default_rng(draw)
            parts = [(0, size)] + [((s := int(rng.integers(0, max(1, size - w)))), min(size, s + w)) for w in (30, 80, 250) if size > w]
            for a, b in parts:
                part = Chunk(0, chunk.data[a:b], np.array([0, b - a]))
                found = [bucket[ok] for bucket, ok in grams(part)]
                bucket, count = np.unique(np.concatenate(found) if found else np.zeros(0, dtype=np.int64), return_counts=True)
                if len(bucket):
                    ids.append(bucket.astype("<u2").tobytes())
                    counts.append(count.astype("<u4").tobytes())
                    langs.append(lang)
                    draws.append(draw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.binary()), pa.array(counts, pa.binary()), pa.array(langs, pa.string()), pa.array(draws, pa.int64())],
            names=["ids", "counts", "lang", "draw"],
        )


def train(examples: list, languages: list[str], dim: int = 16, steps: int = 1000, rate: float = 2.0, seed: int = 7) -> LanguageModel:
    """Fit on four fifths of the sampled texts; calibrate and set the floor on the rest.

    The floor is the highest score, at most 0.4, under which no more than one in a thousand rightly named calibration
    texts falls; so rejection is rare where training texts look like the corpus.
    """
    rng = np.random.default_rng(seed)
    code = {x: i for i, x in enumerate(languages)}
    ids = [np.frombuffer(e["ids"], dtype="<u2").astype(np.int64) for e in examples]
    parts = [np.frombuffer(e["counts"], dtype="<u4").astype(np.float64) for e in examples]
    parts = [(p / p.sum()).astype(np.float32) for p in parts]
    y = np.array([code[e["lang"]] for e in examples])
    held = np.array([e["draw"] % 5 == 0 for e in examples])
    fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(y))
    k = len(languages)
    table = rng.normal(0, 0.1, (BUCKETS, dim)).astype(np.float32)
    weight = rng.normal(0, 0.1, (dim, k)).astype(np.float32)
    bias = np.zeros(k, dtype=np.float32)
    done = 0
    while done < steps:
        for rows in np.array_split(rng.permutation(fit), -(-len(fit) // 32)):
            if done == steps:
                break
            lr, done = rate * (1 - done / steps) + 0.02, done + 1
            sizes = [len(ids[r]) for r in rows]
            flat, share = np.concatenate([ids[r] for r in rows]), np.concatenate([parts[r] for r in rows])
            mean = np.add.reduceat(table[flat] * share[:, None], np.cumsum([0, *sizes[:-1]]), axis=0)
            slope = softmax(mean @ weight + bias)
            slope[np.arange(len(rows)), y[rows]] -= 1
            back = slope @ weight.T
            weight -= lr / len(rows) * (mean.T @ slope)
            bias -= 0.1 * lr / len(rows) * slope.sum(axis=0)
            np.add.at(table, flat, -lr * share[:, None] * np.repeat(back, sizes, axis=0))
    logits = (table @ weight).astype(np.float32)
    test = np.flatnonzero(held) if held.any() else fit
    raw = np.array([parts[r] @ logits[ids[r]] + bias for r in test])
    heats = np.geomspace(0.2, 5, 41)
    loss = [-np.log(np.maximum(softmax(raw * h)[np.arange(len(test)), y[test]], 1e-12)).mean() for h in heats]
    heat = float(heats[int(np.argmin(loss))])
    chance = softmax(raw * heat)
    right = chance.max(axis=1)[chance.argmax(axis=1) == y[test]]
    floor = float(min(0.4, np.quantile(right, 0.001))) if len(right) else 0.0
    return LanguageModel(languages, logits, bias, heat, floor)


def fit_languages(labelled: DataFrame, per_language: int = 500) -> LanguageModel | None:
    """Train on at most about ``per_language`` texts of each language (twice that at the very most), drawn by a hash of id and text.

    ``labelled`` has ``doc_id``, ``text`` and ``lang``; rows without a label or a letter take no part. The whole text of each
    drawn row is used, as counts of at most ``BUCKETS`` buckets. None if no row is left.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    names = sorted(sizes)
    odds = F.element_at(F.create_map(*(F.lit(x) for n in names for x in (n, min(1.0, per_language / sizes[n])))), F.col("lang"))
    draw = F.xxhash64(F.lit("language"), "doc_id", "text").bitwiseAND((1 << 53) - 1)
    drawn = rows.withColumn("draw", draw).where(F.col("draw") < odds * F.lit(float(1 << 53))).select("text", "lang", "draw").limit(2 * per_language * len(names))
    examples = drawn.mapInArrow(_examples, "ids binary, counts binary, lang string, draw bigint").collect()
    if not examples:
        return None
    return train(sorted(examples, key=lambda e: (e["draw"], e["lang"], len(e["ids"]))), names)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """The language of every whole text: the columns of ``docs`` and ``lang_pred``, ``score``, ``rejected``.

    Input columns of these names are replaced. Null texts and texts without a letter get ``und``, score 0 and are rejected;
    so does everything if there is no model. ``rejected`` also marks texts scored under the model's floor, whose
    ``lang_pred`` still names the likeliest language. Rows are judged one by one: repeated rows alike, empty tables to none.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    kept = docs.columns
    docs = docs.withColumn("__worded", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = T.StructType([*docs.schema.fields[: len(kept)], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            worded = np.asarray(batch.column("__worded").to_pylist(), dtype=bool)
            names, scores = np.full(batch.num_rows, UNKNOWN, dtype=object), np.zeros(batch.num_rows)
            for chunk in chunks(batch.column("text")) if model else ():
                raw, seen = mean_logits(chunk, model)
                chance = softmax(raw * model.heat)
                names[chunk.first : chunk.first + chunk.n] = np.array(model.languages, dtype=object)[chance.argmax(axis=1)]
                scores[chunk.first : chunk.first + chunk.n] = np.where(seen > 0, chance.max(axis=1), 1 / len(model.languages))
            names[~worded], scores[~worded] = UNKNOWN, 0.0
            out = ~worded | (scores < (model.floor if model else 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(names, pa.string()), pa.array(scores), pa.array(out)], names=[*kept, "lang_pred", "score", "rejected"])

    return docs.mapInArrow(run, schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn on the documents outside the held-out quarter, predict for all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = fit_languages(docs.where(part != 2))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay, labelled with it; rejected ones go. Learns from the labels that there are.

    If nothing can be learned, as no row has a label, all texts with a letter stay, those without a label as ``und``.
    """
    model = fit_languages(docs.select("doc_id", "text", "lang"))
    if model is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).withColumn("lang", F.coalesce("lang", F.lit(UNKNOWN)))
    found = identify(docs, model)
    return found.where(~F.col("rejected")).withColumn("lang", F.col("lang_pred")).select(*docs.columns)
