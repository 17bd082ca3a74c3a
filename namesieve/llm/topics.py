"""Topics learned from the corpus: clusters of hashed word counts.

The words of a text are counted into a few signed slots by their hash; the root of each count, scaled to unit length, is the
text's profile, of one byte a slot. Texts of few words have none. Less the mean profile of all texts, which is what every text has in common, profiles are
clustered by direction (spherical k-means). Every text counts in every round; the driver gets the sums of each cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namesieve.llm.texts import LOWER, chunks, owners, segment_hashes, word_bounds

SLOTS, TOPICS, ROUNDS = 64, 12, 8
#: Profiles among which the first centres are chosen: the least hash of each of so many groups.
CANDIDATES, RESTARTS = 256, 16
#: A text of fewer words shows no topic: its profile is that of its few words.
LEAST_WORDS = 20
NO_TOPIC = "none"
#: Digits of a centre. The order of sums changes the last ones, and a text's topic should not depend on it.
DIGITS = 9


def _profiles(texts: pa.Array) -> pa.Array:
    out = []
    for chunk in chunks(texts):
        data = LOWER[chunk.data]
        starts, ends = word_bounds(chunk)
        text_of = owners(starts, chunk.offsets)
        word = segment_hashes(data, starts, ends)
        slot = text_of * SLOTS + (word % np.uint64(SLOTS)).astype(np.int64)
        counts = np.bincount(slot, np.where(word >> np.uint64(63), 1.0, -1.0), chunk.n * SLOTS).reshape(-1, SLOTS)
        root = np.sign(counts) * np.sqrt(np.abs(counts))
        norm = np.sqrt((root * root).sum(axis=1, keepdims=True))
        small = np.rint(127 * root / np.maximum(norm, 1e-300)).astype(np.int8)
        enough = (np.bincount(text_of, minlength=chunk.n) >= LEAST_WORDS) & (norm[:, 0] > 0)
        out += [row.tobytes() if some else None for row, some in zip(small, enough)]
    return pa.array(out, pa.binary())


def profile(text: Column) -> Column:
    """Profile of a text, ``SLOTS`` signed bytes; null where it has fewer than ``LEAST_WORDS`` words, or only such as cancel each other out."""
    return F.arrow_udf(_profiles, "binary")(text)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int8).reshape(-1, SLOTS).astype(float) / 127


def _directions(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    y = x - mean
    return y / np.maximum(np.sqrt((y * y).sum(axis=1, keepdims=True)), 1e-300)


@dataclass(frozen=True)
class Topics:
    """``centres`` are unit vectors, a row per topic, of profiles less ``mean``."""

    mean: np.ndarray
    centres: np.ndarray

    def numbers(self, x: np.ndarray) -> np.ndarray:
        """The topic of each profile: the centre of the largest cosine, the first of several."""
        return np.argmax(np.round(_directions(x, self.mean) @ self.centres.T, DIGITS), axis=1)

    def name(self, column: Column) -> Column:
        """Topic of a profile column as text; ``NO_TOPIC`` where it is null or nothing was learned."""

        def label(cells: pa.Array) -> pa.Array:
            out = np.full(len(cells), NO_TOPIC, dtype=object)
            some = np.asarray(cells.is_valid())
            if len(self.centres) and some.any():
                out[some] = [f"topic_{k:02d}" for k in self.numbers(_matrix(cells.drop_null()))]
            return pa.array(out, pa.string())

        return F.arrow_udf(label, "string")(column)


def _sums(profiles: DataFrame, groups: int, member: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sum and, last, number of the vectors of each group. ``member`` gives group and vector of each profile.

    A task gives one row per group and component, so the shuffle does not grow with the texts.
    """
    width = SLOTS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((groups, width))
        for batch in batches:
            if batch.num_rows:
                group, vectors = member(_matrix(batch.column("profile")))
                onto = np.zeros((groups, len(group)))
                onto[group, np.arange(len(group))] = 1.0
                total += onto @ np.hstack([vectors, np.ones((len(group), 1))])
        live = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(live.astype(np.int32)), pa.array(total.ravel()[live])], names=["at", "x"])

    rows = profiles.mapInArrow(run, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(groups * width)
    out[[r["at"] for r in rows]] = [r["x"] for r in rows]
    return out.reshape(groups, width)


def _moved(centres: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The directions of the sums; a centre without any stays."""
    norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
    return np.round(np.where(norm > 1e-9, sums / np.maximum(norm, 1e-300), centres), DIGITS)


def _first(candidates: np.ndarray, topics: int) -> np.ndarray:
    """Start of the rounds: the best of some clusterings of the candidates, each from other ones of them."""
    best, most = candidates[:0], -np.inf
    for restart in range(RESTARTS):
        centres = candidates[np.random.default_rng(restart).permutation(len(candidates))[:topics]]
        for _ in range(ROUNDS):
            cosine = np.round(candidates @ centres.T, DIGITS)
            at = cosine.argmax(axis=1)
            centres = _moved(centres, (at == np.arange(len(centres))[:, None]).astype(float) @ candidates)
        close = round(float(np.max(candidates @ centres.T, axis=1).sum()), 6)
        if close > most:
            best, most = centres, close
    return best


def learn(docs: DataFrame, topics: int = TOPICS, rounds: int = ROUNDS) -> Topics:
    """Topics of the column ``profile`` of all ``docs``; fewer than ``topics`` where there are fewer different profiles.

    The result does not depend on order or partitions. Null profiles do not count; without any there are no topics. Write
    ``docs`` first: they are read ``rounds`` + 2 times. A topic that loses all texts keeps its centre.
    """
    profiles = docs.select("profile").where("profile IS NOT NULL")
    total = _sums(profiles, 1, lambda x: (np.zeros(len(x), dtype=np.int64), x))[0]
    if not total[-1]:
        return Topics(np.zeros(SLOTS), np.zeros((0, SLOTS)))
    mean = np.round(total[:-1] / total[-1], DIGITS)
    key = F.xxhash64("profile")
    # Copies have one hash, so a group of copies is one candidate however large it is.
    least = profiles.groupBy(F.pmod(key, F.lit(CANDIDATES)).alias("g")).agg(F.min(F.struct(key.alias("h"), "profile")).alias("m"))
    found = [r["profile"] for r in least.select("m.*").orderBy("h", "profile").collect()]
    model = Topics(mean, _first(_directions(_matrix(pa.array(found, pa.binary())), mean), topics))
    for _ in range(rounds):
        sums = _sums(profiles, len(model.centres), lambda x, m=model: (m.numbers(x), _directions(x, m.mean)))[:, :-1]
        centres = _moved(model.centres, sums)
        same = np.array_equal(centres, model.centres)
        model = Topics(mean, centres)
        if same:
            break
    return model
