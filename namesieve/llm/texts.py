"""Whole texts of an Arrow batch as flat byte arrays, and per-word and per-segment hashes of them in NumPy.

A batch is worked through in chunks of a few megabytes (one longer text is a chunk of its own), so the memory of a
task is bounded by the longest text, not by the batch. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
MULT = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix): every input bit reaches every output bit. A new array."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * MULT)
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Chunk:
    """Texts ``first`` to ``first + n`` of a batch; text i is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def totals(self, flags: np.ndarray) -> np.ndarray:
        """Sum of ``flags`` (one per byte) for each text."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


def chunks(column: pa.Array | pa.ChunkedArray, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of ``column`` in order, in chunks of about ``size`` bytes."""
    done = 0
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        texts = part.cast(pa.large_string()).fill_null("")
        if not len(texts):
            continue
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
            j = min(j, len(texts))
            yield Chunk(done + i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            i = j
        done += len(texts)


def owners(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the text that holds each position."""
    return np.searchsorted(offsets, starts, side="right") - 1


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range; ranges are not empty, ordered and do not overlap."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    where = np.arange(int(lengths.sum()), dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    place = where - np.repeat(first, lengths)
    codes = BYTE_CODES[data[place + np.repeat(starts, lengths)]]
    # Odd multipliers by place: a product of two mixed numbers, so that order matters.
    codes *= powers(int(lengths.max()))[place]
    return mixed(np.add.reduceat(codes, first) + lengths.astype(np.uint64) * MULT)


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    return _POWERS


_POWERS = mixed(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def word_bounds(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of all texts; words do not cross texts."""
    solid = ~SPACES[chunk.data]
    edge = np.zeros(len(chunk.data) + 1, dtype=bool)
    edge[chunk.offsets] = True
    before = np.empty_like(solid)
    after = np.empty_like(solid)
    before[:1], before[1:] = False, solid[:-1]
    after[-1:], after[:-1] = False, solid[1:]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends


def windows(hashes: np.ndarray, text_of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words inside one text, and the index of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(text_of[:n] == text_of[size - 1 :])
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        total = total * MULT + hashes[at + k]
    return mixed(total), at
