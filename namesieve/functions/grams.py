"""Character n-grams inside word bounds: the words as a Spark SQL expression, the grams of Arrow batches in NumPy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from namesieve.functions.names import tokens

LONGEST_GRAM = 3
#: Any code point fits in so many bits.
CODE_BITS = 21
#: Characters that are worked on at a time; one longer text is worked on alone.
CHUNK_CHARS = 1 << 20
BLANK = 0x20
#: Bits of a character in a packed gram if all are ASCII; bytes from which a packed row is deflated.
ASCII_BITS, DEFLATED = 7, 128
#: Postings that are sorted at a time, and handed on at a time.
RUN_GRAMS, OUT_ROWS = 1 << 22, 1 << 16
#: Modulus and factor of the hash of gram codes; products stay below 2^62, so SQL gives the same numbers.
PROJECTION = ((1 << 31) - 1, 1_103_515_245)


def padded_words(text: str) -> str:
    """The lower-cased words of ``text`` with a blank on both sides of each, in one text: two blanks are where words meet."""
    return f"coalesce(concat(' ', nullif(array_join({tokens(f'lower({text})')}, '  '), ''), ' '), '')"


def gram_text(code: str) -> str:
    """SQL of the text of a gram code: its characters in order, absent ones left out."""
    points = [f"(shiftrightunsigned({code}, {CODE_BITS * (LONGEST_GRAM - 1 - i)}) & {(1 << CODE_BITS) - 1})" for i in range(LONGEST_GRAM)]
    digits = ", ".join(f"if({p} = 0, '', lpad(hex({p}), 8, '0'))" for p in points)
    return f"decode(unhex(concat({digits})), 'UTF-32')"


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, code and number of every distinct gram of one to three characters of texts of padded words, by text and code.

    A gram lies inside one word and its blanks. The code has the code points of its characters, ``CODE_BITS`` each, which
    needs no dictionary.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    alphabet, place = np.unique(points, return_inverse=True)
    base, place = len(alphabet) + 1, place + 1
    if not len(points):
        return (np.zeros(0, dtype=np.int64),) * 3
    together = (owner[1:] == owner[:-1]) & ~((points[1:] == BLANK) & (points[:-1] == BLANK))
    two = np.flatnonzero(together)
    three = two[:-1][np.diff(two) == 1]
    at = owner * base + place
    keys = np.concatenate([at * base * base, (at[two] * base + place[two + 1]) * base, (at[three] * base + place[three + 1]) * base + place[three + 2]])
    keys, counts = np.unique(keys, return_counts=True)
    letters = np.append(0, alphabet)
    digits = [letters[keys // base**i % base] for i in (2, 1, 0)]
    codes = (digits[0] << 2 * CODE_BITS) | (digits[1] << CODE_BITS) | digits[2]
    return keys // base**LONGEST_GRAM, codes, counts


def _list(rows: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text_key, words`` (padded) to ``text_key, codes, counts``, a row per text."""
    for batch in batches:
        ends = np.cumsum(pc.utf8_length(batch.column("words")).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + CHUNK_CHARS, side="right")))
            rows, codes, counts = gram_counts(batch.column("words").slice(first, last - first).to_pylist())
            lists = [_list(rows, pa.array(x, kind), last - first) for x, kind in ((codes, pa.int64()), (counts, pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column("text_key").slice(first, last - first), *lists], names=["text_key", "codes", "counts"])
            first = last


def bag_words(text: str) -> tuple[str, str]:
    """SQL of the ``padded_words`` of a text and of the key (16 bytes) of its bag of words.

    Grams do not cross words, so texts of the same words in any order have the same grams.
    """
    words = tokens(f"lower({text})")
    return padded_words(text), f"unhex(md5(array_join(sort_array({words}), ' ')))"


def _fold(codes: np.ndarray, bits: int) -> np.ndarray:
    """Codes with ``CODE_BITS`` per character as codes with ``bits`` per character; the order stays."""
    mask = (1 << CODE_BITS) - 1
    return sum((codes >> CODE_BITS * i & mask) << bits * i for i in range(LONGEST_GRAM))


def _unfold(codes: np.ndarray, bits: int) -> np.ndarray:
    return sum((codes >> bits * i & (1 << bits) - 1) << CODE_BITS * i for i in range(LONGEST_GRAM))


def pack_grams(rows: np.ndarray, codes: np.ndarray, counts: np.ndarray, n: int) -> list[bytes]:
    """Each row's sorted codes and their counts in about two bytes a gram or fewer.

    The first byte tells the bits per character and whether the rest is deflated; the rest has the differences of the codes, then
    the counts, seven bits a byte, lowest first, with the high bit on all but a number's last byte.
    """
    ascii = not len(codes) or not np.any(codes & sum(((1 << CODE_BITS) - (1 << ASCII_BITS)) << CODE_BITS * i for i in range(LONGEST_GRAM)))
    folded = _fold(codes, ASCII_BITS) if ascii else codes
    size = np.bincount(rows, minlength=n)
    start = np.cumsum(size) - size
    steps = np.diff(folded, prepend=0)
    steps[start[size > 0]] = folded[start[size > 0]]
    place = np.arange(len(codes))
    numbers = np.zeros(2 * len(codes), dtype=np.int64)
    numbers[place + start[rows]] = steps
    numbers[place + start[rows] + size[rows]] = counts
    width = np.ones(len(numbers), dtype=np.int64)
    for bits in range(7, 63, 7):
        width += numbers >> bits > 0
    ends = np.append(0, np.cumsum(width))
    out = np.zeros(ends[-1], dtype=np.uint8)
    for i in range(int(width.max(initial=0))):
        has = np.flatnonzero(width > i)
        out[ends[has] + i] = (numbers[has] >> 7 * i & 127) | ((width[has] > i + 1) << 7)
    cuts, raw = ends[np.append(0, 2 * np.cumsum(size))].tolist(), out.tobytes()
    packed = []
    for first, last in zip(cuts, cuts[1:]):
        part = raw[first:last]
        packed.append(bytes([ascii * 2 + 1]) + zlib.compress(part, 6, -15) if last - first >= DEFLATED else bytes([ascii * 2]) + part)
    return packed


def unpack_grams(packed: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, counts and rows of what ``pack_grams`` made."""
    parts = [zlib.decompress(p[1:], -15) if p[0] & 1 else p[1:] for p in packed]
    raw = np.frombuffer(b"".join(parts), dtype=np.uint8)
    if not len(raw):
        return (np.zeros(0, dtype=np.int64),) * 3
    last = raw < 128
    starts = np.flatnonzero(np.append(True, last[:-1]))
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    numbers = np.add.reduceat((raw & 127).astype(np.int64) << 7 * place, starts)
    ends = np.append(0, np.cumsum(last))[np.cumsum([len(p) for p in parts])]
    size = np.diff(ends, prepend=0) // 2
    row = np.repeat(np.arange(len(parts)), size)
    start = np.cumsum(size) - size
    place = np.arange(len(row))
    steps, counts = numbers[place + start[row]], numbers[place + start[row] + size[row]]
    sums = np.cumsum(steps)
    codes = sums - np.append(0, sums)[start][row]
    ascii = np.array([p[0] >= 2 for p in packed])[row]
    return np.where(ascii, _unfold(codes, ASCII_BITS), codes), counts, row


def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace ``words`` (padded) by the packed ``grams``, given once for each ``bag`` of a batch; others have null."""
    for batch in batches:
        first = np.unique(batch.column("bag").dictionary_encode().indices.to_numpy(), return_index=True)[1]
        words = batch.column("words").take(pa.array(np.sort(first))).to_pylist()
        ends = np.cumsum([len(w) for w in words])
        packed: list[bytes] = []
        while len(packed) < len(words):
            done = ends[len(packed) - 1] if packed else 0
            some = words[len(packed) : max(len(packed) + 1, int(np.searchsorted(ends, done + CHUNK_CHARS, side="right")))]
            packed += pack_grams(*gram_counts(some), len(some))
        at = np.full(batch.num_rows, -1)
        at[np.sort(first)] = np.arange(len(first))
        grams = pa.array(packed, pa.binary()).take(pa.array(at, mask=at < 0))
        kept = [c for c in batch.schema.names if c != "words"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], grams], names=[*kept, "grams"])


def frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``grams`` (packed) and the ``copies`` that a row stands for to ``code, df``: a row per gram of a batch."""
    for batch in batches:
        codes, _, row = unpack_grams(batch.column("grams").to_pylist())
        known, place = np.unique(codes, return_inverse=True)
        df = np.bincount(place, batch.column("copies").to_numpy()[row], len(known)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(known, pa.int64()), pa.array(df)], names=["code", "df"])


def list_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text_key, grams`` (packed) to ``text_key, codes, counts``."""
    for batch in batches:
        codes, counts, row = unpack_grams(batch.column("grams").to_pylist())
        lists = [_list(row, pa.array(x, kind), batch.num_rows) for x, kind in ((codes, pa.int64()), (counts, pa.int32()))]
        yield pa.RecordBatch.from_arrays([batch.column("text_key"), *lists], names=["text_key", "codes", "counts"])


def listed_vectors(tile: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, weights and rows of the lists ``codes, weights``; a null list is empty."""
    codes = tile["codes"].combine_chunks()
    sizes = np.asarray(codes.value_lengths().fill_null(0))
    values = codes.flatten().to_numpy(zero_copy_only=False), tile["weights"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return *values, np.repeat(np.arange(len(sizes)), sizes)


def packed_vectors_of(texts: int, known: np.ndarray, frequencies: np.ndarray):
    """Function from rows with packed ``grams`` (or null) to codes, weights of unit length, and rows. ``known`` has all codes, sorted."""

    def run(tile: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, counts, row = unpack_grams([p or b"\0" for p in tile["grams"].to_pylist()])
        if not len(codes):
            return codes, np.zeros(0), row
        weight = counts * (np.log((1 + texts) / (1 + frequencies[np.searchsorted(known, codes)])) + 1)
        return codes, weight / np.sqrt(np.bincount(row, weight * weight, len(tile)))[row], row

    return run


def flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists of a batch and the row that each belongs to."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)


def weight_batches(texts: int, known: np.ndarray, frequencies: np.ndarray):
    """Function from ``text_key, codes, counts`` and, if there, ``others`` to ``text_key, codes, weights`` of unit length.

    weight = count * (ln((1 + texts) / (1 + df)) + 1). ``known`` codes are sorted and have their ``frequencies``; a row brings
    those of its other codes as pairs (code, df).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, row = flat(batch.column("codes"))
            df = np.zeros(len(codes))
            if len(known):
                at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                df = np.where(known[at] == codes, frequencies[at], 0)
            if "others" in batch.schema.names:
                pairs, other_row = flat_pairs(batch.column("others"))
                # Both sides are in the order of row and code once sorted; every code left is in both.
                left = np.flatnonzero(df == 0)
                order = np.lexsort((pairs[0], other_row))
                df[left] = pairs[1][order]
            weight = batch.column("counts").flatten().to_numpy() * (np.log((1 + texts) / (1 + df)) + 1)
            norm = np.sqrt(np.bincount(row, weight * weight, batch.num_rows))
            weights = pa.ListArray.from_arrays(batch.column("codes").offsets, pa.array(weight / norm[row])) if len(codes) else pa.array([[]] * batch.num_rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), batch.column("codes"), weights], names=["text_key", "codes", "weights"])

    return run


def norm_batches(texts: int, known: np.ndarray, frequencies: np.ndarray):
    """Function from ``text_key, codes, counts`` to ``text_key, norm``, the length of the weights of ``weight_batches``; ``known`` has all codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, row = flat(batch.column("codes"))
            weight = np.zeros(0)
            if len(codes):
                weight = batch.column("counts").flatten().to_numpy() * (np.log((1 + texts) / (1 + frequencies[np.searchsorted(known, codes)])) + 1)
            norm = np.sqrt(np.bincount(row, weight * weight, batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), pa.array(norm)], names=["text_key", "norm"])

    return run


def posting_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text_key, codes, counts`` to ``code, text_key, tf``: runs of about ``RUN_GRAMS`` rows in the order of code and text."""
    names = ["code", "text_key", "tf"]

    def run(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.Table.from_batches(held).sort_by("text_key").combine_chunks()
        keys, tf = texts["text_key"].combine_chunks(), texts["counts"].combine_chunks().flatten()
        codes, row = flat(texts["codes"].combine_chunks())
        order = np.argsort(codes, kind="stable")
        for first in range(0, len(order), OUT_ROWS):
            some = order[first : first + OUT_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(codes[some], pa.int64()), keys.take(pa.array(row[some])), tf.take(pa.array(some))], names=names)

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column("codes").flatten())
        if size >= RUN_GRAMS:
            yield from run(held)
            held, size = [], 0
    if held:
        yield from run(held)


def project_batches(size: int):
    """Function from ``text_key, codes, weights`` to ``text_key, vector``: a gram's weight is added to, or taken from, one of ``size`` components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, row = flat(batch.column("codes"))
            spread = codes % PROJECTION[0] * PROJECTION[1] % PROJECTION[0]
            signed = np.where(spread // size % 2 == 0, 1.0, -1.0) * batch.column("weights").flatten().to_numpy()
            vectors = np.bincount(row * size + spread % size, signed, batch.num_rows * size).astype(float)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * size), pa.array(vectors))
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), lists], names=["text_key", "vector"])

    return run


def flat_pairs(column: pa.ListArray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Both fields of all pairs of a list column, and the row of each; null lists are empty."""
    sizes = np.asarray(column.value_lengths().fill_null(0))
    pairs = column.flatten()
    return tuple(np.asarray(x) for x in pairs.flatten()), np.repeat(np.arange(len(column)), sizes)
