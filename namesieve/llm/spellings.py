"""Spelling variants: words that one inserted, deleted or replaced character turns into a far more frequent one.

The vocabulary is composed with a transducer that makes one edit and with the vocabulary again. A path of the composition
reads equal characters until the edit and equal ones after it, so an initial state is a stretch of positions that holds the
edit together with all that stands outside of it: words of one length that agree before and after the stretch. These
partitions come from halving: the edit is in one half of the word, and the other half is the same in both words. A
partition with many words is halved again, until its stretch is one character, where only an alphabet of words can differ.

Inside a partition the middles of its words become minimised acceptors, one for each of the two lengths that an edit can
connect, with one register of states. Pairs are enumerated from the states upwards as ranks of words, and each state or
pair of states is worked out once. The edit of a path is where the two words first differ, so a pair has one path, in one
partition. A task returns for each word the number of its near words and the best one, never pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namesieve.llm.texts import LOWER, Chunk, chunks, owners
from namesieve.plans.storage import written

SHORTEST, FEWEST, TIMES = 6, 5, 5
#: One run in so many, by its hash, has a character deleted.
DAMAGED = 199
#: Words of a partition, and characters of its stretch, beyond which it is halved.
CROWD, STRETCH = 4096, 64
#: Distinct words that a task holds before it hands on their counts.
HELD = 500_000

LETTER = np.zeros(256, dtype=bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True
#: U+00C0 to U+00FF are this byte and any one continuation byte.
LEAD = 0xC3


def crc_table() -> np.ndarray:
    """Remainders of all bytes for the reflected polynomial of CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


CRC = crc_table()


def runs(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (bytes) and lengths (characters) of the maximal runs of letters of all texts."""
    after_lead = np.zeros(len(chunk.data) + 1, dtype=bool)
    after_lead[1:] = chunk.data == LEAD
    inside = LETTER[chunk.data] | after_lead[1:] | after_lead[:-1]
    edge = np.zeros(len(chunk.data) + 1, dtype=bool)
    edge[chunk.offsets] = True
    inside = np.concatenate([[False], inside, [False]])
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    leads = np.cumsum(after_lead)
    return starts, ends, (ends - starts) - (leads[ends] - leads[starts])


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range, carried on from the checksum ``before`` it."""
    sizes = ends - starts
    out = np.empty(len(starts), dtype=np.uint32)
    order = np.argsort(-sizes, kind="stable")
    longer = int(np.searchsorted(-sizes[order], -STRETCH, side="left"))
    for k in order[:longer].tolist():
        out[k] = zlib.crc32(data[starts[k] : ends[k]].tobytes(), int(before[k]))
    order = order[longer:]
    state, at, left = ~before[order], starts[order], sizes[order]
    for k in range(int(left.max(initial=0))):
        n = int(np.searchsorted(-left, -k, side="left"))  # those that have a byte at k
        state[:n] = CRC[(state[:n] ^ data[at[:n] + k]) & np.uint32(0xFF)] ^ (state[:n] >> np.uint32(8))
    out[order] = ~state
    return out


def spelled(chunk: Chunk, ids: list[str | None], shortest: int = SHORTEST) -> pa.Array:
    """The lower-cased runs of all texts, one character deleted in those whose hash says so, if long enough."""
    starts, ends, length = runs(chunk)
    long = length >= shortest
    starts, ends, length = starts[long], ends[long], length[long]
    data = LOWER[chunk.data]
    prefixes = np.array([zlib.crc32(f"{x or ''}:".encode()) for x in ids], dtype=np.uint32)
    sums = checksums(data, starts, ends, prefixes[owners(starts, chunk.offsets)])
    damaged = sums % DAMAGED == 0
    words = []
    for k in np.flatnonzero(damaged & (length > shortest)).tolist():
        word, place = data[starts[k] : ends[k]].tobytes().decode(), int(sums[k]) % int(length[k])
        words.append(word[:place] + word[place + 1 :])
    starts, ends = starts[~damaged], ends[~damaged]
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    whole = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[np.cumsum(inside[:-1], dtype=np.int8) > 0]))
    return pa.concat_arrays([whole, pa.array(words, pa.string())])


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """``word`` and ``n`` of all words that are long and frequent enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def summed() -> pa.RecordBatch:
            table = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            return pa.RecordBatch.from_arrays([table["word"].combine_chunks(), table["n_sum"].combine_chunks()], names=["word", "n"])

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for chunk in chunks(batch.column("text")):
                found = pc.value_counts(spelled(chunk, ids[chunk.first : chunk.first + chunk.n], shortest))
                held.append(pa.table([found.field("values"), found.field("counts")], names=["word", "n"]))
                rows += len(found)
                if rows > HELD:
                    one = summed()
                    if one.num_rows > HELD // 2:
                        yield one
                        held, rows = [], 0
                    else:
                        held, rows = [pa.Table.from_batches([one])], one.num_rows
        if held:
            yield summed()

    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= fewest)


class Composition:
    """Minimised acceptors of words of one length each, and pairs of their words that are one edit apart.

    A state is the tuple of its (character, state) transitions, and equal ones are one state. A word's rank is its place among
    the sorted words of its acceptor. ``after`` is the character that follows all words, if any does.
    """

    def __init__(self, after: str) -> None:
        self.after = after
        self.register: dict[tuple, int] = {(): 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]  # character -> (state, words of the state before it)
        self.size = [1]
        self.same: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.changed: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.grown: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def acceptor(self, words: list[str]) -> int:
        """Initial state for ``words``, which are sorted, distinct, of one length, and at least one."""
        length = len(words[0])
        open_: list[list[tuple[str, int]]] = [[] for _ in range(length + 1)]  # transitions of the states on the last path
        path = ""
        for word in [*words, None]:
            shared = 0
            if word is not None:
                while shared < len(path) and word[shared] == path[shared]:
                    shared += 1
            for depth in range(length, shared, -1):
                if path:
                    open_[depth - 1].append((path[depth - 1], self._state(open_[depth])))
                open_[depth] = []
            path = word or ""
        return self._state(open_[0])

    def _state(self, moves: list[tuple[str, int]]) -> int:
        key = tuple(moves)
        known = self.register.get(key)
        if known is None:
            known = self.register[key] = len(self.moves)
            places, before = {}, 0
            for character, target in moves:
                places[character] = (target, before)
                before += self.size[target]
            self.moves.append(places)
            self.size.append(before)
        return known

    @staticmethod
    def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        if not parts:
            return NONE
        return parts[0] if len(parts) == 1 else (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    def equal(self, s: int, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranks in ``s`` and in ``t`` of the words that both accept."""
        if s == t:
            every = np.arange(self.size[s])
            return every, every
        known = self.same.get((s, t))
        if known is None:
            known = self.same[s, t] = self._equal(s, t, "")
        return known

    def _equal(self, s: int, t: int, but: str) -> tuple[np.ndarray, np.ndarray]:
        parts, other = [], self.moves[t]
        for character, (a, i) in self.moves[s].items():
            if character in other and character != but:
                b, j = other[character]
                x, y = self.equal(a, b)
                if len(x):
                    parts.append((x + i, y + j))
        return self._joined(parts)

    def replaced(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs of words of ``s`` that differ in one character."""
        known = self.changed.get(s)
        if known is None:
            moves, parts = list(self.moves[s].values()), []
            for k, (a, i) in enumerate(moves):
                x, y = self.replaced(a)
                if len(x):
                    parts.append((x + i, y + i))
                for b, j in moves[:k]:
                    x, y = self.equal(a, b)
                    if len(x):
                        parts.append((x + i, y + j))
            known = self.changed[s] = self._joined(parts)
        return known

    def inserted(self, s: int, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of words of ``s`` and of words of ``t`` that have one character more, at the first place where they differ."""
        known = self.grown.get((s, t))
        if known is None:
            parts, own = [], self.moves[s]
            for character, (b, j) in self.moves[t].items():
                if character in own:
                    a, i = own[character]
                    x, y = self.inserted(a, b)
                    if len(x):
                        parts.append((x + i, y + j))
                if own:
                    x, y = self._equal(s, b, character)
                else:
                    # The shorter word ends: what follows both must differ from the character as well.
                    x, y = NONE if character == self.after else self.equal(s, b)
                if len(x):
                    parts.append((x, y + j))
            known = self.grown[s, t] = self._joined(parts)
        return known


NONE = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))


def near_pairs(long: list[str], short: list[str], after: str) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in ``long`` followed by ``short`` of words one edit apart, one of them in ``long`` at least.

    Both are sorted and distinct; words of ``long`` have one length, those of ``short`` one character less.
    """
    if not long:
        return NONE
    both = Composition(after)
    top = both.acceptor(long)
    x, y = both.replaced(top)
    if short:
        s, t = both.inserted(both.acceptor(short), top)
        x, y = np.concatenate([x, s + len(long)]), np.concatenate([y, t])
    return x, y


def _cell(word: Column, size: Column, low: Column, high: Column) -> Column:
    """Names a partition: a length, a stretch, and what stands before and after it, which is the same in all its words."""
    ends = F.concat_ws("/", word.substr(F.lit(1), low), word.substr(F.char_length(word) - (size - high) + 1, size - high))
    return F.concat_ws(".", size, low, high, F.md5(ends))


def _halves(cells: DataFrame) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    stretch = F.explode(F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high").alias("high")))).alias("stretch")
    out = cells.select("word", "n", "size", stretch).select("word", "n", "size", "stretch.low", "stretch.high")
    return out.withColumn("cell", _cell(F.col("word"), F.col("size"), F.col("low"), F.col("high")))


def partitions(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``words`` in every partition that they belong to: ``word``, ``n``, ``size``, ``low``, ``high`` and ``cell``.

    ``size`` is the length of the longer words in a partition; shorter ones have one character less.
    """
    length = F.char_length("word")
    cells = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("size"), F.lit(0).alias("low"))
    cells, done = _halves(cells.withColumn("high", F.col("size"))), None
    while True:
        crowded = cells.groupBy("cell").agg(F.count("*").alias("words"), F.first(F.col("high") - F.col("low")).alias("wide"))
        crowded = written(crowded.where((F.col("wide") > STRETCH) | (F.col("words") > crowd) & (F.col("wide") > 1)).select("cell"), "crowded")
        if crowded.isEmpty():
            return cells if done is None else done.unionByName(cells)
        calm = cells.join(crowded, "cell", "left_anti")
        done = calm if done is None else done.unionByName(calm)
        cells = written(_halves(cells.join(crowded, "cell", "left_semi")), "halves")


def neighbours(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (``rank``, minus the largest ``n`` of its near words, and that ``word``)."""
    cells = partitions(words, crowd).select("cell", "word", "n", "size", "low", "high")
    cells = cells.repartition("cell").sortWithinPartitions("cell", "word")

    def near(group: pa.Table) -> pa.Table | None:
        size, low, high = (group[c][0].as_py() for c in ("size", "low", "high"))
        all_words, counts = group["word"].to_pylist(), np.asarray(group["n"])
        long = [k for k, w in enumerate(all_words) if len(w) == size]
        short = [k for k, w in enumerate(all_words) if len(w) != size]
        first = all_words[0]
        after = first[len(first) - (size - high)] if size > high else ""
        cut = lambda k: all_words[k][low : len(all_words[k]) - (size - high)]
        x, y = near_pairs([cut(k) for k in long], [cut(k) for k in short], after)
        if not len(x):
            return None
        place = np.array(long + short)
        x, y = place[np.concatenate([x, y])], place[np.concatenate([y, x])]
        rank = np.empty(len(counts), dtype=np.int64)  # words come sorted, so ties go to the smaller one
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
        best = np.full(len(counts), len(counts))
        np.minimum.at(best, x, rank[y])
        n_near = np.bincount(x, minlength=len(counts))
        at = np.flatnonzero(n_near)
        chosen = pa.array(np.argsort(rank)[best[at]])
        return pa.table([group["word"].take(pa.array(at)), pa.array(n_near[at]), pa.array(-counts[np.asarray(chosen)]), group["word"].take(chosen)], names=["word", "n_near", "rank", "form"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def grouped(table: pa.Table, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
            found = [x for i, j in zip(ends[:-1], ends[1:]) if j - i > 1 and (x := near(table.slice(i, j - i))) is not None]
            if found:
                yield from pa.concat_tables(found).combine_chunks().to_batches()

        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (table if rest is None else pa.concat_tables([rest, table])).combine_chunks()
            if not len(table):
                continue
            cell = table["cell"].combine_chunks()
            ends = np.concatenate([[0], np.flatnonzero(np.asarray(pc.not_equal(cell[1:], cell[:-1]))) + 1])
            rest = table.slice(int(ends[-1]))
            yield from grouped(table, ends)
        if rest is not None:
            yield from grouped(rest, np.array([0, len(rest)]))

    found = cells.mapInArrow(run, "word string, n_near bigint, rank bigint, form string")
    best = F.min(F.struct("rank", F.col("form").alias("word"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain of ``forms`` (``word``, ``form``), for every word with a form.

    Each round follows twice as many forms as the one before it. A form's count is a multiple of its word's, so chains end
    after as many steps as the largest count has digits, about.
    """
    ends = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = written(ends.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        ends = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return ends


def variants(docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST, times: int = TIMES, crowd: int = CROWD) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word of the vocabulary of ``docs``.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of at least ``shortest`` characters and
    ``fewest`` occurrences; a run whose checksum with its ``doc_id`` is a multiple of 199 loses a character first. Near words
    differ by one edit. The form is the most frequent near word (ties: the smallest), if it has ``times`` the occurrences;
    the root is the end of the chain of forms. Null and empty texts have no words, a null id counts as an empty one, repeated
    rows count as often as they occur, other columns are ignored, and without documents there are no words.
    """
    words = written(vocabulary(docs, shortest, fewest), "vocabulary")
    found = written(neighbours(words, crowd), "near")
    form_n = -F.col("best.rank")
    forms = words.join(found, "word").where(form_n >= times * F.col("n"))
    forms = written(forms.select("word", F.col("best.word").alias("form"), form_n.alias("form_n")), "forms")
    out = words.join(found.select("word", "n_near"), "word", "left").join(forms, "word", "left").join(roots(forms), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants in all documents."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Near words in SQL: equal after one deletion on either side, or after replacing one place by a mark.
OP11_SQL = """
WITH RECURSIVE codes AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
runs AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{C0}-\\x{FF}]+')) AS w FROM documents),
each_run AS (SELECT coalesce(id, '') AS id, w, count(*) AS k FROM runs WHERE length(w) >= 6 GROUP BY ALL),
bytes AS (
  SELECT id, w, k, flatten(list_transform(string_split(id || ':' || w, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [195, ord(c) - 64] END)) AS b FROM each_run),
summed AS (
  SELECT w, k, xor(list_reduce(list_concat([4294967295], list_transform(b, lambda x: CAST(x AS BIGINT))), lambda s, x: xor(t[(xor(s, x) & 255) + 1], s >> 8)), 4294967295) AS h
  FROM bytes, codes),
spelled AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) AS INT) + 2) ELSE w END AS word, k FROM summed),
vocab AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM vocab),
gaps AS (SELECT DISTINCT word, n, substr(word, 1, p - 1) || substr(word, p + 1) AS gap FROM places),
marks AS (SELECT word, n, substr(word, 1, p - 1) || '.' || substr(word, p + 1) AS mark FROM places),
pairs AS (
  SELECT g.word AS word, v.word AS near, v.n AS n FROM gaps AS g JOIN vocab AS v ON g.gap = v.word
  UNION SELECT v.word, g.word, g.n FROM gaps AS g JOIN vocab AS v ON g.gap = v.word
  UNION SELECT a.word, b.word, b.n FROM marks AS a JOIN marks AS b ON a.mark = b.mark AND a.word <> b.word),
ranked AS (SELECT word, near, n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS r FROM pairs),
formed AS (
  SELECT v.word AS word, v.n AS n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 5 * v.n THEN r.near END AS form, CASE WHEN r.n >= 5 * v.n THEN r.n END AS form_n
  FROM vocab AS v LEFT JOIN ranked AS r ON v.word = r.word AND r.r = 1),
chains AS (
  SELECT word, word AS here, 0 AS step FROM formed
  UNION ALL SELECT c.word, f.form, c.step + 1 FROM chains AS c JOIN formed AS f ON c.here = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(here, step) AS root FROM chains GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""
