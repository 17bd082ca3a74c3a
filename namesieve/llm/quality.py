"""Quality by weak supervision: rules vote or abstain, expectation-maximisation learns how far each can be trusted.

Every text gets a vote of each rule: good, bad or none. The votes are one of at most 3^rules patterns, so all that
expectation-maximisation needs from the corpus is how many texts show each pattern: one small, bounded table, counted
over all texts. The posterior of good given the pattern then replaces the rule that all filters must pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namesieve.llm.texts import SPACES, Chunk, chunks, mixed, owners, segment_hashes, windows, word_bounds
from namesieve.plans.storage import written

SYMBOLS = b"#*$%&|<>"
#: rule -> (column, bad below, bad above, good from, good to). Outside both ranges the rule abstains; one without a good
#: range never votes good, as the absence of junk says little.
RULES = {
    "length": ("n_words", 20, None, 60, None),
    "distinct": ("distinct_share", 1.0, None, 1.5, None),
    "letters": ("letter_share", 0.75, None, 0.9, None),
    "symbols": ("symbols_per_word", None, 0.1, None, None),
    "exclaims": ("exclaim_share", None, 0.2, None, None),
    "capitals": ("capital_share", None, 0.5, None, None),
    "repeats": ("repeat_share", None, 0.4, None, None),
    "dup_lines": ("dup_line_share", None, 0.5, None, None),
    "word_length": ("mean_word", 2.0, 13.0, None, None),
}
#: Believed rates of bad and good votes on good and on bad texts, of rules that vote both ways and of those that only vote bad.
TWO_SIDED, BAD_ONLY = ((0.03, 0.9), (0.4, 0.5)), ((0.005, 0.0), (0.3, 0.0))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters", "n_exclaims", "n_distinct"]
STATS = "doc_id {id}, " + ", ".join(f"{c} bigint" for c in COUNTS)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOL, _EXCLAIM = _table(SYMBOLS), _table(b"!")
_CAPITAL = _table(bytes(range(0x41, 0x5B)))
_LETTER = _CAPITAL | _table(bytes(range(0x61, 0x7B))) | _table(bytes(range(0xC2, 0xF5)))
_TAIL = _table(bytes(range(0x80, 0xC0)))


def _repeats(keys: np.ndarray, at: np.ndarray, text_of: np.ndarray, size: int) -> np.ndarray:
    """Which words lie in a window that its text holds twice or more."""
    salted = mixed(keys + mixed(text_of[at].astype(np.uint64)))
    order = np.argsort(salted, kind="stable")
    same = salted[order][1:] == salted[order][:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(text_of), dtype=bool)
    for k in range(size):
        covered[at[twice] + k] = True
    return covered


def _distinct(hashes: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, text_of))
    t, h = text_of[order], hashes[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    return np.bincount(t[new], minlength=n)


def measure(chunk: Chunk) -> dict[str, np.ndarray]:
    """The columns ``COUNTS`` for every text of ``chunk``."""
    data, n = chunk.data, chunk.n
    starts, ends = word_bounds(chunk)
    text_of = owners(starts, chunk.offsets)
    hashes = segment_hashes(data, starts, ends)
    keys, at = windows(hashes, text_of, 3)
    covered = _repeats(keys, at, text_of, 3)
    solid = ~SPACES[data]
    heads = ~_TAIL[data]
    # Lines: cut at \n and at the ends of texts; empty ones hold no word.
    cut = np.unique(np.concatenate([chunk.offsets[:-1], np.flatnonzero(data == 0x0A) + 1]))
    cut = cut[cut < len(data)]
    stop = np.append(cut[1:], len(data)) if len(cut) else cut
    stop = stop - (data[stop - 1] == 0x0A) if len(cut) else stop
    sums = np.concatenate([[0], np.cumsum(solid, dtype=np.int64)])
    worded = sums[stop] > sums[cut]
    cut, stop = cut[worded], stop[worded]
    line_of = owners(cut, chunk.offsets)
    n_lines = np.bincount(line_of, minlength=n)
    distinct_lines = _distinct(segment_hashes(data, cut, stop), line_of, n)
    return {
        "n_words": np.bincount(text_of, minlength=n),
        "word_chars": chunk.totals(solid & heads),
        "n_symbols": chunk.totals(_SYMBOL[data]),
        "n_dup_lines": n_lines - distinct_lines,
        "n_repeat_words": np.bincount(text_of[covered], minlength=n),
        "n_lines": n_lines,
        "n_capitals": chunk.totals(_CAPITAL[data]),
        "n_letters": chunk.totals(_LETTER[data]),
        "n_exclaims": chunk.totals(_EXCLAIM[data]),
        "n_distinct": _distinct(hashes, text_of, n),
    }


def text_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the columns ``COUNTS`` of each text; one row per row of ``docs``, null texts count as empty."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                ids = batch.column("doc_id").slice(chunk.first, chunk.n)
                found = measure(chunk)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(found[c].astype(np.int64)) for c in COUNTS)], names=["doc_id", *COUNTS])

    return docs.mapInArrow(run, STATS.format(id=id_type))


def _ratios(df: DataFrame) -> DataFrame:
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return df.withColumns(
        {
            "symbols_per_word": share("n_symbols", "n_words"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "mean_word": share("word_chars", "n_words"),
            "capital_share": share("n_capitals", "n_letters"),
            "letter_share": share("n_letters", "word_chars"),
            "exclaim_share": share("n_exclaims", "n_words"),
            # Long texts repeat words by nature: the share of distinct words is taken of the root-scaled length.
            "distinct_share": F.col("n_distinct") / F.greatest(F.pow(F.col("n_words").cast("double"), F.lit(0.8)), F.lit(1.0)),
        }
    )


def _vote(rule: tuple) -> F.Column:
    column, bad_below, bad_above, good_from, good_to = rule
    c = F.col(column)
    bad, good = F.lit(False), F.lit(_two_sided(rule))
    if bad_below is not None:
        bad = bad | (c < bad_below)
    if bad_above is not None:
        bad = bad | (c > bad_above)
    if good_from is not None:
        good = good & (c >= good_from)
    if good_to is not None:
        good = good & (c <= good_to)
    return F.when(bad, 0).when(good, 2).otherwise(1)


def _two_sided(rule: tuple) -> bool:
    return rule[3] is not None or rule[4] is not None


def believed(rules: dict) -> np.ndarray:
    return np.array([[(TWO_SIDED if _two_sided(r) else BAD_ONLY)[c] for r in rules.values()] for c in (0, 1)])


def learn(patterns: np.ndarray, counts: np.ndarray, believed: np.ndarray, rounds: int = 100, prior: float = 0.8, strength: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of good for each pattern, and ``rates[class, rule, vote]``: how often a rule votes bad or good on a class.

    ``patterns`` holds 0 (bad), 1 (none) or 2 (good) per rule. Accuracy is learned for each class on its own, since most
    texts are good and a vote that nearly all texts get is weak evidence. An abstention is none. Rates start at
    ``believed`` and are smoothed towards it as by a ``strength`` of the corpus, which ties the classes to their names.
    """
    votes = np.stack([patterns == 0, patterns == 2], axis=2).astype(float)
    total = max(counts.sum(), 1.0)
    floor = 1e-3
    rates, share, post = np.maximum(believed, floor), prior, np.zeros(len(patterns))
    weight = strength * total * np.array([prior, 1 - prior])[:, None, None]
    for _ in range(rounds):
        logit = np.log(share) - np.log1p(-share) + np.einsum("prv,rv->p", votes, np.log(rates[0]) - np.log(rates[1]))
        post = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        mass = np.stack([counts * post, counts * (1 - post)])
        seen = np.einsum("cp,prv->crv", mass, votes) + weight * believed
        rates = np.clip(seen / (mass.sum(axis=1)[:, None, None] + weight), floor, 1 - floor)
        share = (mass[0].sum() + prior * strength * total) / (total * (1 + strength))
    return post, rates


def weak_quality(docs: DataFrame, keep_from: float = 0.5, rounds: int = 100, rules: dict = RULES) -> DataFrame:
    """Posterior quality of every text by rules that vote or abstain.

    One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, the counts of ``COUNTS``, ``pattern`` (the votes as
    digits 0 bad, 1 none, 2 good, in the order of ``rules``), ``quality`` (posterior, 0 to 1) and ``good``
    (``quality >= keep_from``). Null and empty texts have zero counts and are judged like others; an empty table gives no
    row; repeated rows are judged alike; other columns are ignored. Only the counts of vote patterns, at most 3^rules,
    reach the driver; they come from all texts.
    """
    spark = docs.sparkSession
    counts = written(text_counts(docs), "quality")
    voted = _ratios(counts).withColumn("pattern", F.concat(*(_vote(r).cast("string") for r in rules.values())))
    seen = voted.groupBy("pattern").count().orderBy("pattern").collect()
    votes = np.array([[int(d) for d in r["pattern"]] for r in seen], dtype=np.int64).reshape(len(seen), len(rules))
    post, _ = learn(votes, np.array([r["count"] for r in seen], dtype=float), believed(rules), rounds)
    table = spark.createDataFrame([(r["pattern"], float(p)) for r, p in zip(seen, post)], "pattern string, quality double")
    return voted.join(F.broadcast(table), "pattern", "left").select("doc_id", *COUNTS, "pattern", "quality", (F.col("quality") >= keep_from).alias("good"))


def op9_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict for every document."""
    judged = weak_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), "quality", "pattern",
    )
