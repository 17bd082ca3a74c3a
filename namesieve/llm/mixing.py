"""Mixing sources to target weights by iterative proportional fitting.

Token counts of all documents are summed over cells of source, language and topic (topics are learned, see `topics.py`). Raking scales the cells until their sums
meet the target share of every source, language and topic, within the tokens that there are: no cell can be asked for more
than it holds. Cell weight over cell tokens is the probability with which each of the cell's documents is drawn, by a hash of
its id, so the draw is the same wherever and whenever it is made.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namesieve.llm import topics
from namesieve.plans.storage import written

MARGINS = ("source", "lang", "topic")
#: As many cells are raked on the driver; more are raked as a table.
HELD_CELLS = 100_000
NONE = "(none)"
#: Default targets are the shares of the tokens to these powers: rare values gain, common ones lose.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.8}
KEEP = 0.6
SEED = 20240229


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def fill(tokens: np.ndarray, weight: np.ndarray, target: float) -> np.ndarray:
    """``weight`` times the one factor with which ``min(tokens, factor * weight)`` sums to ``target``, cut at ``tokens``.

    If the tokens of positive weight do not suffice, all of them.
    """
    out = np.zeros(len(tokens))
    live = (weight > 0) & (tokens > 0)
    if target <= 0 or not live.any():
        return out
    t, w = tokens[live], weight[live]
    if t.sum() <= target:
        out[live] = t
        return out
    order = np.argsort(t / w)
    full = np.concatenate([[0.0], np.cumsum(t[order])[:-1]])
    open_weight = np.cumsum(w[order][::-1])[::-1]
    factor = (target - full) / open_weight
    k = int(np.argmax(factor <= (t / w)[order]))
    out[live] = np.minimum(t, factor[k] * w)
    return out


def rake(tokens: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray], budget: float, rounds: int = 500, close: float = 1e-9) -> np.ndarray:
    """Cell weights with the given sums (``targets`` are shares of ``budget``) by every margin, none above its tokens.

    ``codes`` holds each cell's value by margin. Starts from the tokens themselves and stops once a round moves less than
    ``close`` of the budget. Where targets contradict each other or the supply, the result is what the last rounds leave.
    """
    weight = tokens * (budget / max(tokens.sum(), 1.0))
    for _ in range(rounds):
        before = weight
        for code, target in zip(codes, targets):
            weight = _fitted(tokens, weight, code, target * budget)
        if np.abs(weight - before).sum() <= close * max(budget, 1.0):
            break
    return weight


def _fitted(tokens: np.ndarray, weight: np.ndarray, code: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``fill`` for the cells of each value. Factors grow by Newton steps until they use up no more cells."""
    out = np.zeros(len(tokens))
    live = np.flatnonzero((weight > 0) & (tokens > 0))
    t, w, c, n = tokens[live], weight[live], code[live], len(target)
    used = np.zeros(len(live), dtype=bool)
    while True:
        open_weight = np.bincount(c, np.where(used, 0.0, w), n)
        left = np.maximum(target - np.bincount(c, np.where(used, t, 0.0), n), 0.0)
        factor = np.divide(left, open_weight, out=np.full(n, np.inf), where=open_weight > 0)
        more = ~used & (t <= factor[c] * w)
        if not more.any():
            break
        used |= more
    out[live] = np.where(used, t, np.where(used, 1.0, factor[c]) * w)
    return out


def _rake_table(cells: DataFrame, aims: dict[str, DataFrame], budget: float, total: float, rounds: int = 500, close: float = 1e-9) -> DataFrame:
    """``rake`` on a table: ``cells`` (a column per margin, ``tokens``) with ``weight``; ``aims``: ``value`` and ``target`` by margin.

    The driver gets no more than a sum and a count per step.
    """
    cells = cells.withColumns({"weight": F.col("tokens") * (budget / max(total, 1.0)), "used": F.lit(False)})
    for _ in range(rounds):
        cells = cells.withColumn("before", F.col("weight"))
        for m, aim in aims.items():
            cells = cells.withColumn("used", F.lit(False))
            while True:
                live = F.col("weight") > 0
                sums = cells.where(live).groupBy(F.col(m).alias("value")).agg(F.sum(F.when(F.col("used"), 0.0).otherwise(F.col("weight"))).alias("open"), F.sum(F.when(F.col("used"), F.col("tokens")).otherwise(0.0)).alias("full"))
                factors = sums.join(aim, "value").select(F.col("value").alias(m), F.when(F.col("open") > 0, F.greatest(F.col("target") - F.col("full"), F.lit(0.0)) / F.col("open")).otherwise(float("inf")).alias("factor"))
                more = live & ~F.col("used") & (F.col("tokens") <= F.col("factor") * F.col("weight"))
                cells = written(cells.join(factors, m, "left").withColumn("more", more).withColumn("used", F.col("used") | F.coalesce("more", F.lit(False))), "mix-step")
                if cells.where("more").isEmpty():
                    break
                cells = cells.drop("factor", "more")
            fitted = F.when(F.col("weight") > 0, F.when(F.col("used"), F.col("tokens")).otherwise(F.col("factor") * F.col("weight"))).otherwise(0.0)
            cells = cells.withColumn("weight", fitted).drop("factor", "more")
        cells = written(cells, "mix-round")
        if (cells.agg(F.sum(F.abs(F.col("weight") - F.col("before")))).first()[0] or 0.0) <= close * max(budget, 1.0):
            break
    return cells.drop("before", "used")


def _shares(sums: np.ndarray, values: list[str], given: dict | None, power: float) -> np.ndarray:
    raw = np.array([given.get(v, 0.0) for v in values]) if given is not None else sums**power
    return raw / raw.sum() if raw.sum() > 0 else raw


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, keep: float = KEEP, margins: tuple = MARGINS, seed: int = SEED, held: int = HELD_CELLS) -> DataFrame:
    """``docs`` (``doc_id``, ``tokens`` and a column per margin) with ``rate``, the probability of a document, and ``drawn``.

    ``targets`` maps a margin to shares by value, scaled to sum to one; values that it leaves out get none. Margins that it
    leaves out aim at their own shares to the power in ``POWERS``. ``keep`` is the share of all tokens that is drawn, in
    expectation and as far as supply and targets allow. Null values of a margin are the value ``(none)``. Documents of no
    tokens weigh nothing and get the rate of their cell. Repeated rows are drawn together; an empty table gives no row. Input
    columns named ``rate`` and ``drawn`` are replaced.

    Every value is raked on its own, however rare. The driver gets the cells of values that occur together if they are not
    more than ``held``; more stay a table.
    """
    docs = docs.drop("rate", "drawn")
    value = {m: F.coalesce(F.col(m).cast("string"), F.lit(NONE)) for m in margins}
    sums = written(docs.groupBy(*(value[m].alias(m) for m in margins)).agg(F.sum(F.coalesce("tokens", F.lit(0))).cast("double").alias("tokens")), "mix-cells")
    if sums.count() <= held:
        table = _rates_here(sums, targets or {}, keep, margins)
    else:
        table = _rates_there(sums, targets or {}, keep, margins)
    marked = docs.withColumns({f"__{m}": value[m] for m in margins})
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11) * F.lit(2.0**-53)
    return marked.join(table, [f"__{m}" for m in margins], "left").drop(*(f"__{m}" for m in margins)).withColumn("drawn", draw < F.col("rate"))


def _rates_here(sums: DataFrame, targets: dict, keep: float, margins: tuple) -> DataFrame:
    """``rate`` by cell (``__`` and the margin's name), raked on the driver."""
    cells = sums.orderBy(*margins).collect()
    tokens = np.array([r["tokens"] for r in cells], dtype=float)
    codes, aims = [], []
    for m in margins:
        values = sorted({r[m] for r in cells})
        number = {v: i for i, v in enumerate(values)}
        code = np.array([number[r[m]] for r in cells], dtype=np.int64)
        codes.append(code)
        aims.append(_shares(np.bincount(code, tokens, len(values)), values, targets.get(m), POWERS.get(m, 1.0)))
    weight = rake(tokens, codes, aims, keep * tokens.sum())
    rates = np.where(tokens > 0, weight / np.maximum(tokens, 1.0), keep)
    return sums.sparkSession.createDataFrame(
        [(*(r[m] for m in margins), float(x)) for r, x in zip(cells, rates)], ", ".join(f"`__{m}` string" for m in margins) + ", rate double"
    )


def _rates_there(sums: DataFrame, targets: dict, keep: float, margins: tuple) -> DataFrame:
    """``_rates_here`` for more cells than the driver should hold."""
    total = sums.agg(F.sum("tokens")).first()[0] or 0.0
    aims = {}
    for m in margins:
        raw = sums.groupBy(F.col(m).alias("value")).agg(F.sum("tokens").alias("tokens"))
        if m in targets:
            given = sums.sparkSession.createDataFrame([(v, float(x)) for v, x in targets[m].items()], "value string, raw double")
            raw = raw.join(given, "value", "left").withColumn("raw", F.coalesce("raw", F.lit(0.0)))
        else:
            raw = raw.withColumn("raw", F.pow("tokens", F.lit(POWERS.get(m, 1.0))))
        raw = written(raw, "mix-aims")
        whole = raw.agg(F.sum("raw")).first()[0] or 0.0
        aims[m] = raw.select("value", (F.col("raw") * (keep * total / whole if whole > 0 else 0.0)).alias("target"))
    cells = _rake_table(sums, aims, keep * total, total)
    rate = F.when(F.col("tokens") > 0, F.col("weight") / F.greatest(F.col("tokens"), F.lit(1.0))).otherwise(keep)
    return cells.select(*(F.col(m).alias(f"__{m}") for m in margins), rate.alias("rate"))


def weighed(docs: DataFrame) -> DataFrame:
    """``docs`` without their ``text``, with its ``tokens`` and the ``topic`` learned from all of them; written."""
    light = docs.withColumns({"tokens": n_tokens(F.col("text")), "profile": topics.profile(F.col("text").cast("string"))})
    light = written(light.drop("text"), "mix-docs")
    return light.withColumn("topic", topics.learn(light).name(F.col("profile"))).drop("profile")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and draw of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "text")
    return mix(weighed(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn; columns as before.

    Rows are told apart by id, text, source and language: different texts under one id are drawn each at its own rate.
    """
    columns = docs.columns
    rows = docs.withColumn("__node", F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    light = weighed(rows.select("doc_id", "__node", "source", "lang", "text"))
    ident = ["doc_id", "__node", "source", "lang"]
    drawn = mix(light).where("drawn").select(*(F.col(c).alias(f"__drawn_{c}") for c in ident)).distinct()
    same = [rows[c].eqNullSafe(drawn[f"__drawn_{c}"]) for c in ident]
    return rows.join(drawn, reduce(Column.__and__, same), "left_semi").select(*columns)
