"""Personal data by boosted trees over candidate spans, in DataFrame functions throughout.

High-recall patterns propose overlapping spans of four kinds. Small integers describe the format and the surroundings of
each; none tells what only the strict patterns ask for, such as a plus. Spans that strict patterns and check digits confirm
are the positive examples; all other proposals are unlabelled, not negative, as the strict patterns miss some (Elkan and Noto,
2008): the chance to be real is the chance to be confirmed over the share of real spans that are, which is learned per kind.
As every description is one of some ten thousand, the corpus is counted into one bounded table, on which the driver boosts
small trees; these become SQL expressions. Thresholds are calibrated, one per kind, on documents that the trees did not learn
from. Strictly confirmed spans always stay, and proposals that score high enough are added.

All offsets are code points. Patterns are possessive and anchored so that none rescans a long run.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Strict patterns by kind; the same leftmost matches as ``local+@label+(\.label+)+`` and so on, without retries inside a run.
STRICT = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generous patterns: masked addresses, IPv6 and dotted groups, cards with odd separators, telephone numbers without a plus.
GENEROUS = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++ ?(?:@|\(at\)|\[at\]|\{{at\}}) ?{_LABEL}++(?: ?(?:\.|\(dot\)|\[dot\]|\{{dot\}}) ?{_LABEL}++)++",
    "ip": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}|[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3})(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z])[0-9]{3,6}(?:[ ./_-]?[0-9]{3,6}){2,4}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+|00)?(?:\(?[0-9]{1,5}\)?[ ./-]{0,2}){2,5}[0-9]{2,5}(?![0-9A-Za-z])",
}
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write|correo|courriel|kontakt|address)",
    "ip": r"(?i)\b(?:ip|host|server|address|from|login|addr)\b",
    "card": r"(?i)(?:card|visa|master|credit|carte|karte|tarjeta|payment|account)",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|contact|tél|ruf|llam)",
}
TAGS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
_MARK, _OTHER = "\u0001", "\u0002"
CONTEXT = 24
#: Description of a proposal, each a small integer with this many values: at most 4*6*3*5*2*3*3*2*2 = 25,920 in all.
FEATURES = {"kind": 4, "digits": 6, "separators": 3, "groups": 5, "cue": 2, "before": 3, "after": 3, "luhn": 2, "valid": 2}
_BLOCK = 64


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _starts(pieces: Column) -> Column:
    """Offset of each piece: sums in blocks, so that many matches in one text stay cheap."""
    zero, add = F.lit(0).cast("long"), lambda a, x: a + x
    block_of = lambda i: F.floor(i / _BLOCK).cast("int")
    part = lambda lengths, b, n: F.aggregate(F.slice(lengths, b * _BLOCK + 1, n), zero, add)
    sums = lambda lengths: F.transform(F.sequence(F.lit(0), block_of(F.size(lengths) - 1)), lambda b: part(lengths, b, F.lit(_BLOCK)))
    running = lambda blocks: F.aggregate(blocks, F.array(zero), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))

    def offsets(lengths: Column) -> Column:
        return _let(running(sums(lengths)), lambda before: F.transform(lengths, lambda _, i: F.get(before, block_of(i)) + part(lengths, block_of(i), i % _BLOCK)))

    return _let(F.transform(pieces, lambda p: F.length(p).cast("long")), offsets)


def _matches(df: DataFrame, text: str, pattern: str, out: str, needs: Column) -> DataFrame:
    """Adds ``out``: start, end, the match and the text around it, of every match of ``pattern`` in the column ``text``."""
    cut = F.split(F.regexp_replace(F.col(text), F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}")), _MARK, -1)
    df = df.withColumn("__cut", F.when(needs, cut).otherwise(F.array(F.lit(""))))
    df = df.withColumn("__at", F.when(F.size("__cut") > 1, _starts(F.col("__cut"))))

    def one(k: Column) -> Column:
        i = 2 * k - 1
        piece, start = F.get("__cut", i), F.get("__at", i)
        before, after = F.get("__cut", i - 1), F.get("__cut", i + 1)
        return F.struct(start.alias("start"), (start + F.length(piece)).alias("end"), piece.alias("match"), F.right(before, F.lit(CONTEXT)).alias("before"), F.substring(after, 1, 1).alias("after"))

    count = F.floor(F.size("__cut") / 2).cast("int")
    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>")
    return df.withColumn(out, F.when(count > 0, F.transform(F.sequence(F.lit(1), count), one)).otherwise(none)).drop("__cut", "__at")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substr(digits, i, F.lit(1))) - 48
        return total + F.when((n - i) % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    """Does a strict match pass its checks?"""
    n = F.length(_digits(match))
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _needs(text: str, kind: str) -> Column:
    return F.col(text).rlike({"email": r"@|[(\[{]at[)\]}]", "ip": "[0-9]"}.get(kind, "[0-9]"))


# Lambdas of array functions must not have default arguments, which would count as parameters; these bind a kind.
def _checked(kind: str):
    return lambda m: _valid(kind, m["match"])


def _span_of(k: int):
    return lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"))


def _describer(k: int):
    return lambda m: _described(m, k)


def _of_kind(k: int):
    return lambda s: s["kind"] == k


def strict_spans(df: DataFrame, text: str, out: str = "strict") -> DataFrame:
    """Adds ``out``: confirmed spans, ``start``, ``kind`` (index in ``KINDS``), ``end``, in this order."""
    for k, kind in enumerate(KINDS):
        df = _matches(df, text, STRICT[kind], f"__s{k}", _needs(text, kind))
        kept = F.filter(f"__s{k}", _checked(kind))
        df = df.withColumn(f"__s{k}", F.transform(kept, _span_of(k)))
    return df.withColumn(out, F.array_sort(F.concat(*(f"__s{k}" for k in range(len(KINDS)))))).drop(*(f"__s{k}" for k in range(len(KINDS))))


def _plain(kind: str, match: Column) -> Column:
    """A proposal without what tells masked forms from those of the strict patterns."""
    if kind == "email":
        return F.regexp_replace(F.regexp_replace(match, r" ?(?:@|[(\[{]at[)\]}]) ?", "@"), r" ?(?:\.|[(\[{]dot[)\]}]) ?", ".")
    if kind == "ip":
        return F.regexp_replace(match, r" ?\. ?", ".")
    return F.regexp_replace(match, r"^(?:\+|00)", "") if kind == "phone" else match


def _described(m: Column, k: int) -> Column:
    """The proposal with its description."""
    before, after = m["before"], m["after"]
    edge = lambda c, inside: F.when((c == "") | c.rlike(r"^\s$"), 0).when(c.rlike(inside), 1).otherwise(2)

    def codes(match: Column, digits: Column, n: Column, separators: Column) -> Column:
        groups = F.size(F.array_remove(F.split(match, "[^0-9A-Za-z]+"), ""))
        found = {
            "kind": F.lit(k),
            "digits": F.when(n < 7, 0).when(n < 9, 1).when(n < 12, 2).when(n < 16, 3).when(n < 20, 4).otherwise(5),
            "separators": F.when(separators == "", 0).when(F.length(F.regexp_replace(separators, r"^(.)\1*", "")) == 0, 1).otherwise(2),
            "groups": F.least(F.greatest(groups, F.lit(1)), F.lit(5)) - 1,
            "cue": before.rlike(CUES[KINDS[k]]).cast("int"),
            "before": edge(F.right(before, F.lit(1)), r"^[(\[{<\"':;,.]$"),
            "after": edge(after, r"^[)\]}>\"':;,.!?]$"),
            "luhn": F.when(n.between(12, 19), _luhn(digits)).otherwise(False).cast("int"),
            "valid": _valid(KINDS[k], match).cast("int"),
        }
        return F.struct(*(c.cast("int").alias(f) for f, c in found.items()))

    parts = lambda match: F.struct(match.alias("m"), _digits(match).alias("d"), F.regexp_replace(match, "[0-9A-Za-z]", "").alias("s"))
    x = _let(_plain(KINDS[k], m["match"]), lambda match: _let(parts(match), lambda v: codes(v["m"], v["d"], F.length(v["d"]), v["s"])))
    return F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"), x.alias("x"))


def proposals(df: DataFrame, text: str, out: str = "proposed") -> DataFrame:
    """Adds ``out``: ``start``, ``kind``, ``end`` and the description ``x`` of every match of a generous pattern."""
    for k, kind in enumerate(KINDS):
        df = _matches(df, text, GENEROUS[kind], f"__g{k}", _needs(text, kind))
        df = df.withColumn(f"__g{k}", F.transform(f"__g{k}", _describer(k)))
    return df.withColumn(out, F.concat(*(f"__g{k}" for k in range(len(KINDS))))).drop(*(f"__g{k}" for k in range(len(KINDS))))


@dataclass
class Trees:
    """Boosted trees of two splits: (feature, at most, left, right), a side being such a tree or a number; odds add up."""

    trees: list = field(default_factory=list)
    start: float = 0.0
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0
    #: By kind, if learned: the threshold, and the share of the real spans that is confirmed.
    thresholds: tuple = ()
    confirmed: tuple = ()

    def odds(self, x: dict) -> float:
        total = self.start
        for tree in self.trees:
            while isinstance(tree, tuple):
                tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
            total += tree
        return total

    def chance(self, x: Column) -> Column:
        """The calibrated probability to be confirmed as an expression over a struct of features."""

        def walk(tree) -> Column:
            return F.when(x[tree[0]] <= tree[1], walk(tree[2])).otherwise(walk(tree[3])) if isinstance(tree, tuple) else F.lit(float(tree))

        total = F.lit(self.start)
        for tree in self.trees:
            total = total + walk(tree)
        return 1 / (1 + F.exp(-(total * self.scale + self.shift)))

    def real(self, chance: Column, k: Column) -> Column:
        """The probability of a proposal of kind ``k`` to be personal data, from that to be confirmed."""
        return F.least(F.lit(1.0), chance / F.get(F.array(*(F.lit(float(c)) for c in self.confirmed)), k)) if self.confirmed else chance

    def enough(self, chance: Column, k: Column) -> Column:
        """Does the probability to be confirmed reach the threshold of kind ``k``?"""
        return chance >= (F.get(F.array(*(F.lit(float(t)) for t in self.thresholds)), k) if self.thresholds else F.lit(self.threshold))


def _leaf(rows: list) -> float:
    """A Newton step of the logistic loss, with one pseudo-count."""
    return sum(g for _, g, _ in rows) / (sum(h for _, _, h in rows) + 1.0)


def _grow(rows: list, depth: int, rate: float):
    """Best tree on rows of (features, gradient, curvature)."""
    gain = lambda part: sum(g for _, g, _ in part) ** 2 / (sum(h for _, _, h in part) + 1.0)
    best, whole = None, gain(rows)
    if depth:
        for name, size in FEATURES.items():
            for at in range(size - 1):
                left, right = [r for r in rows if r[0][name] <= at], [r for r in rows if r[0][name] > at]
                if left and right and (found := gain(left) + gain(right) - whole) > 1e-9 and (best is None or found > best[0]):
                    best = (found, name, at, left, right)
    if best is None:
        return rate * _leaf(rows)
    return (best[1], best[2], _grow(best[3], depth - 1, rate), _grow(best[4], depth - 1, rate))


def boost(counts: list[tuple[dict, int, int]], held: list[tuple[dict, int, int]], rounds: int = 30, rate: float = 0.4, precision: float = 0.99, support: int = 20, least: float = 0.9) -> Trees:
    """Trees on counted descriptions (features, confirmed, unlabelled), calibrated on ``held``.

    The calibrated probability to be confirmed is a line through the log odds, fitted on ``held``. Each kind has a threshold on
    it, the lowest found by ``_threshold``; ``threshold`` is the lowest of all. It is out of reach (2) for a kind with fewer
    than ``support`` proposals or none confirmed. Of kinds with fewer held ones, all proposals are for both.
    """
    out = Trees()
    short = [k for k in range(len(KINDS)) if sum(p + n for x, p, n in held if x["kind"] == k) < support or not any(p for x, p, _ in held if x["kind"] == k)]
    counts, held = [*counts, *(r for r in held if r[0]["kind"] in short)], [*held, *(r for r in counts if r[0]["kind"] in short)]
    positive, negative = sum(p for _, p, _ in counts), sum(n for _, _, n in counts)
    if not positive or not negative:
        return Trees(threshold=2.0)
    out.start = math.log(positive / negative)
    odds = [out.start] * len(counts)
    for _ in range(rounds):
        rows = []
        for (x, p, n), o in zip(counts, odds):
            chance = 1 / (1 + math.exp(-o))
            rows.append((x, p - (p + n) * chance, (p + n) * chance * (1 - chance)))
        tree = _grow(rows, 2, rate)
        out.trees.append(tree)
        odds = [out.odds(x) for x, _, _ in counts]
    scored = sorted(((out.odds(x), p, n) for x, p, n in held), reverse=True)
    for _ in range(200):
        a = b = 0.0
        total = sum(p + n for _, p, n in scored) or 1
        for o, p, n in scored:
            miss = p - (p + n) / (1 + math.exp(-max(-500.0, min(500.0, o * out.scale + out.shift))))
            a, b = a + miss * o, b + miss
        out.scale, out.shift = max(0.1, out.scale + 0.05 * a / total), out.shift + 0.05 * b / total
    chance = lambda o: 1 / (1 + math.exp(-max(-500.0, min(500.0, o * out.scale + out.shift))))
    found = []
    for k in range(len(KINDS)):
        part = [r for r in held if r[0]["kind"] == k]
        found.append(_threshold(sorted(((chance(out.odds(x)), p, n) for x, p, n in part), reverse=True), precision, support, least))
    out.thresholds, out.confirmed = (tuple(x) for x in zip(*found))
    out.threshold = min(out.thresholds)
    return out


def _threshold(scored: list[tuple[float, int, int]], precision: float, support: int, least: float, fewest: float = 0.4) -> tuple[float, float]:
    """Threshold on (chance to be confirmed, confirmed, unlabelled), best first, and the share of real spans that is confirmed.

    That share is the mean chance of confirmed spans, but not under ``fewest``: where fewer are confirmed, real spans and
    look-alikes cannot be told apart. Proposals pass while their chance to be real is ``least`` at least and the confirmed
    ones among those of about equal chance are not clearly (two deviations) fewer than ``precision`` real ones would have.
    """
    right = sum(p for _, p, _ in scored)
    if not right:
        return 2.0, 1.0
    share = min(1.0, max(fewest, sum(c * p for c, p, _ in scored) / right))
    threshold, seen, at, p, n = 2.0, 0, 0, 0, 0
    while at < len(scored) and scored[at][0] >= least * share:
        end = next((i for i in range(at, len(scored)) if scored[i][0] != scored[at][0]), len(scored))
        # Since the last ones that passed; a few with none confirmed pass only together with worse ones that are.
        p, n = p + sum(r[1] for r in scored[at:end]), n + sum(r[1] + r[2] for r in scored[at:end])
        wanted = precision * share * n - 2 * math.sqrt(n * share * (1 - share))
        if p + 1 < wanted:
            break
        if p and p >= wanted:
            seen, p, n = seen + n, 0, 0
            if seen >= support:
                threshold = scored[at][0] - 1e-12
        at = end
    return threshold, share


def _prepared(docs: DataFrame) -> DataFrame:
    # The mark of matches must not occur in a text; no pattern tells these two control characters apart.
    return docs.withColumn("__text", F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _MARK, _OTHER))


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def learn(docs: DataFrame) -> Trees:
    """Trees from the proposals in all of ``docs`` (``text``); a fifth of the texts, by hash, is for calibration."""
    # No filter on the arrays: the planner would move it, and with it their making, below the step that makes them.
    rows = proposals(strict_spans(_prepared(docs.select("text")), "__text"), "__text")
    confirmed = lambda p: F.exists("strict", lambda s: (s["kind"] == p["kind"]) & _overlaps(s, p))
    # What overlaps a span of another kind only is settled and cannot be added: it is no example of what could be.
    settled = lambda p: F.exists("strict", lambda s: _overlaps(s, p))
    judged = F.transform("proposed", lambda p: F.struct(p["x"].alias("x"), confirmed(p).alias("yes"), settled(p).alias("settled")))
    # Inlined as whole columns: asking for fields of exploded proposals would make the planner work them out field by field.
    rows = rows.select((F.pmod(F.xxhash64("__text"), F.lit(5)) == 0).alias("held"), F.inline(judged))
    counted = rows.groupBy("held", "x").agg(F.count_if("yes").alias("yes"), F.count_if(~F.col("yes") & ~F.col("settled")).alias("no")).collect()
    table = lambda held: [(r["x"].asDict(), r["yes"], r["no"]) for r in sorted(counted, key=lambda r: tuple(r["x"])) if r["held"] == held and r["yes"] + r["no"]]
    return boost(table(False), table(True))


def find(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    """Adds ``strict`` and ``spans`` to ``docs``: arrays of ``start``, ``kind`` (index in ``KINDS``), ``end``; spans also ``chance``.

    ``spans`` are the strict ones (chance 1) and the proposals that reach the model's threshold for their kind and overlap no
    strict one, by start, then kind. Without a model it is learned from ``docs``. Null texts count as empty and have no spans; rows are
    judged one by one, repeated ones alike; an empty table gives none. Input columns of these names are replaced.
    """
    model = model or learn(docs)
    docs = docs.drop("strict", "spans")
    rows = strict_spans(_prepared(docs), "__text")
    sure = F.transform("strict", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(1.0).alias("chance")))
    if model.threshold > 1:
        return rows.withColumn("spans", sure).drop("__text")
    rows = proposals(rows, "__text").withColumn("__judged", F.transform("proposed", lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end"), model.chance(p["x"]).alias("chance"))))
    added = F.filter("__judged", lambda p: model.enough(p["chance"], p["kind"]) & ~F.exists("strict", lambda s: _overlaps(s, p)))
    added = F.transform(added, lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end"), model.real(p["chance"], p["kind"]).alias("chance")))
    return rows.withColumn("spans", F.array_sort(F.concat(sure, added))).drop("__text", "proposed", "__judged")


def _merged(spans: Column) -> Column:
    """Spans by start, overlapping ones as one, which has the kind of the first."""
    kind = "array<struct<start:bigint,kind:int,end:bigint>>"

    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        bare = F.array(F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
        joined = F.array(F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end")))
        return F.when(F.size(done) == 0, bare).when(s["start"] < last["end"], F.concat(F.slice(done, 1, F.size(done) - 1), joined)).otherwise(F.concat(done, bare))

    return F.aggregate(spans, F.array().cast(kind), add)


def redacted(found: DataFrame, block: int = 8192) -> DataFrame:
    """``found`` (from ``find``) with every span in ``text`` replaced by a tag of its kind; a null text stays null.

    Texts are rebuilt block by block, as every cut counts characters from the start of what it cuts.
    """
    tags = F.array(*(F.lit(TAGS[k]) for k in KINDS))
    rows = found.withColumn("__spans", _merged(F.col("spans")))

    def rebuilt(b: Column) -> Column:
        low, high = b * block, (b + 1) * block
        part = F.substr("text", (low + 1).cast("int"), F.lit(block))
        inside = F.filter("__spans", lambda s: (s["start"] < high) & (s["end"] > low))

        def add(acc: Column, s: Column) -> Column:
            at, end = F.greatest(s["start"] - low, F.lit(0)), F.least(s["end"] - low, F.lit(block))
            before = F.substr(part, (acc["at"] + 1).cast("int"), (at - acc["at"]).cast("int"))
            tag = F.when(s["start"] >= low, F.get(tags, s["kind"])).otherwise("")
            return F.struct(end.cast("long").alias("at"), F.concat(acc["text"], before, tag).alias("text"))

        done = F.aggregate(inside, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text")), add)
        return F.concat(done["text"], F.substr(part, (done["at"] + 1).cast("int"), F.lit(block)))

    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.length("text") - 1) / block))
    whole = F.when(F.size("__spans") > 0, F.array_join(F.transform(blocks, rebuilt), "")).otherwise(F.col("text"))
    return rows.withColumn("text", whole).drop("__spans")


def _listed(spans: str) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans in every document."""
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    counts = [F.size(F.filter("strict", _of_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed("strict"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def private_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without the personal data found in it; ``n_chars`` follows the text."""
    out = redacted(find(docs)).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
