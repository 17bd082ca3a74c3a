import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from namesieve.llm import privacy

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in match.split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def spans(text):
    return sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if valid(kind, m.group()))


TRICKY = [
    "a@b.c_d@e.f x@y z@q.w.", "@@a@b..c a@b-c@d.e %+-@x.y", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3", "0.0.0.0.1.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111", "4111111111111111 41111111111111112222", "+1 (555) 123-4567 +12 +1-2-3-4-5-6-7-8-9 ++491234567890)",
    "\U0001f600 é a@b.c \U0001f600 +49 (0) 30 123456.", "5555555555554444+4915112345678 10.0.0.1", "\u0001a@b.c\u0001 \u0002", "0" * 5000, "a" * 20000 + "@", "1 " * 3000, "+1" + " " * 9000,
]


def found(spark, texts, model=privacy.Trees(threshold=2.0)):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    return {r["doc_id"]: [tuple(s) for s in r["strict"]] for r in privacy.find(docs, model).collect()}


def test_strict_spans_equal_the_base_patterns(spark):
    got = found(spark, TRICKY)
    for i, text in enumerate(TRICKY):
        assert got[i] == spans(text.replace("\u0001", "\u0002")), text[:80]


def test_strict_spans_of_random_texts(spark):
    alphabet = st.text(alphabet="01239.+-@ ()ab_%é", max_size=60)
    texts = []

    @settings(max_examples=400, deadline=None, database=None)
    @given(alphabet)
    def collect(text):
        texts.append(text)

    collect()
    got = found(spark, texts)
    for i, text in enumerate(texts):
        assert got[i] == spans(text), text


def test_query(spark, folder):
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = privacy.op4_private_data(spark, folder).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = spans(text[r["doc_id"]])
        listed = [f"{privacy.KINDS[k]}:{a}:{b}" for a, k, b in want]
        assert [r[f"n_{k}"] for k in privacy.KINDS] == [sum(w[1] == k for w in want) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r["spans"].split(","))


def test_no_python_in_the_plan(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = privacy.redacted(privacy.find(docs))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_trees_fit_and_calibrate():
    x = lambda **k: {f: 0 for f in privacy.FEATURES} | k
    rows = [(x(cue=1, digits=2), 95, 5), (x(cue=0, digits=2), 2, 98), (x(cue=1, digits=0), 1, 50), (x(cue=1, digits=2, luhn=1), 200, 0)]
    model = privacy.boost(rows, rows, precision=0.97)
    chance = lambda r: 1 / (1 + 2.718281828459045 ** -(model.odds(r[0]) * model.scale + model.shift))
    assert chance(rows[3]) >= model.threshold > chance(rows[1])
    assert chance(rows[0]) == pytest.approx(0.95, abs=0.08) and chance(rows[1]) == pytest.approx(0.02, abs=0.05)
    assert privacy.boost([(x(), 5, 0)], []).threshold > 1


def test_expression_and_trees_agree(spark):
    x = lambda **k: {f: 0 for f in privacy.FEATURES} | k
    rows = [(x(cue=c, digits=d), 10 * d + 1, 7 - d) for c in (0, 1) for d in range(6)]
    model = privacy.boost(rows, rows)
    df = spark.createDataFrame([tuple(r[0].values()) for r in rows], ", ".join(f"{f} int" for f in privacy.FEATURES))
    got = df.select("cue", "digits", model.chance(F.struct(*privacy.FEATURES)).alias("p")).collect()
    for r in got:
        odds = model.odds(x(cue=r["cue"], digits=r["digits"])) * model.scale + model.shift
        assert r["p"] == pytest.approx(1 / (1 + 2.718281828459045**-odds))


def test_learned_trees_add_spans_that_look_alike(spark):
    noise = [f"order 12-34-{i} part 99/1234/{i:04d} of 2001.02.{i}" for i in range(200)]
    calls = [f"call me at +1 (555) {100 + i}-{4000 + i} today" for i in range(300)]
    masked = ["call me at 1 (555) 777-4321 today", "order 12-34-77 part 99/1234/0077 of 2001.02.77"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(noise + calls + masked)], "doc_id bigint, text string")
    rows = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in privacy.find(docs).collect()}
    assert rows[500] == [(11, 27)] and rows[501] == []
    assert all(rows[200 + i] for i in range(300)) and not any(rows[i] for i in range(200))


@pytest.mark.parametrize("missed", [5, 20, 50])
def test_unconfirmed_spans_are_found_however_many(spark, missed):
    noise = [f"order 12-34-{i} part 99/1234/{i:04d} of 2001.02.{i}" for i in range(200)]
    calls = [f"call me at {'' if i * 37 % 100 < missed else '+'}1 (555) {100 + i}-{4000 + i} today" for i in range(400)]
    mails = [f"write to u{i}{' (at) ' if i * 61 % 100 < missed else '@'}mail.org soon" for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(noise + calls + mails)], "doc_id bigint, text string")
    rows = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in privacy.find(docs).collect()}
    assert not any(rows[i] for i in range(200))
    assert all(rows[200 + i] == [3] for i in range(400)) and all(rows[600 + i] == [0] for i in range(400))


def test_few_proposals_are_learned_from_too(spark):
    texts = [f"call me at {'' if i % 5 == 0 else '+'}1 (555) {100 + i}-{4000 + i} today" for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "order 12-34-56 part 99/1234/0077"])], "doc_id bigint, text string")
    rows = {r["doc_id"]: len(r["spans"]) for r in privacy.find(docs).collect()}
    assert rows == {i: 1 for i in range(40)} | {40: 0}


@pytest.mark.parametrize("block", [7, 8192])
def test_redaction(spark, block):
    texts = ["mail a@b.c now, or +1 (555) 123-4567!", "\U0001f600é 10.0.0.1", "clean", None, "", "a@b.c", "x" * 20 + " 4111 1111 1111 1111 " + "y" * 20]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    rows = privacy.redacted(privacy.find(docs, privacy.Trees(threshold=2.0)), block).orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == ["mail [EMAIL] now, or [PHONE]!", "\U0001f600é [IP]", "clean", None, "", "[EMAIL]", "x" * 20 + " [CARD] " + "y" * 20]


def test_many_matches_in_one_text(spark):
    text = " ".join(f"u{i}@h{i}.org" for i in range(3000))
    assert found(spark, [text])[0] == spans(text)


def test_odd_rows_and_empty_table(spark, odd_docs):
    rows = privacy.find(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {len(r["spans"]) for r in rows if r["doc_id"] == 6} == {2}
    assert privacy.find(odd_docs.limit(0)).count() == 0
    stage = privacy.private_data_stage(spark, odd_docs, "")
    assert stage.columns == odd_docs.columns
    assert {r["text"] for r in stage.where("doc_id = 6").collect()} == {"Ünïcödé \U0001f600 words ąć [EMAIL] [PHONE]"}
