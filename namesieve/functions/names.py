"""Name cleaning as Spark SQL expressions (JVM side, no Python UDF).

The functions take and give SQL text, so that a long expression is one call to the JVM.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame

from namesieve.functions.text import sql_string

# Legal-form patterns, applied in this order to company names.
LEGAL_FORMS = (
    r"\bS\.?A\.?\b",
    r"\bS\.?\s?DE\s?R\.?L\.?\b",
    r"\bS\.?\s?DE\s?C\.?V\.?\b",
    r"\bLLC\b",
    r"\bL\.?L\.?C\.?\b",
    r"\bLTD\b",
    r"\bLIMITED\b",
    r"\bINC\b",
    r"\bCORP\b",
    r"\bCORPORATION\b",
    r"\bCOMPANY\b",
    r"\bCO\.?\b",
    r"\bHOLDINGS?\b",
)
COMPANY = "MORAL"

# Every code point that counts as white space in a Unicode string.
UNICODE_SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"


@lru_cache(maxsize=1)
def _decompositions() -> tuple[str, str, dict[str, str]]:
    """Compatibility decompositions without combining marks, from the Unicode database.

    Returns the two arguments of ``translate`` (one-to-one first, then the characters that
    vanish) and the characters that become several. Hangul syllables are not among them: ``_jamo``
    works them out.
    """
    single, gone, several = {}, [], {}
    for code in range(0x80, 0x30000):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        kept = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if kept == char:
            continue
        if not kept:
            gone.append(char)
        elif len(kept) == 1:
            single[char] = kept
        else:
            several[char] = kept
    return "".join(single) + "".join(gone), "".join(single.values()), several


def _jamo(text: str) -> str:
    """Hangul syllables as their two or three letters; a syllable's number has the places of all three."""
    number = "(ascii(c) - 44032)"
    letters = [f"4352 + {number} div 588", f"4449 + {number} % 588 div 28", f"4519 + {number} % 28"]
    digits = [f"lpad(hex({x}), 4, '0')" for x in letters]
    digits[2] = f"if({number} % 28 = 0, '', {digits[2]})"  # no last letter
    split = f"decode(unhex(concat({', '.join(digits)})), 'UTF-16BE')"
    return f"array_join(transform(split({text}, ''), c -> if(c >= '\uac00' AND c <= '\ud7a3', {split}, c)), '')"


def strip_accents(text: str) -> str:
    """Drop accents and compatibility forms: é→e, Ａ→A, ﬁ→fi; letters like ß stay; Hangul syllables become their letters."""
    matching, replacement, several = _decompositions()
    plain = f"translate({text}, {sql_string(matching)}, {sql_string(replacement)})"
    pairs = f"split({sql_string(chr(1).join(k + v for k, v in several.items()))}, {sql_string(chr(1))})"
    expanded = f"aggregate({pairs}, {plain}, (acc, p) -> replace(acc, substr(p, 1, 1), substr(p, 2)))"
    # The characters that expand are rare. Two ranges tell them from the usual accented letters, and only
    # a text that passes is searched for the exact set.
    low = [c for c in several if c < "\u0100"]
    high = min(c for c in several if c >= "\u0100")
    maybe = sql_string(f"[{min(low)}-{max(low)}{high}-\U0010ffff]")
    rare = sql_string(f"[{_ranges(several)}]")
    stripped = f"CASE WHEN {text} RLIKE {maybe} AND {text} RLIKE {rare} THEN {expanded} ELSE {plain} END"
    syllables = sql_string("[\uac00-\ud7a3]")
    return f"CASE WHEN {text} RLIKE {syllables} THEN {_jamo(f'({stripped})')} ELSE {stripped} END"


def _ranges(chars) -> str:
    """The inside of a regex class for ``chars``, neighbours written as ranges."""
    out, codes = [], sorted(map(ord, chars))
    start = previous = codes[0]
    for code in [*codes[1:], None]:
        if code is None or code != previous + 1:
            out.append(chr(start) if start == previous else f"{chr(start)}-{chr(previous)}")
            start = code
        previous = code
    return "".join(out)


def normalize_whitespace(text: str) -> str:
    """One blank for every run of white space, none at the ends."""
    return f"trim(regexp_replace({text}, {sql_string(UNICODE_SPACE + '+')}, ' '))"


def collapse_blanks(text: str) -> str:
    return f"trim(regexp_replace({text}, {sql_string(r'\s+')}, ' '))"


def is_company(entity_type: str) -> str:
    return f"coalesce(upper(CAST({entity_type} AS STRING)) = '{COMPANY}', false)"


def tokens(text: str) -> str:
    """Words of a text; an empty text has none."""
    return f"filter(split(trim({text}), {sql_string(r'\s+')}), t -> t <> '')"


def without_spaces(text: str) -> str:
    return f"replace({text}, ' ', '')"


def with_normalized_name(df: DataFrame, name: str = "entity_name", entity_type: str = "entity_type") -> DataFrame:
    """Add the normalised form of ``name`` and its measures to every row; one narrow projection chain.

    ``name_norm`` has lower-case ASCII letters, digits and inner dots; ``name_base`` also loses the
    legal forms of companies.
    """
    out = df.selectExpr("*", f"coalesce(CAST({name} AS STRING), '') AS name_raw")
    out = out.selectExpr("*", f"{strip_accents('lower(name_raw)')} AS _plain")
    letters = f"regexp_replace(_plain, {sql_string(r'[^a-z0-9\s.]')}, ' ')"
    no_final_dots = f"regexp_replace({letters}, {sql_string(r'\.(?=\s|$)')}, ' ')"
    out = out.selectExpr("*", f"{collapse_blanks(no_final_dots)} AS name_norm").drop("_plain")
    company = is_company(entity_type)
    steps = ["name_norm"]
    for i, pattern in enumerate(LEGAL_FORMS):
        reduced = f"regexp_replace({steps[-1]}, {sql_string('(?i)' + pattern)}, ' ')"
        out = out.selectExpr("*", f"CASE WHEN {company} THEN {reduced} ELSE {steps[-1]} END AS _form_{i}")
        steps.append(f"_form_{i}")
    # A pattern always takes at least one letter, so a changed text means that it matched.
    removed = " + ".join(f"CAST({a} <> {b} AS INT)" for a, b in zip(steps, steps[1:]))
    base = f"CASE WHEN {company} THEN {collapse_blanks(steps[-1])} ELSE name_norm END"
    out = out.selectExpr("*", f"{removed} AS removed_legal_suffix_pattern_count", f"{base} AS name_base")
    out = out.drop(*steps[1:]).selectExpr("*", f"{tokens('name_base')} AS name_tokens")
    return out.selectExpr(
        "*",
        "size(name_tokens) AS name_token_count",
        f"length({without_spaces('name_base')}) AS name_char_count",
        "array_join(transform(name_tokens, t -> substr(t, 1, 1)), '') AS name_initials",
    )
