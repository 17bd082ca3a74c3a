"""Nested text columns: Python-style literals and JSON lists, as Spark SQL expressions."""

from __future__ import annotations

from namesieve.functions.text import sql_string

ITEMS = "'array<map<string,string>>'"

# Weight of each review priority.
PRIORITY_WEIGHTS = {"low": 0.4, "medium": 1.0, "high": 1.5}

# A quoted text of either kind, or what is written differently in JSON outside of one.
_QUOTED = r"""('(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+")"""
_ELSEWHERE = r"((?<![A-Za-z0-9_])(?:None|True|False)(?![A-Za-z0-9_])|[()]|,(?=\s*[)\]}]))"
_BEFORE, _AFTER = "\u0001", "\u0002"
_IN_JSON = {"None": "null", "True": "true", "False": "false", "(": "[", ")": "]", ",": ""}


def first_literal_item(literal: str) -> str:
    """First dict of a list literal as ``map<string,string>``; null when the text is not such a list.

    The literal is rewritten to JSON. Outside quoted texts ``None/True/False``, the parentheses of tuples and trailing
    commas are replaced; inside them only ``\\xNN`` escapes. Nested dicts, lists and tuples stay JSON text inside the map.
    """
    marks = sql_string(_BEFORE + _AFTER)
    plain = f"translate({literal}, {marks}, '')"
    # A quoted text has both marks behind it, anything else is between them.
    marked = sql_string(f"$1{_BEFORE}$2{_AFTER}")
    text = f"regexp_replace({plain}, {sql_string(f'{_QUOTED}|{_ELSEWHERE}')}, {marked})"
    for python_way, json_way in _IN_JSON.items():
        text = f"replace({text}, {sql_string(_BEFORE + python_way + _AFTER)}, '{json_way}')"
    text = f"translate({text}, {marks}, '')"
    text = f"regexp_replace({text}, {sql_string(r'(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})')}, {sql_string(r'$1\\u00$2')})"
    return f"CASE WHEN trim({literal}) LIKE '[%' THEN get(from_json({text}, {ITEMS}), 0) END"


def highest_priority_weight(queue_json: str) -> str:
    """Largest priority weight in a JSON list; 0 for anything that is not a clean list of objects."""
    text = f"trim({queue_json})"
    items = f"from_json({text}, {ITEMS}, map('allowSingleQuotes', 'false'))"
    weights = "map(" + ", ".join(f"'{k}', {v}D" for k, v in PRIORITY_WEIGHTS.items()) + ")"
    weight = f"transform({items}, i -> coalesce(try_element_at({weights}, lower(try_element_at(i, 'priority'))), 0D))"
    # A present priority that is not a text makes the whole list unreadable.
    odd = sql_string(r'"priority"\s*:\s*(?!["\s])')
    clean = f"{text} LIKE '[%' AND {text} LIKE '%]' AND NOT {text} RLIKE {odd} AND NOT exists({items}, i -> i IS NULL)"
    return f"coalesce(CASE WHEN {clean} THEN array_max({weight}) END, 0D)"
