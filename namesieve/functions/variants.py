"""Spelling variants of a normalised name as Spark SQL expressions."""

from __future__ import annotations

from namesieve.functions.names import is_company
from namesieve.functions.text import sql_list

# Rule names in the order in which they claim a spelling.
RULES = (
    "base_canonical",
    "reverse_order",
    "initials_full",
    "first_last",
    "first_initial_last",
    "truncate_3_tokens",
    "moral_remove_corp_noise",
)
# Words that say nothing about which company is meant.
CORPORATE_NOISE = ("group", "holding", "holdings", "international", "global", "trading")


def variant_candidates(tokens: str, entity_type: str) -> str:
    """``array<struct<variant, rule>>`` with one entry per applicable rule, in rule order."""
    words = f"size({tokens})"
    first, last = f"element_at({tokens}, 1)", f"element_at({tokens}, -1)"
    kept = f"filter({tokens}, t -> t NOT IN ({sql_list(CORPORATE_NOISE)}))"
    spellings = (
        f"array_join({tokens}, ' ')",
        f"CASE WHEN {words} >= 2 THEN array_join(reverse({tokens}), ' ') END",
        f"array_join(transform({tokens}, t -> substr(t, 1, 1)), ' ')",
        f"CASE WHEN {words} >= 2 THEN concat_ws(' ', {first}, {last}) END",
        f"CASE WHEN {words} >= 2 THEN concat_ws(' ', substr({first}, 1, 1), {last}) END",
        f"CASE WHEN {words} > 3 THEN array_join(slice({tokens}, 1, 3), ' ') END",
        f"CASE WHEN {is_company(entity_type)} THEN array_join({kept}, ' ') END",
    )
    entries = ", ".join(f"named_struct('variant', {s}, 'rule', '{r}')" for s, r in zip(spellings, RULES))
    return f"filter(array({entries}), e -> {words} > 0 AND e.variant <> '')"


def first_spelling_wins(entries: str) -> str:
    """Keep an entry only if no earlier entry has the same spelling; at most seven entries, no shuffle."""
    none_yet = "CAST(array() AS ARRAY<STRUCT<variant: STRING, rule: STRING>>)"
    add = "CASE WHEN exists(kept, k -> k.variant = e.variant) THEN kept ELSE concat(kept, array(e)) END"
    return f"aggregate({entries}, {none_yet}, (kept, e) -> {add})"


def rule_order(rule: str) -> str:
    return f"array_position(array({sql_list(RULES)}), {rule})"
