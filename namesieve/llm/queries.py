"""Registered queries of this subpackage. Those without SQL are tested against brute force."""

from __future__ import annotations

from namesieve.llm import alignment, archives, language, leaks, mixing, neardups, neighbours, packing, pages, privacy, quality, scoring, spellings

QUERIES = {
    "op7_mixing": mixing.op7_mixing,
    "op8_nn_descent": neighbours.op8_nn_descent,
    "op4_private_data": privacy.op4_private_data,
    "op5_probminhash": neardups.op5_probminhash,
    "op1_context_tree": scoring.op1_context_tree,
    "op2_template_removal": pages.op2_template_removal,
    "op3_warc": archives.op3_warc,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op9_weak_supervision": quality.op9_weak_supervision,
    "op10_language_id": language.op10_language_id,
    "op11_spelling_variants": spellings.op11_spelling_variants,
    "op12_tokenizer_alignment": alignment.op12_tokenizer_alignment,
    "op13_winnowing": leaks.op13_winnowing,
}
ORACLES: dict[str, str] = {"op11_spelling_variants": spellings.OP11_SQL, "op13_winnowing": leaks.OP13_SQL}
