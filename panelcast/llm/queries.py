"""The registered queries of this subpackage and their SQL over the same tables."""

from __future__ import annotations

from panelcast.llm import (bpe, collocations, decontaminate, exact_dedup, language, lexical, line_dedup,
                           metric_join, near_dedup, preference, substrings, toxicity, warc)

QUERIES = {
    "op1_preference": preference.op1_preference,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_language": language.op4_language,
    "op5_minhash_near_dedup": near_dedup.op5_minhash_near_dedup,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_warc": warc.op7_warc,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_substring_dedup": substrings.op9_substring_dedup,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_collocations": collocations.op11_collocations,
    "op12_jaccard_join": metric_join.op12_jaccard_join,
    "op13_lexical_search": lexical.op13_lexical_search,
}

# Operators 3, 4, 8, 9 and 10 have no SQL form; tests/llm holds them against brute force.
ORACLE = {
    "op1_preference": preference.ORACLE,
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op5_minhash_near_dedup": near_dedup.ORACLE,
    "op6_decontaminate": decontaminate.ORACLE,
    "op7_warc": warc.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_jaccard_join": metric_join.ORACLE,
    "op13_lexical_search": lexical.ORACLE,
}
