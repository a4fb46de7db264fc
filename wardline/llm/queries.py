"""The operators' registered queries and, where SQL can express one, its counterpart."""

from __future__ import annotations

from wardline.llm import ann, bpe, jaccard, langid, mixing, pages, quality, qualityrules, resample, substring, suffixes, topk, vectorcodes

QUERIES = {
    "op1_language": langid.op1_language,
    "op2_exact_topk": topk.op2_exact_topk,
    "op3_ngram_jaccard": jaccard.op3_ngram_jaccard,
    "op4_quality": quality.op4_quality,
    "op5_source_mix": mixing.op5_source_mix,
    "op6_main_text": pages.op6_main_text,
    "op7_suffix_dedup": suffixes.op7_suffix_dedup,
    "op8_bpe_round_trip": bpe.op8_bpe_round_trip,
    "op9_substring_dedup": substring.op9_substring_dedup,
    "op10_nearest": ann.op10_nearest,
    "op11_resample": resample.op11_resample,
    "op12_vector_codes": vectorcodes.op12_vector_codes,
    "op13_quality_rules": qualityrules.op13_quality_rules,
}

ORACLE = {
    "op2_exact_topk": topk.ORACLE,
    "op5_source_mix": mixing.ORACLE,
    "op11_resample": resample.ORACLE,
    "op12_vector_codes": vectorcodes.oracle(),
    "op13_quality_rules": qualityrules.oracle(),
}
