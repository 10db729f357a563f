"""The registered queries of this package, with their SQL where SQL can express them."""

from __future__ import annotations

from caseledger.llm import (
    alignment, decontamination, language, licenses, middle, mixing, near, packing, pseudonyms, spotsigs, substrings, topk, toxicity)

QUERIES = {
    "op1_feistel_pseudonyms": pseudonyms.op1_feistel_pseudonyms,
    "op2_spot_signatures": spotsigs.op2_spot_signatures,
    "op3_ftrl_toxicity": toxicity.op3_ftrl_toxicity,
    "op4_fast_similarity_sketch": near.op4_fast_similarity_sketch,
    "op5_pareto_mix": mixing.op5_pareto_mix,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_branch_and_bound": topk.op7_branch_and_bound,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_fm_index_substrings": substrings.op9_fm_index_substrings,
    "op10_string_kernel_language": language.op10_string_kernel_language,
    "op11_benchmark_decontamination": decontamination.op11_benchmark_decontamination,
    "op12_fill_in_middle": middle.op12_fill_in_middle,
    "op13_cross_tokenizer_alignment": alignment.op13_cross_tokenizer_alignment,
}
ORACLES = {
    "op2_spot_signatures": spotsigs.SQL,
    "op4_fast_similarity_sketch": near.SQL,
    "op5_pareto_mix": mixing.SQL,
    "op7_branch_and_bound": topk.SQL,
    "op9_fm_index_substrings": substrings.SQL,
    "op11_benchmark_decontamination": decontamination.SQL,
    "op12_fill_in_middle": middle.SQL,
}
