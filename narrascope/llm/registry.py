"""Names of the corpus queries and their SQL."""

import corpus_pipeline
from narrascope.llm import oracles, queries

LLM_QUERIES = {
    "op1_exact_dedup": queries.op1_exact_dedup,
    "op2_line_dedup": queries.op2_line_dedup,
    "op3_substring_dedup": queries.op3_substring_dedup,
    "op4_best_fit_packing": queries.op4_best_fit_packing,
    "op5_token_counts": queries.op5_token_counts,
    "op6_bpe_encode_decode": queries.op6_bpe_encode_decode,
    "op7_quality_rules": queries.op7_quality_rules,
    "op8_quality_classifier": queries.op8_quality_classifier,
    "op9_simhash_near_dedup": queries.op9_simhash_near_dedup,
    "op10_token_files": queries.op10_token_files,
    "op11_tokenizer_alignment": queries.op11_tokenizer_alignment,
    "op12_html_extraction": queries.op12_html_extraction,
    "op13_phrase_collocations": queries.op13_phrase_collocations,
    "pipeline": corpus_pipeline.run,
}

LLM_ORACLES = {
    "op1_exact_dedup": oracles.EXACT_DEDUP,
    "op2_line_dedup": oracles.LINE_DEDUP,
    "op13_phrase_collocations": oracles.COLLOCATIONS,
}
