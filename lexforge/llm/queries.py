"""Queries of the corpus operators, by name, and the SQL of those that SQL can express."""

from lexforge.llm import chat_format, exact_dedup, html_text, line_dedup, mixing, near_dedup, ngram_join, packing, toxicity, url_filter

QUERIES = {
    "op5_html_extraction": html_text.op5_html_extraction,
    "op7_chat_formatting": chat_format.op7_chat_formatting,
    "op8_embedding_near_dedup": near_dedup.op8_embedding_near_dedup,
    "op1_url_filter": url_filter.op1_url_filter,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op2_ngram_jaccard_join": ngram_join.op2_ngram_jaccard_join,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op6_toxicity": toxicity.op6_toxicity,
    "op10_mix": mixing.op10_mix,
}
ORACLES = {"op9_line_dedup": line_dedup.ORACLE, "op2_ngram_jaccard_join": ngram_join.ORACLE, "op3_exact_dedup": exact_dedup.ORACLE, "op10_mix": mixing.ORACLE}
