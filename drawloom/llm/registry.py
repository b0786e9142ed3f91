"""Queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from drawloom.llm import exact_dedup, gumbel_segments, html_text, ngram_join, packing, quality_rules, reversed_search, revisits, suffix_dedup, token_files, token_overlap, toxicity, url_filter

QUERIES = {
    "op1_toxicity_severity": toxicity.query,
    "op2_ngram_jaccard_join": ngram_join.query,
    "op3_revisit_resolution": revisits.query,
    "op4_url_bloom_cascade": url_filter.query,
    "op5_quality_cascade": quality_rules.query,
    "op6_suffix_array_dedup": suffix_dedup.query,
    "op7_gumbel_segmentations": gumbel_segments.query,
    "op8_sum_of_squares_packing": packing.query,
    "op9_composite_text_density": html_text.query,
    "op10_chunk_exact_dedup": exact_dedup.query,
    "op11_token_bit_files": token_files.query,
    "op12_token_overlap_links": token_overlap.query,
    "op13_reversed_search": reversed_search.query,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op3_revisit_resolution": revisits.ORACLE,
    "op4_url_bloom_cascade": url_filter.ORACLE,
    "op5_quality_cascade": quality_rules.ORACLE,
    "op10_chunk_exact_dedup": exact_dedup.ORACLE,
    "op13_reversed_search": reversed_search.ORACLE,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
