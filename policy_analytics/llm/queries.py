"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import (bwt_dedup, exact_dedup, language_model, mixing, near_dedup, packing, periodic_runs,
               sharding, token_alignment, topk, toxicity, url_filter, warc)

QUERIES = {
    "op1_label_propagation_shards": sharding.op1_label_propagation_shards,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_warc_roundtrip": warc.op3_warc_roundtrip,
    "op4_lexicon_automaton_toxicity": toxicity.op4_lexicon_automaton_toxicity,
    "op5_token_indexed_url_rules": url_filter.op5_token_indexed_url_rules,
    "op6_order_minhash_classes": near_dedup.op6_order_minhash_classes,
    "op7_attention_lm_scores": language_model.op7_attention_lm_scores,
    "op8_bit_sliced_topk": topk.op8_bit_sliced_topk,
    "op9_source_mixing": mixing.op9_source_mixing,
    "op10_chunk_recipe_dedup": exact_dedup.op10_chunk_recipe_dedup,
    "op11_synchronised_runs": periodic_runs.op11_synchronised_runs,
    "op12_bounded_interval_expansion": bwt_dedup.op12_bounded_interval_expansion,
    "op13_shared_cut_alignment": token_alignment.op13_shared_cut_alignment,
}
ORACLES = {
    "op3_warc_roundtrip": warc.ORACLE,
    "op5_token_indexed_url_rules": url_filter.ORACLE,
    "op8_bit_sliced_topk": topk.ORACLE,
    "op10_chunk_recipe_dedup": exact_dedup.ORACLE,
}
