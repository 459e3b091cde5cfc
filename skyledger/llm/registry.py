"""The queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

import corpus_pipeline
from skyledger.llm import (
    contamination,
    convtrie,
    editprints,
    idfiles,
    jaccard,
    langid,
    lmscore,
    negatives,
    packing,
    secretscan,
    sharding,
    topk,
    warc,
)

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_warc_boundary_chain": warc.op2_warc_boundary_chain,
    "op3_cross_entropy_difference": lmscore.op3_cross_entropy_difference,
    "op4_assignment_secrets": secretscan.op4_assignment_secrets,
    "op5_language_filters": langid.op5_language_filters,
    "op6_wu_manber_contamination": contamination.op6_wu_manber_contamination,
    "op7_ball_tree_top_products": topk.op7_ball_tree_top_products,
    "op8_jaccard_links": jaccard.op8_jaccard_links,
    "op8_jaccard_components": jaccard.op8_jaccard_components,
    "op9_hash_tree_shards": sharding.op9_hash_tree_shards,
    "op10_token_id_files": idfiles.op10_token_id_files,
    "op11_edit_fingerprints": editprints.op11_edit_fingerprints,
    "op12_threshold_negatives": negatives.op12_threshold_negatives,
    "op13_conversation_trie": convtrie.op13_conversation_trie,
    "pipeline": corpus_pipeline.run,
}

TWINS: dict[str, str] = {
    "op2_warc_boundary_chain": warc.TWIN,
    "op6_wu_manber_contamination": contamination.TWIN,
    "op7_ball_tree_top_products": topk.TWIN,
    "op8_jaccard_links": jaccard.TWIN,
    "op8_jaccard_components": jaccard.TWIN_COMPONENTS,
    "op12_threshold_negatives": negatives.TWIN,
    "op13_conversation_trie": convtrie.TWIN,
}
