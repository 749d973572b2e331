"""The registered queries of this subpackage, and SQL where it can express them."""

from __future__ import annotations

from offerquarry.llm import (
    fill_middle,
    katz_model,
    license_scan,
    minhash_dedup,
    neighbour_graph,
    personal_data,
    quality_rules,
    rule_ensemble,
    sentence_pieces,
    source_mix,
    toxicity,
    vector_codes,
    web_archives,
)

QUERIES = {
    "op1_minhash_dedup": minhash_dedup.op1_minhash_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_source_mix": source_mix.op3_source_mix,
    "op4_web_archives": web_archives.op4_web_archives,
    "op5_sentence_pieces": sentence_pieces.op5_sentence_pieces,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_personal_data": personal_data.op7_personal_data,
    "op8_neighbour_graph": neighbour_graph.op8_neighbour_graph,
    "op9_rule_ensemble": rule_ensemble.op9_rule_ensemble,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_fill_in_middle": fill_middle.op11_fill_in_middle,
    "op12_katz_model": katz_model.op12_katz_model,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}

ORACLES = {
    "op4_web_archives": web_archives.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op11_fill_in_middle": fill_middle.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}
