"""The registered queries of this part and their SQL."""

from __future__ import annotations

import corpus_pipeline
from tallyworks.llm import (
    bpe,
    conversation_repair,
    hashed_dedup,
    jaccard,
    packing,
    pii,
    preferences,
    projection_forest,
    quality_rules,
    rule_ensemble,
    suffix_dedup,
    token_alignment,
    token_files,
)

QUERIES = {
    "op1_rule_ensemble": rule_ensemble.op1_rule_ensemble,
    "op2_jaccard_join": jaccard.op2_jaccard_join,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_token_files": token_files.op4_token_files,
    "op5_projection_forest": projection_forest.op5_projection_forest,
    "op6_packing": packing.op6_packing,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_bpe": bpe.op8_bpe,
    "op9_preferences": preferences.op9_preferences,
    "op10_pii": pii.op10_pii,
    "op11_token_alignment": token_alignment.op11_token_alignment,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_hashed_dedup": hashed_dedup.op13_hashed_dedup,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op3_quality_rules": quality_rules.oracle(),
    "op9_preferences": preferences.oracle(),
    "op12_conversation_repair": conversation_repair.oracle(),
    "op13_hashed_dedup": hashed_dedup.oracle(),
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
