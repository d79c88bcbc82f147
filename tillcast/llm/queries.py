"""Registered queries of the training-data operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from tillcast.llm.audit import OP12_SQL, op12_filter_audit
from tillcast.llm.chat import OP8_SQL, op8_preference_format
from tillcast.llm.language import op4_language_spans
from tillcast.llm.minhash import op9_minhash_groups
from tillcast.llm.mixing import OP2_SQL, op2_mix_sources
from tillcast.llm.packing import op5_best_fit_packing
from tillcast.llm.quality import op1_quality_classifier
from tillcast.llm.repair import op11_conversation_repair
from tillcast.llm.repetition import op6_repetition_rules
from tillcast.llm.secrets import OP13_SQL, op13_secret_owners
from tillcast.llm.sharding import op3_sampled_splitter_shards
from tillcast.llm.toxicity import op7_toxicity
from tillcast.llm.winnowing import op10_winnowing_fingerprints

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_mix_sources": op2_mix_sources,
    "op3_sampled_splitter_shards": op3_sampled_splitter_shards,
    "op4_language_spans": op4_language_spans,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_repetition_rules": op6_repetition_rules,
    "op7_toxicity": op7_toxicity,
    "op8_preference_format": op8_preference_format,
    "op9_minhash_groups": op9_minhash_groups,
    "op10_winnowing_fingerprints": op10_winnowing_fingerprints,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_filter_audit": op12_filter_audit,
    "op13_secret_owners": op13_secret_owners,
}

ORACLE = {
    "op2_mix_sources": OP2_SQL,
    "op8_preference_format": OP8_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_secret_owners": OP13_SQL,
}
