"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from genopile.llm import (
    conversation_repair,
    credentials,
    decontamination,
    host_rules,
    link_trust,
    merkle,
    mixing,
    packing,
    pivot_search,
    pu_quality,
    sharding,
    shingle_join,
    tool_calls,
)

QUERIES = {
    "op1_shingle_join": shingle_join.query,
    "op2_pu_quality": pu_quality.query,
    "op3_best_fit_packing": packing.query,
    "op4_label_shards": sharding.query,
    "op5_link_trust": link_trust.query,
    "op6_host_rules": host_rules.query,
    "op7_tool_calls": tool_calls.query,
    "op8_pivot_search": pivot_search.query,
    "op9_temperature_mixing": mixing.query,
    "op10_credential_links": credentials.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_merkle_manifest": merkle.query,
    "op13_decontamination": decontamination.query,
}
