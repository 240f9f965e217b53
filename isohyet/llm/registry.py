"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from isohyet.llm import (context_mixing, decontaminate, language_id, merkle_manifest, minhash_dedup, ordinal_quality, personal_data, pieces,
                         quality_rules, substring_dedup, target_resampling, tool_calls, warc)

QUERIES = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_ordinal_quality": ordinal_quality.op3_ordinal_quality,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_warc": warc.op5_warc,
    "op6_minhash_dedup": minhash_dedup.op6_minhash_dedup,
    "op7_context_mixing": context_mixing.op7_context_mixing,
    "op8_tool_calls": tool_calls.op8_tool_calls,
    "op9_language_id": language_id.op9_language_id,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_merkle_manifest": merkle_manifest.op11_merkle_manifest,
    "op12_personal_data": personal_data.op12_personal_data,
    "op13_target_resampling": target_resampling.op13_target_resampling,
}

ORACLE = {
    "op4_decontaminate": decontaminate.SQL,
    "op5_warc": warc.SQL,
    "op6_minhash_dedup": minhash_dedup.SQL,
    "op8_tool_calls": tool_calls.SQL,
    "op10_quality_rules": quality_rules.SQL,
    "op11_merkle_manifest": merkle_manifest.SQL,
    "op13_target_resampling": target_resampling.SQL,
}
