"""The registered queries of this folder and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from activity_mart.llm import (
    byte_pair,
    chunk_dedup,
    collisions,
    context_tree,
    fill_middle,
    hard_negatives,
    kneser_ney,
    packing,
    rules,
    sharding,
    shingle_join,
    suffix_dedup,
    token_counts,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_pairs": byte_pair.op1_byte_pairs,
    "op2_shingle_join": shingle_join.op2_shingle_join,
    "op3_quality_rules": rules.op3_quality_rules,
    "op4_kneser_ney": kneser_ney.op4_kneser_ney,
    "op5_chunk_dedup": chunk_dedup.op5_chunk_dedup,
    "op6_collision_counting": collisions.op6_collision_counting,
    "op7_context_tree": context_tree.op7_context_tree,
    "op8_bin_completion": packing.op8_bin_completion,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_kd_shards": sharding.op10_kd_shards,
    "op11_fill_middle": fill_middle.op11_fill_middle,
    "op12_residue_negatives": hard_negatives.op12_residue_negatives,
    "op13_cover_suffixes": suffix_dedup.op13_cover_suffixes,
}

ORACLES: dict[str, str] = {
    "op3_quality_rules": rules.oracle_sql(),
    "op11_fill_middle": fill_middle.oracle_sql(),
    "op12_residue_negatives": hard_negatives.oracle_sql(),
}
