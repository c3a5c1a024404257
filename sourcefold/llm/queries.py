"""The queries opN_<name> of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import bpe, centroids, chat, decontamination, licences, neardup, prefixes, private, quality, setjoin, shuffling, substrings, tokenfiles

QUERIES = {
    "op1_benchmark_decontamination": decontamination.op1_benchmark_decontamination,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_private_data": private.op3_private_data,
    "op4_near_duplicates": neardup.op4_near_duplicates,
    "op5_reply_trees": chat.op5_reply_trees,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_token_files": tokenfiles.op7_token_files,
    "op8_shuffled_shards": shuffling.op8_shuffled_shards,
    "op9_forced_boundary_bpe": bpe.op9_forced_boundary_bpe,
    "op10_licence_sentences": licences.op10_licence_sentences,
    "op11_set_join": setjoin.op11_set_join,
    "op12_centroids": centroids.op12_centroids,
    "op13_prefix_trie": prefixes.op13_prefix_trie,
}

ORACLES = {
    "op1_benchmark_decontamination": decontamination.OP1_SQL,
    "op2_substring_dedup": substrings.OP2_SQL,
    "op4_near_duplicates": neardup.OP4_SQL,
    "op5_reply_trees": chat.OP5_SQL,
    "op6_quality_rules": quality.OP6_SQL,
    "op10_licence_sentences": licences.OP10_SQL,
    "op11_set_join": setjoin.OP11_SQL,
    "op12_centroids": centroids.OP12_SQL,
    "op13_prefix_trie": prefixes.OP13_SQL,
}
