"""Queries and oracle SQL of this subpackage, for the entry module."""

from __future__ import annotations

from . import (bpe, fingerprints, hard_negatives, jaccard_join, line_dedup, mixing, prefix_trie, quality_rules,
               secret_scan, token_counts, token_files, toxicity, url_filters)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_bpe": bpe.op3_bpe,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_token_files": token_files.op5_token_files,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "quality_ablations": quality_rules.quality_ablations,
    "op7_fingerprints": fingerprints.op7_fingerprints,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_url_filters": url_filters.op13_url_filters,
}

ORACLE = {**mixing.ORACLE, **line_dedup.ORACLE, **quality_rules.ORACLE, **jaccard_join.ORACLE,
          **hard_negatives.ORACLE, **prefix_trie.ORACLE, **url_filters.ORACLE}
