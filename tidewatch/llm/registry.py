"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import (
    byte_bpe, conversation_trie, decision_list, language, line_dedup, mixing, near_dup, packing,
    phrases, quality_zstd, sharding, topk, url_lists,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_histogram_sharding": sharding.op1_histogram_sharding,
        "op2_pattern_packing": packing.op2_pattern_packing,
        "op3_temporal_url_lists": url_lists.op3_temporal_url_lists,
        "op4_poisson_mixing": mixing.op4_poisson_mixing,
        "op5_kneser_ney_language": language.op5_kneser_ney_language,
        "op6_site_line_dedup": line_dedup.op6_site_line_dedup,
        "op7_compression_quality": quality_zstd.op7_compression_quality,
        "op8_decision_list": decision_list.op8_decision_list,
        "op9_minhash_hamming": near_dup.op9_minhash_hamming,
        "op10_nra_topk": topk.op10_nra_topk,
        "op11_byte_bpe": byte_bpe.op11_byte_bpe,
        "op12_conversation_trie": conversation_trie.op12_conversation_trie,
        "op13_collocations": phrases.op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_temporal_url_lists": url_lists.OP3_SQL,
        "op4_poisson_mixing": mixing.OP4_SQL,
        "op6_site_line_dedup": line_dedup.OP6_SQL,
        "op12_conversation_trie": conversation_trie.OP12_SQL,
        "op13_collocations": phrases.OP13_SQL,
    }
