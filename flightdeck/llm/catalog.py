"""Queries of this package: name -> builder, and their oracle SQL."""

from __future__ import annotations

from flightdeck.llm import burst_trie, filter_audit, sharding
from flightdeck.llm.decontaminate import op7_benchmark_passages
from flightdeck.llm.jaccard_join import op8_ngram_jaccard_components
from flightdeck.llm.language_id import op3_language_id
from flightdeck.llm.packing import op5_genetic_packing
from flightdeck.llm.pfp_dedup import op10_prefix_free_dedup
from flightdeck.llm.quality_knn import op9_quality_neighbours
from flightdeck.llm.repair_store import op2_repair_token_files
from flightdeck.llm.secret_scan import op1_secret_scan
from flightdeck.llm.syncmers import op4_syncmer_fingerprints
from flightdeck.llm.token_cache import op11_digest_cached_counts

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_repair_token_files": op2_repair_token_files,
    "op3_language_id": op3_language_id,
    "op4_syncmer_fingerprints": op4_syncmer_fingerprints,
    "op5_genetic_packing": op5_genetic_packing,
    "op6_permutation_table_sharding": sharding.op6_permutation_table_sharding,
    "op7_benchmark_passages": op7_benchmark_passages,
    "op8_ngram_jaccard_components": op8_ngram_jaccard_components,
    "op9_quality_neighbours": op9_quality_neighbours,
    "op10_prefix_free_dedup": op10_prefix_free_dedup,
    "op11_digest_cached_counts": op11_digest_cached_counts,
    "op12_conversation_trie": burst_trie.op12_conversation_trie,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op6_permutation_table_sharding": sharding.ORACLE,
    "op12_conversation_trie": burst_trie.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
