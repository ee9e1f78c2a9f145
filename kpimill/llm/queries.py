"""The dealt operators as queries over their whole tables."""

from __future__ import annotations

from kpimill.llm import (  # noqa: F401
    byte_bpe_query,
    chat_query,
    exact_dedup_query,
    merkle_query,
    minhash_query,
    multi_index_query,
    packing_query,
    prefix_trie_query,
    quality_query,
    substring_dedup_query,
    suffix_dedup_query,
    token_files_query,
    toxicity_query,
)
from kpimill.llm.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
