"""All registered training-data queries with their SQL."""

from __future__ import annotations

from . import (
    alignment_queries,
    chat_queries,
    fingerprint_queries,
    language_queries,
    merkle_queries,
    mixing_queries,
    near_duplicate_queries,
    packing_queries,
    quality_queries,
    secret_queries,
    token_count_queries,
    token_file_queries,
    toxicity_queries,
)

_MODULES = (
    mixing_queries, language_queries, secret_queries, packing_queries, toxicity_queries, near_duplicate_queries, fingerprint_queries, token_file_queries,
    token_count_queries, quality_queries, chat_queries, merkle_queries, alignment_queries,
)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
