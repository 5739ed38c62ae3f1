"""Registered token counts. SQL has no tokenizer; tests compare with the library."""

from __future__ import annotations


from .common import documents, tokenizer_file
from .token_counts import token_counts


def token_count_query(spark, d):
    return token_counts(documents(spark, d), tokenizer_file("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")


QUERIES = {"op9_token_counts": token_count_query}
ORACLE: dict[str, str] = {}
