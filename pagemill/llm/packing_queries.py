"""Registered packing. SQL has no tokenizer; tests check every sequence."""

from __future__ import annotations

from .common import documents, tokenizer_file
from .packing import packed


def pack_documents(docs):
    return packed(docs, tokenizer_file("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def packing_query(spark, d):
    return pack_documents(documents(spark, d))


QUERIES = {"op4_best_fit_packing": packing_query}
ORACLE: dict[str, str] = {}
