"""Registered token files. SQL has no tokenizer; tests compare with the library."""

from __future__ import annotations

from ..session import new_dir
from .common import documents, tokenizer_file
from .token_files import read_documents, write_token_files


def token_file_query(spark, d):
    path = new_dir(spark, "token-files")
    write_token_files(documents(spark, d), path, tokenizer_file("word_bpe_49k.json"))
    return read_documents(spark, path).withColumnRenamed("id", "doc_id")


QUERIES = {"op8_token_files": token_file_query}
ORACLE: dict[str, str] = {}
