"""Registered alignment. SQL has no tokenizer; tests compare with brute force."""

from __future__ import annotations

from pyspark.sql import functions as F

from .alignment import alignments
from .common import documents, tokenizer_file


def alignment_query(spark, d):
    rows, _ = alignments(documents(spark, d), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    return rows.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {"op13_cross_tokenizer_alignment": alignment_query}
ORACLE: dict[str, str] = {}
