"""Registered language identification. A fitted model has no twin in SQL; tests measure
its accuracy on held-out rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import documents
from .language import predict, train

LEARNED = 3   # of each three documents by crc32(doc_id), the one with
HELD_OUT = 1  # this remainder is not learned from


def _remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def train_on(docs):
    """The model of all labelled documents outside the held-out third."""
    return train(docs.filter(F.coalesce(_remainder(LEARNED) != HELD_OUT, F.lit(True))))


def language_query(spark, d):
    docs = documents(spark, d)
    held_out = F.coalesce(_remainder(LEARNED) == HELD_OUT, F.lit(False)).alias("held_out")
    found = predict(docs.select("text", F.struct("doc_id", held_out).alias("row")), train_on(docs), ["row"])
    return found.select("doc.row.doc_id", "doc.row.held_out", "lang_pred", "score", "rejected")


QUERIES = {"op2_language_id": language_query}
ORACLE: dict[str, str] = {}
