"""Registered toxicity scores. A fitted model has no twin in SQL; tests measure it on
held-out rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.layout import stored
from .common import documents
from .toxicity import score, train

LEARNED = 4   # of each four documents by crc32(doc_id), the one with
HELD_OUT = 2  # this remainder is not learned from


def _remainder():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(LEARNED))


def toxicity_query(spark, d):
    docs = documents(spark, d)
    labels = spark.read.parquet(f"{d}/labels.parquet").filter(_remainder() != HELD_OUT)
    model = train(docs, labels, lambda df: stored(df, "labelled"))
    held_out = F.coalesce(_remainder() == HELD_OUT, F.lit(False)).alias("held_out")
    scored = score(docs.select("text", F.struct("doc_id", held_out).alias("row")), model, ["row"])
    return scored.select("doc.row.doc_id", "doc.row.held_out", "score", "predicted")


QUERIES = {"op5_toxicity": toxicity_query}
ORACLE: dict[str, str] = {}
