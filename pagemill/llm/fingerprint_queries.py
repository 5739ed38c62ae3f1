"""Registered fingerprints. Their hashes have no twin in SQL, so tests compare with brute force.

Where a short text leaves nothing to compare, ``near_edited`` and ``near_next`` are 0.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .ascending import with_part
from .common import documents
from .fingerprints import likeness, sketch, written

PART_ROWS = 256


def with_next(docs, id="doc_id", text="text"):
    """``part, id, text, sketch, next_text, next_sketch``: each row with the one that follows in
    ascending id (null last, equal ids by a hash of the text); the first follows the last.

    Texts move once, by part. The first row of each part is also dealt to the part before
    it. Those rows are found by id; there is one per part, so the list is broadcast. Equal rows
    follow each other in any order; a long text is held whole by one task, beside its successor.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_part(rows, "id", F.xxhash64("text"), PART_ROWS)
    order = [F.col("id").asc_nulls_last(), F.col("tie")]
    firsts = rows.groupBy("part").agg(F.min(F.struct(F.isnull("id").alias("none"), "id", "tie")).alias("first"))
    every = Window.partitionBy(F.lit(0)).orderBy("part")
    before = firsts.select("part", "first", F.coalesce(F.lag("part").over(every), F.max("part").over(
        every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("to"))
    named = before.select("part", "to", F.col("first.tie").alias("tie"), F.col("first.id").alias("first_id"))
    edges = (rows.join(F.broadcast(named), ["part", "tie"]).filter(F.col("id").eqNullSafe(F.col("first_id")))
             .groupBy("to").agg(F.any_value("id").alias("id"), F.any_value("text").alias("text"), F.any_value("tie").alias("tie"))
             .select(F.col("to").alias("part"), "id", "text", "tie", F.lit(True).alias("edge")))
    dealt = rows.select("part", "id", "text", "tie", F.lit(False).alias("edge")).unionByName(edges)
    count = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt.repartition(count, "part").withColumn("sketch", sketch(F.col("text")))
    row = Window.partitionBy("part").orderBy("edge", *order)
    return dealt.select("part", "id", "text", "edge", "sketch", F.lead("text").over(row).alias("next_text"),
                        F.lead("sketch").over(row).alias("next_sketch")).filter("not edge")


def fingerprint_query(spark, d):
    rows = with_next(documents(spark, d))
    n = F.length("text")
    moved = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - moved), F.substring(F.col("next_text"), F.lit(1), moved))
    rows = rows.select("*", n.cast("bigint").alias("n_chars"), edited.alias("edited"))
    rows = rows.select("id", "n_chars", "sketch", "next_sketch", F.explode(F.array(
        F.struct(F.sha2("edited", 256).alias("sha256"), sketch(F.col("edited")).alias("sketch")))).alias("edited"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_chars", F.col("edited.sha256").alias("edited_sha256"),
        written(F.col("sketch")).alias("fingerprint"), written(F.col("edited.sketch")).alias("edited_fingerprint"),
        F.coalesce(likeness(F.col("sketch"), F.col("edited.sketch")), F.lit(0.0)).alias("near_edited"),
        F.coalesce(likeness(F.col("sketch"), F.col("next_sketch")), F.lit(0.0)).alias("near_next"))


QUERIES = {"op7_document_fingerprints": fingerprint_query}
ORACLE: dict[str, str] = {}
