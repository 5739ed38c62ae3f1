"""The vector index as a table: build, upsert, inspect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.layout import checked_broadcast


def index_build(chunks: DataFrame, vectors: DataFrame, chunk_id: str = "id",
                vector_id: str = "id", vector: str = "embedding") -> DataFrame:
    """``id, embedding, metadata`` for each chunk that has a vector."""
    keyed = vectors.select(F.col(vector_id).alias("id"), F.col(vector).alias("embedding"))
    described = chunks.select(
        F.col(chunk_id).alias("id"), F.struct("url", "content", "title").alias("metadata"))
    return keyed.join(described, "id")


def index_upsert(index: DataFrame, updates: DataFrame, key: str = "id",
                 version: str | None = None) -> DataFrame:
    """Rows of ``updates`` replace rows with the same key; the others are added.

    ``version`` names a column of ``updates`` that orders several rows of one key: the
    newest wins, a null version is the oldest, equal versions are ordered by a hash of the
    row. Without it the keys of ``updates`` must be unique, which is checked.
    """
    order = F.struct(*([F.col(version).isNotNull(), F.col(version)] if version else []), F.xxhash64(F.struct("*")))
    newest = updates.groupBy(key).agg(F.max_by(F.struct("*"), order).alias("_row"), F.count("*").alias("_n"))
    if not version:
        unique = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(F.lit("a key is updated twice")))
        newest = newest.withColumn("_row", unique)
    rows = newest.select("_row.*").drop(*([version] if version else []))
    kept = index.join(checked_broadcast(updates.select(key)), key, "left_anti")
    return kept.unionByName(rows.select(*index.columns))


def index_stats(index: DataFrame, vector: str = "embedding") -> DataFrame:
    """Size, dimensions, and rows whose vector cannot be searched."""
    v = F.col(vector)
    zero = F.forall(v, lambda x: x == 0)
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return index.agg(
        F.count("*").alias("n_rows"),
        F.min(F.array_size(v)).cast("bigint").alias("min_dim"),
        F.max(F.array_size(v)).cast("bigint").alias("max_dim"),
        count(v.isNull()).alias("n_null"),
        count(zero).alias("n_zero"),
        count(broken).alias("n_broken"),
    )


def index_gaps(chunks: DataFrame, vectors: DataFrame, chunk_id: str = "id",
               vector_id: str = "id") -> DataFrame:
    """Ids on one side only. One shuffle; copies of an id are combined before it."""
    side = lambda df, key, c, v: df.select(
        F.col(key).cast("bigint").alias("id"), F.lit(c).alias("has_chunk"), F.lit(v).alias("has_vector"))
    both = side(chunks, chunk_id, True, False).unionByName(side(vectors, vector_id, False, True))
    found = both.groupBy("id").agg(
        F.bool_or("has_chunk").alias("c"), F.bool_or("has_vector").alias("v"))
    return found.filter("not (c and v)").select(
        "id", F.when(F.col("c"), "no vector").otherwise("no chunk").alias("gap"))


def model_guard(index: DataFrame, model: str, dim: int, vector: str = "embedding") -> DataFrame:
    """Rows per model and dimension, and whether queries of ``model`` can use them."""
    kinds = index.groupBy("model", F.array_size(vector).cast("bigint").alias("dim")).agg(
        F.count("*").alias("n_rows"))
    return kinds.withColumn("usable", F.coalesce(
        (F.col("model") == model) & (F.col("dim") == dim), F.lit(False)))
