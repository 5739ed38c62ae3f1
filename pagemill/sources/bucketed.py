"""Tables in buckets of a key, joined without moving their rows again.

A table is written once into a fixed number of buckets by a hash of the key, sorted by it inside
each. Two such tables with the same number of buckets have the same keys in the same bucket, so
a join on the key reads both where they lie. A key with very many rows makes its bucket large; use
``operators.joins.skew_join`` where one may.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_dir

BUCKETS = 64


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """Write ``df`` as the table ``name``, replacing it, and return it.

    Rows are dealt by key before, so that every bucket is one file. ``path`` is a folder
    of its own by default, in the shared folder.
    """
    spark = df.sparkSession
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path or new_dir(spark, name)).saveAsTable(name))
    return spark.table(name)


def in_key_order(rows: DataFrame, key: str, ranges: int) -> DataFrame:
    """``rows`` with ``range``, the number of the range of ``key`` that holds them, from 0 on.

    Ranges are cut by quantiles of the key alone. Written by ``range``, the folders are in the
    order of the key, whatever bucket the rows come from: no row is moved for it.
    """
    marks = [i / ranges for i in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx(F.col(key), marks, 10_000)).first()[0] if marks else []
    edges = F.lit(sorted(set(cuts or []))).cast("array<bigint>") if cuts else F.array().cast("array<bigint>")
    return rows.withColumn("range", F.size(F.filter(edges, lambda e: e <= F.col(key))))
