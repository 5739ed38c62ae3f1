"""Equi-joins and per-key history that survive one very large key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.layout import checked_broadcast, stored

HOT_ROWS = 1_000_000
SALTS = 64
RANGE_ROWS = 100_000


def skew_join(
    left: DataFrame, right: DataFrame, key: str, spread: str, how: str = "inner",
    hot_rows: int = HOT_ROWS, salts: int = SALTS, *, partitions: int | None = None,
) -> DataFrame:
    """``left`` joined to a ``right`` that is unique on ``key``.

    Keys with more than ``hot_rows`` rows in ``left`` are spread over ``salts``
    parts by the column ``spread``; only their ``right`` rows are replicated. At
    most rows / ``hot_rows`` keys can be hot, which bounds the broadcast list. The result
    has as many ``partitions`` as are asked for.
    """
    hot = (left.groupBy(key).agg(F.count("*").alias("_n"))
           .filter(F.col("_n") > hot_rows)
           .select(F.col(key), F.lit(True).alias("_hot")))
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    spread_left = (left.join(F.broadcast(hot), key, "left")
                   .withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(0)))
                   .drop("_hot"))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread_right = (right.join(F.broadcast(hot), key, "left")
                    .withColumn("_salt", F.explode(copies)).drop("_hot"))
    if partitions:
        spread_left, spread_right = (side.repartition(partitions, key, "_salt") for side in (spread_left, spread_right))
    return spread_left.join(spread_right, [key, "_salt"], how).drop("_salt")


def in_ranges(df: DataFrame, key: str, order: str, width: int = RANGE_ROWS) -> DataFrame:
    """``df`` stored in ranges of ``(key, order)`` with about ``width`` rows each, numbered by
    ``_range`` in that order (null keys first). Ranges are cut by counts of rows, so neither a
    large key nor orders far apart, such as time stamps, make one large or very many.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // width))
    ranged = df.repartitionByRange(parts, F.col(key).asc_nulls_first(), F.col(order).asc_nulls_first())
    return stored(ranged.withColumn("_range", F.spark_partition_id()), "ranges")


def preceding_rows(
    df: DataFrame, key: str, order: str, payload: list[str], n: int, out: str = "history",
    width: int = RANGE_ROWS,
) -> DataFrame:
    """Add an array with the payload of the last ``n`` rows before each row.

    ``order`` is unique within ``key``. A task sorts the rows of one range. Only a key that
    spans ranges needs rows of earlier ones: the last ``n`` rows of each of its ranges are
    carried to the ``n`` ranges that follow, which hold at least ``n`` rows.
    """
    entry = F.struct(order, *payload)
    parts = in_ranges(df, key, order, width)
    own = Window.partitionBy(key, "_range").orderBy(order)
    rows = parts.withColumn("_own", F.collect_list(entry).over(own.rowsBetween(-n, -1)))

    # Every range but the first begins in at most one such key.
    spans = checked_broadcast(parts.groupBy(key).agg(F.min("_range").alias("_from"), F.max("_range").alias("_to"))
                              .filter("_to > _from").select(F.col(key).alias("_key"), "_to"))
    newest_first = Window.partitionBy(key, "_range").orderBy(F.desc(order))
    tails = (parts.join(spans, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") < F.col("_to")))
             .select(key, "_range", order, *payload)
             .withColumn("_back", F.row_number().over(newest_first))
             .filter(F.col("_back") <= n)
             .groupBy(key, "_range")
             .agg(F.array_sort(F.collect_list(entry)).alias("_tail")))
    carried = (parts.join(spans, F.col(key).eqNullSafe(F.col("_key"))).select(key, "_range").distinct()
               .join(tails.select(F.col(key).alias("_key"), F.col("_range").alias("_of"), "_tail"),
                     F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_of")), "left"))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(-n, -1)
    carry = (carried.select(F.col(key).alias("_key"), F.col("_range").alias("_of"), F.flatten(F.filter(
                F.collect_list(F.coalesce("_tail", F.array().cast(tails.schema["_tail"].dataType))).over(before), lambda t: F.size(t) > 0)).alias("_carry"))
             .filter(F.size("_carry") > 0))

    joined = rows.join(carry, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_of")), "left")
    both = F.concat(F.coalesce(F.col("_carry"), F.expr("slice(_own, 1, 0)")), F.col("_own"))
    last = F.slice(both, F.greatest(F.size(both) - n + 1, F.lit(1)), F.lit(n))
    return joined.withColumn(out, last).drop("_range", "_own", "_carry", "_key", "_of")
