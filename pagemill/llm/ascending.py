"""Parts of a table in ascending order of an integer key, for work along that order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COARSE = 128            # quantiles of the key
MAX_PARTS = 100_000     # so a table with one row per part can be broadcast


def with_part(df: DataFrame, key: str, tie: Column, rows: int) -> DataFrame:
    """``df`` with ``part`` (about ``rows`` rows each) and ``tie``.

    Parts follow the order of ``key`` (ascending, null last; null keys in the order of
    ``tie``, a 64-bit hash). Between quantiles of the key the parts have equal width; at
    most ``MAX_PARTS`` of them exist, so beyond that they grow.
    """
    marks = [i / COARSE for i in range(1, COARSE)]
    total, low, high, cuts = df.agg(
        F.count("*"), F.min(key), F.max(key), F.percentile_approx(F.col(key), marks, 10_000)).first()
    fine = min(MAX_PARTS // (2 * COARSE), max(1, -(-total // (rows * COARSE))))
    cuts = sorted(set(cuts or []) - {low})
    edges = [low or 0, *cuts, (high or 0) + 1]
    k, at = F.col(key), F.lit(cuts).cast("array<bigint>") if cuts else F.array().cast("array<bigint>")
    lower, upper = F.lit(edges[:-1]).cast("array<bigint>"), F.lit(edges[1:]).cast("array<bigint>")
    # A table of a few rows per coarse range is not cut that finely.
    merge = max(1, rows * COARSE // max(1, total))
    coarse = F.size(F.filter(at, lambda c: c <= k))
    within = F.floor((k - F.get(lower, coarse)) / (F.get(upper, coarse) - F.get(lower, coarse)) * fine)
    ranged = F.floor((coarse * fine + F.least(within, F.lit(fine - 1))) / merge)
    unkeyed = COARSE * fine + F.floor((tie.cast("double") / 2.0 ** 64 + 0.5) * (COARSE * fine))
    return df.withColumn("tie", tie).withColumn("part", F.coalesce(ranged, unkeyed).cast("bigint"))
