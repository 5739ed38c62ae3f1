"""A table in one global order: bounded parts of it, and where each row stands in its group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.layout import checked_broadcast, stored

PART_ROWS = 200_000


def in_order(rows: DataFrame, order: list[Column], n_rows: int, part_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` range-partitioned and sorted by ``order``, with ``mid``: the part (above bit 33)
    and the place in it. ``order`` must tell any two rows apart, so no value is too large for
    one part. The caller stores the result, which fixes ``mid``.
    """
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows // part_rows))
    return (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
            .withColumn("mid", F.monotonically_increasing_id()))


def part() -> Column:
    return F.shiftright("mid", 33)


def place() -> Column:
    return F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))


def ranked(rows: DataFrame, group: str, order: list[Column], label: str, part_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` with ``rank`` (from 0) in the group and ``n``, the rows of the group.

    Groups follow each other (null first) and rows inside them in ``order``; equal rows are
    told apart by a number that is stored with them. A group may hold any share of the rows:
    it spans many parts, and what comes before a part in its group is added from a table of
    one row per part and group.
    """
    numbered = stored(rows.withColumn("copy_no", F.monotonically_increasing_id()), f"{label}-rows")
    whole = [F.col(group).asc_nulls_first(), *order, F.col("copy_no")]
    placed = stored(in_order(numbered, whole, numbered.count(), part_rows).drop("copy_no"), f"{label}-order")
    placed = placed.withColumn("part", part())
    runs = placed.groupBy("part", group).agg(F.count("*").alias("rows"), F.min(place()).alias("first"))
    all_of = Window.partitionBy(group)
    ahead = all_of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(F.col("part").alias("_part"), F.col(group).alias("_group"),
                         (F.coalesce(F.sum("rows").over(ahead), F.lit(0)) - F.col("first")).alias("_shift"),
                         F.sum("rows").over(all_of).alias("n"))
    joined = placed.join(checked_broadcast(starts), (F.col("part") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn("rank", place() + F.col("_shift")).drop("mid", "part", "_part", "_group", "_shift")


def running(placed: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """``placed`` with ``out``: the sum of ``value`` over the rows before, in the same group.

    ``placed`` is a stored table with ``part`` and ``mid``, ordered by group first, so at most one
    group of each part begins in an earlier one. Only that one's carry is broadcast.
    """
    before = Window.unboundedPreceding, -1
    local = Window.partitionBy("part", group).orderBy("mid").rowsBetween(*before)
    sums = placed.groupBy("part", group).agg(F.sum(value).alias("_sum"))
    ahead = F.sum("_sum").over(Window.partitionBy(group).orderBy("part").rowsBetween(*before))
    carry = sums.select(F.col("part").alias("_part"), F.col(group).alias("_group"), ahead.alias("_carry")).filter("_carry > 0")
    rows = placed.withColumn(out, F.coalesce(F.sum(value).over(local), F.lit(0)))
    met = (F.col("part") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group"))
    return (rows.join(checked_broadcast(carry), met, "left")
            .withColumn(out, F.col(out) + F.coalesce("_carry", F.lit(0))).drop("_part", "_group", "_carry"))
