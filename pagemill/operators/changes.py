"""Changes between table versions, deletes, appends, newest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.layout import checked_broadcast


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, content: list[str]) -> DataFrame:
    """``key, change, old_hash, new_hash`` of inserted, updated and deleted rows.

    Rows are reduced to a hash before they move; ``key`` is unique in each version.
    """
    def hashed(df: DataFrame, name: str) -> DataFrame:
        parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
                 for c in content]
        return df.select(key, F.md5(F.concat_ws("|", *parts)).alias(name))

    both = hashed(old, "old_hash").join(hashed(new, "new_hash"), key, "full_outer")
    change = (F.when(F.col("old_hash").isNull(), "insert")
              .when(F.col("new_hash").isNull(), "delete")
              .when(F.col("old_hash") != F.col("new_hash"), "update"))
    return (both.withColumn("change", change).filter("change is not null")
            .select(key, "change", "old_hash", "new_hash"))


def apply_diff(old: DataFrame, diff: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` brought up to date with the rows the diff names."""
    kept = old.join(checked_broadcast(diff.select(key)), key, "left_anti")
    fresh = new.join(checked_broadcast(diff.filter("change <> 'delete'").select(key)), key, "left_semi")
    return kept.unionByName(fresh)


def delete_where(df: DataFrame, key: str, value) -> DataFrame:
    """All rows but those whose key equals the value; a null key equals nothing."""
    return df.filter(~F.col(key).eqNullSafe(F.lit(value)) | F.col(key).isNull())


def delete_by_key(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """All rows but those whose key is in ``keys``."""
    return df.join(checked_broadcast(keys.select(key)), key, "left_anti")


def append_evolve(df: DataFrame, more: DataFrame) -> DataFrame:
    """Append rows that may have other columns; absent ones become null."""
    return df.unionByName(more, allowMissingColumns=True)


def latest_by_name(df: DataFrame, name_column: str, name, date_column: str, tie: str) -> DataFrame:
    """Newest row of one name."""
    return (df.filter(F.col(name_column) == name)
            .orderBy(F.desc(date_column), F.desc(tie)).limit(1))


def latest_per_key(df: DataFrame, key: str, date_column: str, tie: str) -> DataFrame:
    """Newest row of every key, by an aggregate that combines before the shuffle."""
    others = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*others), F.struct(date_column, tie)).alias("_row")
    return df.groupBy(key).agg(newest).select(key, "_row.*")


def get_or_insert(existing: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """``existing`` plus the first incoming row, by ``order``, of each absent key.

    Both sides are reduced to one row per key before they meet.
    """
    first = incoming.groupBy(key).agg(
        F.min_by(F.struct(*incoming.columns), F.col(order)).alias("_row")).select("_row.*")
    absent = first.join(existing.select(key).distinct(), key, "left_anti")
    return existing.unionByName(absent.select(*existing.columns))
