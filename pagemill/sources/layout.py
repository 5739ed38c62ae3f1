"""Physical layout: spread small inputs, store what is used twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_dir

BROADCAST_BYTES = 32 << 20
SCAN_TASKS = 20_000
MAX_PARTITIONS = 100_000


def spread(df: DataFrame) -> DataFrame:
    """Shuffle a table read with fewer splits than cores, before work per row that
    costs more than the move. A large table has more splits and stays as it is.

    For plain reads only: counting the partitions of a plan with joins would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def gathered(df: DataFrame) -> DataFrame:
    """Bound the number of tasks of a scan where each task returns a partial result,
    by reading several splits in one task; nothing is shuffled."""
    return df.coalesce(max(SCAN_TASKS, 4 * df.sparkSession.sparkContext.defaultParallelism))


def partitioned(df: DataFrame, keys: tuple[str, ...], groups: int) -> DataFrame:
    """``df`` shuffled by ``keys`` with about one partition per group, where the
    session would use fewer: every group is a large unit of work."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(min(groups, MAX_PARTITIONS), *keys) if groups > usual else df


def checked_broadcast(keys: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Narrow key rows, marked for broadcast only when measured to be few bytes. They are
    stored, so measuring does not compute them twice."""
    keys = stored(keys, "keys")
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in keys.columns), F.lit(16))
    size = keys.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return F.broadcast(keys) if size <= max_bytes else keys


def stored(df: DataFrame, label: str, *folders: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, with a
    lineage that ends at files all executors can reach. A filter on a column of
    ``folders`` then reads only its part."""
    path = new_dir(df.sparkSession, label)
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pinned(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the column computed once per row.

    The optimizer copies an expression into every filter and projection above it;
    a generator with one element is a border it does not cross.
    """
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode_outer(F.array(column)).alias(column))
