"""Versions of a table with a tree of digests, compared without reading what is equal.

Rows lie in leaves by ranges of a hash of their key, so the leaves of any two versions hold the
same keys. A leaf's digest follows from its keys and contents; above, ``FAN`` neighbouring nodes
have one digest together, up to the root. Two versions are compared from the root down: a level is
read only below nodes that differ, and rows only of the leaves that differ.

    rows/leaf=L      key and content of the rows
    level=N          node, digest; level 0 are the leaves

Both versions have the same number of leaves and the same content columns. Keys are unique in
a version; rows with a null key cannot be told apart and are left out, as no diff can name them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .changes import snapshot_diff

FAN_BITS = 4
LEAF_BITS = 12      # 4,096 leaves
LEVEL = "node bigint, digest string, rows bigint"


def _leaf(key: str, bits: int):
    """The upper bits of a hash, so that a range of them is a node on any level."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits).cast("int")


def write_version(df: DataFrame, path: str, key: str, content: list[str], leaf_bits: int = LEAF_BITS) -> None:
    """Write ``key`` and ``content`` (strings) of all rows with their digests to ``path``."""
    rows = df.filter(F.col(key).isNotNull()).select(key, *content).withColumn("leaf", _leaf(key, leaf_bits))
    rows.hint("rebalance", "leaf").sortWithinPartitions("leaf").write.mode("overwrite").partitionBy("leaf").parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(_schema(df, key, content)).parquet(f"{path}/rows")
    told = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in content]
    row = F.sha2(F.concat_ws("|", F.col(key).cast("string"), *told), 256)
    # Parts of the rows' digests, each summed: no order, no list, and equal only for equal rows.
    parts = [F.conv(F.substring(row, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]
    leaves = stored.groupBy(F.col("leaf").cast("bigint").alias("node")).agg(
        *(F.sum(p).alias(f"s{i}") for i, p in enumerate(parts)), F.count("*").alias("rows")).select(
        "node", F.md5(F.concat_ws("|", "rows", *(f"s{i}" for i in range(4)))).alias("digest"), "rows")
    level, bits = 0, leaf_bits
    while True:
        leaves.coalesce(1).sortWithinPartitions("node").write.mode("overwrite").parquet(f"{path}/level={level}")
        if bits <= 0:
            return
        below = df.sparkSession.read.schema(LEVEL).parquet(f"{path}/level={level}")
        children = F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda c: F.concat(c["node"].cast("string"), F.lit(":"), c["digest"]))
        leaves = below.groupBy(F.shiftright("node", FAN_BITS).alias("node")).agg(
            F.md5(F.array_join(children, "|")).alias("digest"), F.sum("rows").alias("rows"))
        level, bits = level + 1, bits - FAN_BITS


def _schema(df: DataFrame, key: str, content: list[str]) -> T.StructType:
    return T.StructType([*(df.schema[c] for c in (key, *content)), T.StructField("leaf", T.IntegerType())])


def differing_leaves(spark: SparkSession, old: str, new: str, leaf_bits: int = LEAF_BITS) -> list[int]:
    """Leaves whose rows differ, found from the root down; at most all leaves, a bounded number."""
    differing = None
    for level in reversed(range(-(-leaf_bits // FAN_BITS) + 1)):
        sides = []
        for path in (old, new):
            nodes = spark.read.schema(LEVEL).parquet(f"{path}/level={level}")
            if differing is not None:
                below = [(F.col("node") >= n << FAN_BITS) & (F.col("node") < (n + 1) << FAN_BITS) for n in differing]
                if len(below) > 64:     # a long list of ranges is a list of parents
                    parents = spark.createDataFrame([(n,) for n in differing], "parent bigint")
                    nodes = nodes.join(F.broadcast(parents), F.shiftright("node", FAN_BITS) == F.col("parent"), "left_semi")
                else:
                    found = F.lit(False)
                    for b in below:
                        found = found | b
                    nodes = nodes.filter(found)
            sides.append(nodes.select("node", "digest"))
        both = sides[0].join(sides[1].withColumnRenamed("digest", "other"), "node", "full_outer")
        differing = sorted(r["node"] for r in both.filter(~F.col("digest").eqNullSafe(F.col("other"))).select("node").collect())
        if not differing:
            return []
    return differing


def version_diff(spark: SparkSession, old: str, new: str, key: str, content: list[str], like: DataFrame, leaf_bits: int = LEAF_BITS) -> DataFrame:
    """``snapshot_diff`` of two versions, from the rows of differing leaves alone. ``like`` has
    the columns of the versions."""
    leaves = differing_leaves(spark, old, new, leaf_bits)
    schema = _schema(like, key, content)
    sides = [spark.read.schema(schema).parquet(f"{path}/rows").filter(F.col("leaf").isin(leaves)) for path in (old, new)]
    return snapshot_diff(*sides, key, content)
