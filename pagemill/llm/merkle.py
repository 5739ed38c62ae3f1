"""A Merkle manifest: one digest per row, trees of digests per group, and a proof for each row.

A row's place in its group, written to base ``FAN``, tells its way from the root: each digit
is the place among siblings. Rows of one block (``FAN ** LEVELS`` consecutive ones) lie in one
partition; there the digit columns are grouped away one after the other, the lowest first, and
every group becomes a struct that holds its children. One shuffle serves all levels of a block.
The digests of blocks are rows again, ranked by block, until a group has one block. Proofs go
the other way: the nested structs are taken apart level by level, and each child gets what its
parent has plus the digests beside it. No join is made; what a block has from above meets it by
grouping on the block.

Rules, as the digests are part of a format: a group's nodes are joined in runs of ``FAN`` (the
last may be shorter, even one node) while it has more than one; a lone node is left as it is.
The groups' own roots, ordered by group (null first, UTF-8 bytes), are joined likewise.

Null values are ``-``; a null id comes last in its group, a null group is a group. Rows with
one id follow the digest; equal rows are leaves of their own. Long texts are hashed where they
lie and never moved. An empty table has no rows. Other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.layout import stored
from .ordered import ranked

FAN, BITS = 8, 3
LEVELS = 4          # levels inside a block: at most 4,096 leaves


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(columns: dict[str, Column]) -> Column:
    """Digest of a row: of each value its bytes in UTF-8 with their number, ``-`` for null."""
    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return digest(*map(told, columns.values()))


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def _blocks(nodes: DataFrame, below: int) -> DataFrame:
    """One row per block of ``group, rank, n, digest, payload``: its digest and ``tree``, the
    nested structs. ``below`` is the number of levels under these nodes; ``n`` counts leaves.
    """
    digits = [f"d{k}" for k in range(LEVELS)]
    split = nodes.select(
        "group", F.shiftright("rank", BITS * LEVELS).alias("block"), "n", F.struct("digest", "payload").alias("node"),
        *(F.shiftright("rank", BITS * k).bitwiseAND(F.lit(FAN - 1)).cast("int").alias(d) for k, d in enumerate(digits)))
    split = split.repartition("group", "block")
    for k, d in enumerate(digits):
        children = F.transform(F.array_sort(F.collect_list(F.struct(F.col(d), F.col("node")))), lambda c: c["node"])
        grouped = split.groupBy("group", "block", *digits[k + 1:]).agg(F.first("n").alias("n"), children.alias("children"))
        # The level exists where the group has more than one node on it.
        many = F.col("n") > FAN ** (below + k)
        up = F.when(many, F.sha2(_joined(F.transform("children", lambda c: c["digest"])), 256)).otherwise(F.col("children")[0]["digest"])
        split = grouped.select("group", "block", "n", *digits[k + 1:], F.struct(up.alias("digest"), F.col("children").alias("payload")).alias("node"))
    return split.select("group", "block", "n", F.col("node.digest").alias("digest"), F.col("node.payload").alias("tree"))


def _taken_apart(blocks: DataFrame, below: int) -> DataFrame:
    """``group, n, digest, payload, path`` of the nodes of blocks that come with their own ``path``.

    ``path`` lists, from the root down, what stands before and after on each level.
    """
    rows = blocks.select("group", "n", "path", F.col("tree").alias("children"), F.col("block").alias("rank"))
    for k in reversed(range(LEVELS)):
        all_of = F.col("children")
        def placed(child: Column, i: Column) -> Column:
            of = lambda part: _joined(F.transform(part, lambda c: c["digest"]))
            beside = F.struct(of(F.slice(all_of, F.lit(1), i)).alias("before"),
                              of(F.slice(all_of, i + 2, F.lit(FAN))).alias("after"))
            path = F.when(F.col("n") > FAN ** (below + k), F.concat(F.col("path"), F.array(beside))).otherwise(F.col("path"))
            return F.struct(child["digest"].alias("digest"), child["payload"].alias("payload"), path.alias("path"),
                            (F.col("rank") * FAN + i).alias("rank"))
        rows = rows.select("group", "n", F.explode(F.transform(all_of, placed)).alias("at"))
        rows = rows.select("group", "n", "at.path", "at.rank", "at.digest", F.col("at.payload").alias("children"))
    return rows.withColumnRenamed("children", "payload")


_PATH = "array<struct<before:string,after:string>>"


def trees(nodes: DataFrame, above: DataFrame | None = None, label: str = "merkle"):
    """Trees over ``group, rank, n, digest, payload``.

    Returns the roots (``group, digest``) and a function that turns ``group, path`` of the
    roots (in a tree above them) into ``group, rank, digest, payload, path`` of all nodes.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    layers, below, level = [], 0, nodes
    while True:
        blocks = stored(_blocks(level, below), f"{label}-blocks")
        layers.append((blocks, below))
        below += LEVELS
        if most <= FAN ** below:
            break
        level = blocks.select("group", F.col("block").alias("rank"), "n", "digest", F.lit(None).cast("int").alias("payload"))
    roots = layers[-1][0].select("group", "digest")

    def proofs(root_paths: DataFrame) -> DataFrame:
        paths = root_paths.select("group", F.lit(0).cast("bigint").alias("block"), F.col("path").cast(_PATH).alias("path"))
        for i, (blocks, under) in reversed(list(enumerate(layers))):
            # Both have one row per block, so a group of this grouping is two rows.
            none = blocks.schema["tree"].dataType
            both = blocks.withColumn("path", F.lit(None).cast(_PATH)).select("group", "block", "n", "tree", "path").unionByName(
                paths.select("group", "block", F.lit(None).cast("bigint").alias("n"), F.lit(None).cast(none).alias("tree"), "path"))
            met = both.groupBy("group", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("n", "tree", "path")))
            rows = _taken_apart(met, under)
            paths = rows.select("group", F.col("rank").alias("block"), "path")
        return rows
    return roots, proofs


def manifest(rows: DataFrame, label: str = "merkle") -> DataFrame:
    """``group, rank, leaf, payload, subroot, root, path`` of each row of ``group`` (string), ``id``
    (integer), ``leaf`` (a digest) and ``payload`` (whatever goes with it).

    ``path`` lists from the leaf up the digests ``before`` and ``after`` it among its siblings,
    joined; a level with no sibling has two empty strings.
    """
    session = rows.sparkSession
    leaves = ranked(rows.select("group", "id", "leaf", "payload"), "group", [F.col("id").asc_nulls_last(), F.col("leaf")], f"{label}-leaves")
    subroots, leaf_proofs = trees(leaves.select("group", "rank", "n", F.col("leaf").alias("digest"), "payload"), label=label)
    # The groups are the leaves of one tree above; it has one group of its own.
    tops = ranked(subroots.select(F.lit("").alias("one"), F.col("group").alias("id"), F.col("digest").alias("leaf"), F.col("group").alias("payload")),
                  "one", [F.col("id").asc_nulls_first()], f"{label}-groups")
    roots, group_proofs = trees(tops.select(F.col("one").alias("group"), "rank", "n", F.col("leaf").alias("digest"), "payload"), label=f"{label}-top")
    root = (roots.first() or {"digest": None})["digest"]
    start = session.createDataFrame([("", [])], f"group string, path {_PATH}")
    above = group_proofs(start).select(F.col("payload").alias("group"), F.col("digest").alias("subroot"), "path")
    # The subroot travels as the first element of the path, so that one column carries both.
    carried = above.select("group", F.concat(F.array(F.struct(F.col("subroot").alias("before"), F.lit("").alias("after"))), "path").alias("path"))
    return leaf_proofs(carried).select(
        "group", "rank", F.col("digest").alias("leaf"), "payload", F.col("path")[0]["before"].alias("subroot"), F.lit(root).cast("string").alias("root"),
        F.reverse(F.slice("path", 2, 1_000)).alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and what stands beside it on each level."""
    return F.aggregate(path, leaf, lambda at, beside: digest(beside["before"], at, beside["after"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, from the leaf up, left to right."""
    return F.sha2(_joined(F.transform(path, lambda beside: F.concat(beside["before"], beside["after"]))), 256)
