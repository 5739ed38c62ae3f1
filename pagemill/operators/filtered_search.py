"""Top-k among the rows that pass a metadata filter, by bitmaps per block.

Vectors lie in blocks of one cell (``bounded_search``). For every metadata column and value a
block holds a bitmap of its rows, compressed. A filter is answered from the bitmaps alone: values
of one column are joined by *or*, columns by *and*. Blocks in which no row passes are not read; in
the others only rows that pass are scored.

A query goes through the cells in the order of their centroids' nearness, leaves out those in
which no row passes, and stops when the cells it has taken hold ``at_least`` passing rows; so a
rare value is found wherever it lies, and a frequent one costs a few cells. Without ``at_least`` all
cells that hold a passing row are probed, and the result is exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.layout import stored
from .bounded_search import BLOCK_BYTES, MATCHES, Cosines, blocks_of, in_bands
from .search import _rank, nearest_cells

BLOCKS = "block bigint, dim int, ids binary, matrix binary, n int"
BITMAPS = "name string, value string, block bigint, count int, bits binary"


def _block(columns: list[str]):
    """Rows of one block -> the block with the values of each metadata column."""
    def run(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        matrix = b"".join(table.column("unit").to_pylist())
        values = {c: [table.column(c).to_pylist()] for c in columns}
        kinds = [("block", pa.int64()), ("cell", pa.int32()), ("dim", pa.int32()), ("ids", pa.binary()), ("matrix", pa.binary()), ("n", pa.int32()),
                 *((c, pa.list_(pa.string())) for c in columns)]
        return pa.Table.from_pydict({
            "block": [table.column("block")[0].as_py()], "cell": [table.column("cell")[0].as_py()], "dim": [dim],
            "ids": [table.column("id").to_numpy().astype("<i8").tobytes()], "matrix": [matrix], "n": [len(table)], **values}, schema=pa.schema(kinds))
    return run


def _bitmaps(columns: list[str]):
    """Blocks -> one row for each value of each column: which rows of the block have it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, out = batch.column("block")[i].as_py(), {k: [] for k in ("name", "value", "block", "count", "bits")}
                for c in columns:
                    coded = batch.column(c)[i].values.dictionary_encode(null_encoding="encode")
                    codes = coded.indices.to_numpy(zero_copy_only=False)
                    for number, value in enumerate(coded.dictionary.to_pylist()):
                        has = codes == number
                        out["name"].append(c)
                        out["value"].append(value)
                        out["block"].append(block)
                        out["count"].append(int(has.sum()))
                        out["bits"].append(zlib.compress(np.packbits(has).tobytes(), 1))
                yield pa.RecordBatch.from_arrays([pa.array(out["name"], pa.string()), pa.array(out["value"], pa.string()), pa.array(out["block"], pa.int64()),
                                                  pa.array(out["count"], pa.int32()), pa.array(out["bits"], pa.binary())], list(out))
    return run


@dataclass(frozen=True)
class FilterIndex:
    """The index at ``path``; ``centroids`` are those of its cells."""

    spark: SparkSession
    path: str
    centroids: np.ndarray

    @property
    def blocks(self) -> DataFrame:
        return self.spark.read.schema(f"{BLOCKS}, cell int").parquet(f"{self.path}/blocks")

    def passing(self, where: dict[str, list]) -> DataFrame:
        """``block, count, bits`` of the blocks in which a row passes; values as strings, or None.

        Every column gives at most one bitmap per block, so a group has as many rows as the
        filter names columns.
        """
        table = self.spark.read.schema(f"{BITMAPS}").parquet(f"{self.path}/bitmaps")
        found = F.lit(False)
        for name, values in where.items():
            known = [str(v) for v in values if v is not None]
            this = F.col("value").isin(known) if known else F.lit(False)
            found = found | ((F.col("name") == name) & (this | F.col("value").isNull() if None in values else this))
        return table.filter(found).select("block", "name", "bits").groupBy("block").applyInArrow(_combined(len(where)), "block bigint, count int, bits binary")

    def search(self, queries: DataFrame, where: dict[str, list], k: int = 10, at_least: int | None = None, threshold: float | None = None,
               query_id: str = "query_id", vector: str = "embedding", skip_same_id: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
        """The ``k`` nearest rows that pass: ``query_id, rank, id, score``."""
        passing = stored(self.passing(where), "passing")
        cells = self.blocks.select("block", "cell")
        # One row for each cell, a bounded number.
        counts = {r["cell"]: r["rows"] for r in cells.join(passing, "block").groupBy("cell").agg(F.sum("count").alias("rows")).collect()}
        near = nearest_cells(F.col(vector), self.centroids, len(self.centroids))
        asked = queries.select(F.col(query_id).cast("bigint").alias("id"), F.col(vector).alias("v"), _taken(near, counts, at_least).alias("cells"))
        asked = asked.select("id", "v", F.explode("cells").alias("cell"))
        q = blocks_of(asked, None, block_bytes).select(F.col("block").alias("q"), "cell", "dim", "ids", "matrix", "n")
        wanted = self.blocks.filter(F.col("cell").isin(sorted(counts))) if counts else self.blocks.limit(0)
        index = wanted.join(passing.withColumnRenamed("block", "_block"), F.col("block") == F.col("_block")).drop("_block", "count")
        pairs = stored(q.select("q", "cell").join(cells.join(passing.select("block"), "block", "left_semi").select(
            F.col("block").alias("x"), "cell"), "cell").select("q", "x"), "pairs")
        scored = in_bands(pairs, q, index.withColumnRenamed("block", "x"), lambda: Cosines(k, threshold, skip_same_id), MATCHES)
        return _rank(scored.drop("q"), k)


def build_filter_index(index: DataFrame, centroids: np.ndarray, columns: list[str], path: str, index_id: str = "id", vector: str = "embedding",
                       block_bytes: int = BLOCK_BYTES) -> FilterIndex:
    """Write an index with a ``cell`` column and the metadata ``columns`` to ``path``.

    Bitmaps are written in order of column and value, so a filter reads the parts of the table
    that hold its values. A column suits that has few values beside the rows of a block.
    """
    clashing = {"id", "v", "cell", "number", "unit", "dim", "block"} & set(columns)
    if clashing:
        raise ValueError(f"names of its own: {sorted(clashing)}")
    rows = index.filter(F.col("cell").isNotNull()).select(
        F.col(index_id).cast("bigint").alias("id"), F.col(vector).alias("v"), F.col("cell").cast("int").alias("cell"),
        *(F.col(c).cast("string").alias(c) for c in columns))
    more = "".join(f", {c} array<string>" for c in columns)
    blocks = blocks_of(rows, None, block_bytes, columns, _block(columns), f"block bigint, cell int, dim int, ids binary, matrix binary, n int{more}")
    blocks.drop(*columns).hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/blocks")
    bits = blocks.select("block", *columns).mapInArrow(_bitmaps(columns), BITMAPS)
    bits.repartitionByRange(index.sparkSession.sparkContext.defaultParallelism, "name", "value", "block").sortWithinPartitions(
        "name", "value", "block").write.parquet(f"{path}/bitmaps")
    return FilterIndex(index.sparkSession, path, centroids)


def _combined(columns: int):
    def run(table: pa.Table) -> pa.Table:
        by: dict[str, np.ndarray] = {}
        for name, bits in zip(table.column("name").to_pylist(), table.column("bits").to_pylist()):
            one = np.frombuffer(zlib.decompress(bits), np.uint8)
            by[name] = by[name] | one if name in by else one
        both = np.bitwise_and.reduce(list(by.values())) if len(by) == columns else np.zeros(0, np.uint8)
        count = int(np.unpackbits(both).sum())
        rows = {"block": [], "count": [], "bits": []}
        if count:
            rows = {"block": [table.column("block")[0].as_py()], "count": [count], "bits": [both.tobytes()]}
        return pa.Table.from_pydict(rows, schema=pa.schema([("block", pa.int64()), ("count", pa.int32()), ("bits", pa.binary())]))
    return run


def _taken(near, counts: dict[int, int], at_least: int | None):
    """The cells of a query that hold a passing row, up to the one that makes them enough."""
    held = F.create_map(*[F.lit(x) for item in counts.items() for x in item]) if counts else F.create_map().cast("map<int,bigint>")
    rows = lambda cell: F.coalesce(F.try_element_at(held, cell.cast("int")), F.lit(0)).cast("bigint")
    some = F.filter(near, lambda cell: rows(cell) > 0)
    if at_least is None:
        return some
    def step(acc, cell):
        more = F.struct((acc["n"] + rows(cell)).alias("n"), F.concat(acc["cells"], F.array(cell)).alias("cells"))
        return F.when(acc["n"] < at_least, more).otherwise(acc)
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.array().cast("array<int>").alias("cells"))
    return F.aggregate(some, start, step, lambda acc: acc["cells"])
