"""Top-k by cosine: exact, thresholded, filtered, and approximate.

No plan here emits a row per pair. A task scores blocks of vectors with one matrix
product and keeps the k best of each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.layout import checked_broadcast, gathered, stored
from .bounded_search import BLOCK_BYTES, probed_blocks, topk_blocks
from .joins import skew_join
from .kernels import BestMatches, add_cosines, unit_rows

MATCH_SCHEMA = "query_id bigint not null, id bigint not null, score double not null"
BATCH_BYTES = 64 << 20
MERGES = 64
CELL_TILE = 4_096
HOT_MATCHES = 100_000


def _rank(matches: DataFrame, k: int) -> DataFrame:
    """The k best over all tasks, in two steps: each task returns up to k rows of a query,
    so parts of a query's rows are merged before the rest meets in one window."""
    best = [F.desc("score"), F.asc("id")]
    part = F.pmod(F.xxhash64("id"), F.lit(MERGES))
    some = Window.partitionBy("query_id", "part").orderBy(*best)
    merged = (matches.withColumn("part", part).withColumn("rank", F.row_number().over(some))
              .filter(F.col("rank") <= k).drop("part"))
    order = Window.partitionBy("query_id").orderBy(*best)
    return (merged.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("bigint").alias("rank"), "id", "score"))


def topk(
    queries: DataFrame, index: DataFrame, k: int = 1, threshold: float | None = None,
    query_id: str = "query_id", index_id: str = "id", vector: str = "embedding",
    skip_same_id: bool = False, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """The ``k`` index rows most similar to each query: ``query_id, rank, id, score``.

    Scores are rounded to six digits; equal scores rank by id. ``threshold`` is a
    lowest score. Filter ``index`` first to search within a predicate.

    Queries of at most ``batch_bytes`` are sent to all tasks and meet the index where it
    lies. More of them meet it in blocks, of which those are skipped whole that cannot
    hold a result (``bounded_search``).
    """
    q = queries.select(F.col(query_id).cast("bigint").alias("query_id"), F.col(vector).alias("v"))
    x = index.select(F.col(index_id).cast("bigint").alias("id"), F.col(vector).alias("v"))
    return _searched(q, x, k, threshold, skip_same_id, batch_bytes)


def _searched(q: DataFrame, x: DataFrame, k: int, threshold: float | None, skip_same_id: bool, batch_bytes: int) -> DataFrame:
    """Queries measured to be small are sent to the index where it lies; more of them meet it
    in blocks on executors. They are stored, so their vectors are made once."""
    q = stored(q, "queries")
    rows, longest = q.agg(F.count("*"), F.max(F.array_size("v"))).first()
    if rows * 8 * (longest or 0) <= batch_bytes:
        return _rank(_scan(x, q.toArrow(), k, threshold, skip_same_id), k)
    block_bytes = min(batch_bytes, BLOCK_BYTES)
    search = probed_blocks if "cells" in q.columns else topk_blocks
    return _rank(search(q, x, k, threshold, skip_same_id, block_bytes), k)


def _scan(index: DataFrame, queries: pa.Table, k: int, threshold: float | None, skip_same_id: bool) -> DataFrame:
    """Score the index where it lies. Queries with ``cells`` meet only those cells."""
    by_cell = "cells" in queries.column_names
    ids, vectors = (queries.column(c).combine_chunks() for c in ("query_id", "v"))
    lengths = set(pc.list_value_length(vectors).unique().to_pylist()) - {None, 0}
    groups = [(dim, *unit_rows(ids, vectors, dim)) for dim in sorted(lengths)]
    probes = {}
    if by_cell:
        wanted = dict(zip(ids.to_pylist(), queries.column("cells").to_pylist()))
        for at, (_, qid, _) in enumerate(groups):
            for position, q in enumerate(qid.tolist()):
                for cell in wanted[q] or ():
                    probes.setdefault((at, cell), []).append(position)
        probes = {key: np.array(found) for key, found in probes.items()}
        index = index.filter(F.col("cell").isin(sorted({cell for _, cell in probes})))
    shared = index.sparkSession.sparkContext.broadcast((groups, probes))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, probes = shared.value
        best = [BestMatches(len(qid), k) for _, qid, _ in groups]
        for batch in batches:
            parts = [(None, batch)]
            if by_cell:
                cells = batch.column(2)
                parts = [(c, batch.filter(pc.equal(cells, c))) for c in cells.unique().to_pylist()]
            for cell, part in parts:
                for at, (dim, qid, q) in enumerate(groups):
                    chosen = probes.get((at, cell)) if by_cell else None
                    if by_cell and chosen is None:
                        continue
                    found, matrix = unit_rows(part.column(0), part.column(1), dim)
                    add_cosines(best[at], qid, q, found, matrix, threshold, skip_same_id, chosen)
        for (_, qid, _), b in zip(groups, best):
            yield b.rows(qid)

    return gathered(index).mapInArrow(task, MATCH_SCHEMA)


def with_metadata(matches: DataFrame, documents: DataFrame, document_id: str = "id",
                  columns: tuple[str, ...] = ("url", "content", "title")) -> DataFrame:
    """Matches with the fields of their document; null when it has gone.

    The matches are stored first, so the search runs once. When they are few their
    ids go to all tasks and documents are filtered where they lie; only the matched
    ones move. A document that answers very many questions is joined in parts.
    """
    matches = stored(matches, "matches")
    details = documents.select(F.col(document_id).cast("bigint").alias("id"), *columns)
    wanted = details.join(checked_broadcast(matches.select("id").distinct()), "id", "left_semi")
    return skew_join(matches, wanted, "id", "query_id", "left", HOT_MATCHES).select("query_id", "rank", "id", "score", *columns)


def fit_cells(index: DataFrame, n_cells: int, vector: str = "embedding", seed: int = 7,
              max_iter: int = 20) -> np.ndarray:
    """Centroids of ``n_cells`` k-means cells over the unit vectors of all rows.

    An iteration is one aggregate over the index.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import Normalizer
    from pyspark.ml.functions import array_to_vector

    rows = index.filter(F.array_size(vector) > 0).select(
        array_to_vector(F.col(vector).cast("array<double>")).alias("raw"))
    unit = Normalizer(inputCol="raw", outputCol="features").transform(rows)
    model = KMeans(k=n_cells, seed=seed, maxIter=max_iter).fit(unit)
    return np.array(model.clusterCenters())


def nearest_cells(vector: Column, centroids: np.ndarray, n: int = 1) -> Column:
    """The ``n`` cells whose centroid has the highest cosine with the vector."""
    dim = centroids.shape[1]
    unit = centroids / np.linalg.norm(centroids, axis=1, keepdims=True)

    @F.arrow_udf("array<int>")
    def nearest(vectors: pa.Array) -> pa.Array:
        row, matrix = unit_rows(pa.array(np.arange(len(vectors))), vectors, dim)
        scores, cells = np.empty((len(row), 0)), np.empty((len(row), 0), np.int32)
        for first in range(0, len(unit), CELL_TILE):  # a tile of centroids at a time
            tile = np.round(matrix @ unit[first:first + CELL_TILE].T, 9)
            numbers = np.broadcast_to(np.arange(first, first + tile.shape[1], dtype=np.int32), tile.shape)
            scores, cells = np.hstack((scores, tile)), np.hstack((cells, numbers))
            order = np.lexsort((cells, -scores), axis=1)[:, :n]
            scores, cells = (np.take_along_axis(a, order, 1) for a in (scores, cells))
        found = np.zeros(len(vectors), bool)
        found[row] = True
        width = cells.shape[1]
        offsets = np.concatenate(([0], np.cumsum(found * width)))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(cells.ravel(), pa.int32()))
        return pc.if_else(pa.array(found), lists, pa.scalar(None, lists.type))

    return nearest(vector)


def assign_cells(index: DataFrame, centroids: np.ndarray, vector: str = "embedding") -> DataFrame:
    """Add the cell of each vector, null when it has none."""
    return index.withColumn("cell", F.element_at(nearest_cells(F.col(vector), centroids), 1))


def write_cells(index: DataFrame, path: str) -> DataFrame:
    """Write an index with cells so that a search reads only the cells it probes.

    The rebalance hint makes files of even size: small cells share a task, a large
    cell is split over many.
    """
    index.hint("rebalance", "cell").write.partitionBy("cell").parquet(path)
    return index.sparkSession.read.parquet(path)


def topk_approx(
    queries: DataFrame, index: DataFrame, centroids: np.ndarray, k: int = 1, probes: int = 4,
    threshold: float | None = None, query_id: str = "query_id", index_id: str = "id",
    vector: str = "embedding", skip_same_id: bool = False, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Top-k among the ``probes`` nearest cells; with all cells it is exact.

    ``index`` has a ``cell`` column from ``assign_cells``. As in ``topk``, few queries are
    sent to the cells they probe; more meet them in blocks of one cell.
    """
    x = index.select(F.col(index_id).cast("bigint").alias("id"), F.col(vector).alias("v"), "cell")
    q = queries.select(
        F.col(query_id).cast("bigint").alias("query_id"), F.col(vector).alias("v"),
        nearest_cells(F.col(vector), centroids, probes).alias("cells"))
    return _searched(q, x, k, threshold, skip_same_id, batch_bytes)
