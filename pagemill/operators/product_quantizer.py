"""Approximate top-k over product-quantized vectors, with exact re-ranking.

A unit vector is its cell's centroid plus a residual; the residual is cut into ``m`` parts and
each part becomes the number of the nearest entry of that part's codebook: one byte for several
dimensions. The cosine of a query and a coded vector is the query's product with the centroid
plus one table entry per part; the tables are made once per query.

Search: first the codes of the probed cells alone are read and the ``depth`` best approximate
scores of each query are kept; the last of them is what a vector must reach. Then the vectors
that reach it are scored exactly where they lie. So a query re-ranks about ``depth`` vectors,
whatever the size of the index. With ``depth`` of the size of the index and all cells the result
is exact.

Queries and vectors meet as blocks of one cell (``bounded_search``); neither side passes through
the driver. Only centroids and codebooks, whose sizes are parameters, are broadcast. They are
fitted on at most ``SAMPLE`` vectors, chosen by a hash; every vector is coded and searched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.layout import stored
from .bounded_search import BLOCK_BYTES, MATCHES, Cosines, Pairwise, blocks_of, in_bands
from .kernels import SCORE_DIGITS, TILE_CELLS, BestMatches, add_cosines, unit_rows
from .search import _rank, nearest_cells

SAMPLE = 65_536     # vectors that the codebooks are fitted on
PARTS, ENTRIES = 16, 256
ROUNDS = 12
_MATCHES = "query_id bigint, id bigint, score double"


@dataclass(frozen=True)
class Quantizer:
    """``centroids`` of shape (cells, dim), unit rows; ``books`` of shape (m, entries, dim / m)."""

    centroids: np.ndarray
    books: np.ndarray

    def codes(self, matrix: np.ndarray, cell: int) -> np.ndarray:
        """One byte per part of each unit vector's residual."""
        m, _, width = self.books.shape
        rest = (matrix - self.centroids[cell]).reshape(len(matrix), m, width)
        out = np.empty((len(matrix), m), np.uint8)
        for part, book in enumerate(self.books):
            out[:, part] = _nearest(np.ascontiguousarray(rest[:, part]), book)
        return out

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """Products of each query's parts with all entries: (queries, m, entries)."""
        m, _, width = self.books.shape
        return np.einsum("qmw,mew->qme", queries.reshape(len(queries), m, width), self.books)

    def scores(self, queries: np.ndarray, tables: np.ndarray, codes: np.ndarray, cell: int) -> np.ndarray:
        """Approximate cosines of shape (queries, vectors)."""
        total = np.repeat((queries @ self.centroids[cell])[:, None], len(codes), axis=1)
        for part in range(codes.shape[1]):
            total += tables[:, part][:, codes[:, part]]
        return total

    def decoded(self, codes: np.ndarray, cell: int) -> np.ndarray:
        parts = [book[codes[:, part]] for part, book in enumerate(self.books)]
        return self.centroids[cell] + np.concatenate(parts, axis=1)


def _nearest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    half = (book * book).sum(axis=1) / 2
    return np.concatenate([np.argmin(half - rows[lo:lo + 8_192] @ book.T, axis=1)
                           for lo in range(0, len(rows), 8_192)] or [np.zeros(0, np.int64)])


def _book(rows: np.ndarray, entries: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's iterations; an entry that nothing is nearest to takes the farthest row."""
    book = rows[rng.choice(len(rows), min(entries, len(rows)), replace=False)]
    for _ in range(ROUNDS):
        at = _nearest(rows, book)
        count = np.bincount(at, minlength=len(book))
        sums = np.stack([np.bincount(at, rows[:, d], len(book)) for d in range(rows.shape[1])], axis=1)
        book = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], book)
        empty = np.flatnonzero(count == 0)
        if len(empty):
            far = np.argsort(-((rows - book[at]) ** 2).sum(axis=1), kind="stable")[:len(empty)]
            book[empty[:len(far)]] = rows[far]
    return np.concatenate((book, np.repeat(book[:1], entries - len(book), axis=0)))


def fit_quantizer(index: DataFrame, centroids: np.ndarray, parts: int = PARTS, entries: int = ENTRIES, sample: int = SAMPLE,
                  index_id: str = "id", vector: str = "embedding", seed: int = 7) -> Quantizer:
    """Codebooks for vectors of the centroids' dimension, which ``parts`` divides."""
    dim = centroids.shape[1]
    if dim % parts or entries > 256:
        raise ValueError("the parts must divide the dimension, and an entry's number must fit into a byte")
    units = centroids / np.linalg.norm(centroids, axis=1, keepdims=True)
    usable = index.filter(F.array_size(vector) == dim).select(F.col(index_id).cast("bigint").alias("id"), F.col(vector).alias("v"))
    taken = usable.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
    _, matrix = unit_rows(taken.column("id").combine_chunks(), taken.column("v").combine_chunks(), dim)
    if not len(matrix):
        return Quantizer(units, np.zeros((parts, entries, dim // parts)))
    rest = matrix - units[np.argmax(matrix @ units.T, axis=1)]
    rng = np.random.default_rng(seed)
    split = rest.reshape(len(rest), parts, dim // parts)
    return Quantizer(units, np.stack([_book(np.ascontiguousarray(split[:, p]), entries, rng) for p in range(parts)]))


def coded_blocks(index: DataFrame, quantizer: Quantizer, index_id: str = "id", vector: str = "embedding",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Stored blocks of an index with a ``cell`` column: ids, unit vectors and their codes."""
    dim = quantizer.centroids.shape[1]
    rows = index.filter(F.col("cell").isNotNull() & (F.array_size(vector) == dim)).select(
        F.col(index_id).cast("bigint").alias("id"), F.col(vector).alias("v"), F.col("cell").cast("int").alias("cell"))
    shared = index.sparkSession.sparkContext.broadcast((quantizer.centroids, quantizer.books))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Quantizer(*shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                matrix = np.frombuffer(row.column("matrix")[0].as_py(), np.float64).reshape(-1, dim)
                codes = made.codes(matrix, row.column("cell")[0].as_py())
                yield row.append_column("codes", pa.array([codes.tobytes()], pa.binary()))

    blocks = blocks_of(rows, None, block_bytes).select("block", "cell", "ids", "matrix", "n")
    return stored(blocks.mapInArrow(coded, "block bigint, cell int, ids binary, matrix binary, n int, codes binary"), "coded")


def topk_quantized(queries: DataFrame, blocks: DataFrame, quantizer: Quantizer, k: int = 10, depth: int = 100, probes: int | None = None,
                   threshold: float | None = None, query_id: str = "query_id", vector: str = "embedding",
                   skip_same_id: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` best by exact cosine among the vectors of the
    ``probes`` nearest cells (all by default) whose approximate cosine is among the ``depth`` best.

    Query ids are unique. A query without a usable vector of the codebooks' dimension has no match.
    """
    dim = quantizer.centroids.shape[1]
    cells = nearest_cells(F.col(vector), quantizer.centroids, probes or len(quantizer.centroids))
    asked = queries.filter(F.array_size(vector) == dim).select(
        F.col(query_id).cast("bigint").alias("id"), F.col(vector).alias("v"), F.explode(cells).alias("cell"))
    q = blocks_of(asked, None, block_bytes).select(F.col("block").alias("q"), "cell", "dim", "ids", "matrix", "n")
    pairs = stored(q.select("q", "cell").join(blocks.select(F.col("block").alias("x"), "cell"), "cell").select("q", "x"), "pairs")
    shared = queries.sparkSession.sparkContext.broadcast((quantizer.centroids, quantizer.books))
    if depth < blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]:
        near = _paired(pairs, q, blocks.select("block", "cell", "ids", "codes"), _approximate(shared, depth, skip_same_id), "codes")
        last = _rank(near, depth).groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
        # Fewer candidates than the depth: all of them are scored.
        floors = stored(last.filter(F.col("n") >= depth).select("query_id", "floor"), "floors")
        members = q.select("q", "ids").mapInArrow(_members, "q bigint, place int, query_id bigint")
        listed = members.join(floors, "query_id", "left").groupBy("q").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "floor"))), lambda f: f["floor"]).alias("floors"))
        q = q.join(listed, "q", "left")
        found = _paired(pairs, q, blocks.select("block", "cell", "ids", "codes", "matrix"), _exact(shared, k, threshold, skip_same_id))
    else:
        x = blocks.select(F.col("block").alias("x"), "cell", F.lit(dim).alias("dim"), "ids", "matrix", "n")
        found = in_bands(pairs, q, x, lambda: Cosines(k, threshold, skip_same_id), MATCHES).drop("q")
    return _rank(found, k)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of queries -> one row per query: its block and its place there."""
    for batch in batches:
        for number, data in zip(batch.column("q").to_pylist(), batch.column("ids").to_pylist()):
            ids = np.frombuffer(data, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number), pa.int64()), pa.array(np.arange(len(ids)), pa.int32()), pa.array(ids)],
                                             ["q", "place", "query_id"])


def _paired(pairs: DataFrame, q: DataFrame, x: DataFrame, run, sent: str = "matrix") -> DataFrame:
    return in_bands(pairs, q, x.withColumnRenamed("block", "x"), lambda: Pairwise(run), _MATCHES, sent)


def _read(q: dict, x: dict, dim: int):
    return (np.frombuffer(q["ids"], "<i8"), np.frombuffer(q["matrix"], np.float64).reshape(-1, dim), np.frombuffer(x["ids"], "<i8"))


def _tiles(quantizer: Quantizer, queries: np.ndarray, codes: np.ndarray, cell: int):
    """Approximate scores, a bounded number of vectors at a time."""
    tables = quantizer.tables(queries)
    width = max(1, TILE_CELLS // max(1, len(queries)))
    for lo in range(0, len(codes), width):
        yield lo, quantizer.scores(queries, tables, codes[lo:lo + width], cell)


def _approximate(shared, depth: int, skip_same_id: bool):
    def run(q: dict, x: dict) -> pa.RecordBatch:
        made = Quantizer(*shared.value)
        query_ids, queries, ids = _read(q, x, made.centroids.shape[1])
        codes = np.frombuffer(x["codes"], np.uint8).reshape(len(ids), -1)
        best = BestMatches(len(query_ids), min(depth, len(ids)))
        for lo, scores in _tiles(made, queries, codes, q["cell"]):
            part = ids[lo:lo + scores.shape[1]]
            if skip_same_id:
                scores[query_ids[:, None] == part[None, :]] = -np.inf
            best.add(scores, part)
        return best.rows(query_ids)
    return run


def _exact(shared, k: int, threshold: float | None, skip_same_id: bool):
    def run(q: dict, x: dict) -> pa.RecordBatch:
        made = Quantizer(*shared.value)
        query_ids, queries, ids = _read(q, x, made.centroids.shape[1])
        matrix = np.frombuffer(x["matrix"], np.float64).reshape(len(ids), -1)
        codes = np.frombuffer(x["codes"], np.uint8).reshape(len(ids), -1)
        floors = np.full(len(query_ids), -np.inf)
        if q["floors"]:
            floors = np.array([-np.inf if f is None else f for f in q["floors"]])
        best = BestMatches(len(query_ids), k)
        if not np.isfinite(floors).any():
            add_cosines(best, query_ids, queries, ids, matrix, threshold, skip_same_id)
        else:
            for lo, near in _tiles(made, queries, codes, q["cell"]):
                part, vectors = ids[lo:lo + near.shape[1]], matrix[lo:lo + near.shape[1]]
                scores = np.full(near.shape, -np.inf)
                row, col = np.nonzero(np.round(near, SCORE_DIGITS) >= floors[:, None])
                for a in range(0, len(row), TILE_CELLS // vectors.shape[1]):
                    r, c = row[a:a + TILE_CELLS // vectors.shape[1]], col[a:a + TILE_CELLS // vectors.shape[1]]
                    scores[r, c] = (queries[r] * vectors[c]).sum(axis=1)
                _add(best, scores, query_ids, part, threshold, skip_same_id)
        return best.rows(query_ids)
    return run


def _add(best: BestMatches, scores: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, threshold: float | None, skip_same_id: bool) -> None:
    if threshold is not None:
        scores[np.round(scores, SCORE_DIGITS) < threshold] = -np.inf
    if skip_same_id:
        scores[query_ids[:, None] == ids[None, :]] = -np.inf
    best.add(scores, ids)
