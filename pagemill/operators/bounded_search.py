"""Exact top-k of many queries against many vectors: blocks of both sides, skipped by bounds.

Both sides are cut into blocks: unit vectors whose nearest pivot is the same, split further into
blocks of a bounded number of rows. A block has a centre and a radius, the largest angle from
the centre to one of its vectors. Angles obey the triangle inequality, so no query of block Q and
no vector of block X are closer than angle(centres) - radius(Q) - radius(X).

1. Summaries (centre, radius) of both sides meet in tiles of bounded size; each query block takes
   the index blocks that lie nearest, and scoring these gives every query a k-th best score.
2. Summaries meet again: what remains are pairs of blocks whose bound reaches the smallest k-th
   best score in Q. All others are skipped whole.
3. Remaining pairs are scored in bands (``in_bands``): a task holds one band of query blocks, of
   bounded size, and the index blocks of one band come to it one after the other. So a block is
   sent once for each band that needs it and not once for each pair. Queries whose own bound does
   not reach their score are left out.

Nothing goes through the driver but the pivots, and nothing is broadcast but them, the sizes
of cells and the bands of blocks. Bounds only skip what cannot be in the result, so results are
those of scoring every pair. Where every query names its cells (``probed_blocks``), blocks of one
cell are the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.layout import BROADCAST_BYTES, partitioned, stored
from .kernels import SCORE_DIGITS, BestMatches, add_cosines, unit_rows

MATCHES = "q bigint, query_id bigint, id bigint, score double"
BLOCK_BYTES = 4 << 20       # vectors of a block
BLOCKS = 1_024              # blocks of one side, about, until they would pass BLOCK_BYTES
HELD_BYTES = 64 << 20       # query blocks that a task holds
SENT_BYTES = 256 << 20      # index blocks that come to it
TASKS = 4                   # full bands' worth of tasks per core
PIVOTS = 1_024
TILE = 1_024                # block summaries of either side in one group
SEEDS = 2                   # index blocks that give the first scores
SLACK = 2 * 10.0 ** -SCORE_DIGITS

_BLOCK = "block bigint, cell int, dim int, ids binary, matrix binary, n int, centre binary, radius double"


def _pivots(rows: DataFrame, n: int) -> dict[int, np.ndarray]:
    """At most ``n`` vectors of each dimension, by a hash of their ids; a bounded number."""
    found: dict[int, list] = {}
    usable = rows.filter(F.array_size("v") > 0).withColumn("dim", F.array_size("v"))
    dims = [r["dim"] for r in usable.groupBy("dim").count().orderBy(F.desc("count")).limit(16).select("dim").collect()]
    for dim in dims:
        table = usable.filter(F.col("dim") == dim).orderBy(F.xxhash64("id"), "id").limit(n).select("id", "v").toArrow()
        _, matrix = unit_rows(table.column("id").combine_chunks(), table.column("v").combine_chunks(), dim)
        if len(matrix):
            found[dim] = np.unique(matrix, axis=0)
    return found


def _celled(pivots: dict[int, np.ndarray] | None, more: list[str]):
    """Rows -> unit vectors with their dimension and nearest pivot; unusable vectors go.

    Vectors of a dimension without pivots have one cell; without any, rows come with their cell.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors, number = (batch.column(c) for c in ("id", "v", "number"))
            for dim in sorted(set(pa.compute.list_value_length(vectors).unique().to_pylist()) - {None, 0}):
                # Row numbers go through, so that equal ids stay apart.
                at, matrix = unit_rows(pa.array(np.arange(len(ids))), vectors, dim)
                known = pa.compute.is_valid(ids).to_numpy(zero_copy_only=False)[at] if len(at) else np.zeros(0, bool)
                at, matrix = at[known], matrix[known]
                cell = np.zeros(len(at), np.int32)
                if pivots is None:
                    cell = batch.column("cell").take(pa.array(at))
                elif dim in pivots and len(at):
                    for lo in range(0, len(at), 4_096):
                        cell[lo:lo + 4_096] = np.argmax(matrix[lo:lo + 4_096] @ pivots[dim].T, axis=1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), dim), pa.int32()), pa.array(cell, pa.int32()), ids.take(pa.array(at)), number.take(pa.array(at)),
                    pa.array([row.tobytes() for row in matrix], pa.binary()), *(batch.column(c).take(pa.array(at)) for c in more)],
                    ["dim", "cell", "id", "number", "unit", *more])
    return run


def _block(table: pa.Table) -> pa.Table:
    """The rows of one block as one row."""
    block, cell, dim = (table.column(c)[0].as_py() for c in ("block", "cell", "dim"))
    ids = table.column("id").to_numpy()
    matrix = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(len(ids), dim)
    mean = matrix.sum(axis=0)
    norm = np.linalg.norm(mean)
    centre = mean / norm if norm > 1e-9 else matrix[0]
    return pa.Table.from_pydict({
        "block": [block], "cell": [cell], "dim": [dim], "ids": [ids.astype("<i8").tobytes()], "matrix": [matrix.tobytes()],
        "n": [len(ids)], "centre": [centre.tobytes()], "radius": [float(_angles(matrix @ centre).max())]}, schema=_schema())


def _schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in _BLOCK.split(", "))])


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def blocks_of(rows: DataFrame, pivots: dict[int, np.ndarray] | None, block_bytes: int = BLOCK_BYTES,
              more: list[str] = [], block=_block, schema: str = _BLOCK) -> DataFrame:
    """``rows(id, v)``, with ``cell`` if there are no pivots, as stored blocks. A cell of any size
    becomes blocks of about ``block_bytes``; its rows are dealt to them by a number that is stored
    with each row. ``block`` makes one row of a block, with the string columns ``more``."""
    numbered = stored(rows.withColumn("number", F.monotonically_increasing_id()), "vectors")
    celled = stored(numbered.mapInArrow(_celled(pivots, more), "dim int, cell int, id bigint, number bigint, unit binary"
                                        + "".join(f", {c} string" for c in more)), "celled")
    counts = celled.groupBy("dim", "cell").agg(F.count("*").alias("rows"))   # cells are a bounded number
    parts = F.ceil(F.col("rows") * F.col("dim") * 8 / block_bytes)
    dealt = celled.join(F.broadcast(counts), ["dim", "cell"]).withColumn(
        "block", F.xxhash64("dim", "cell", F.pmod(F.xxhash64("number"), parts)))
    return stored(dealt.select("block", "cell", "dim", "id", "unit", *more).groupBy("block").applyInArrow(block, schema), "blocks")


def _tiled(queries: DataFrame, index: DataFrame, keep, out: str) -> DataFrame:
    """Summaries of both sides in tiles; ``keep(left, right)`` gives the rows of a pair of tiles."""
    n_q, n_x = (-(-side.count() // TILE) or 1 for side in (queries, index))
    own = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("qt", own(n_q)).withColumn("xt", each(n_x))
    right = index.withColumn("xt", own(n_x)).withColumn("qt", each(n_q))
    left, right = (partitioned(side, ("qt", "xt"), n_q * n_x) for side in (left, right))
    return left.groupBy("qt", "xt").cogroup(right.groupBy("qt", "xt")).applyInArrow(keep, out)


def _summary(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Table]:
    mine = table.filter(pa.compute.equal(table.column("dim"), dim))
    centres = np.frombuffer(b"".join(mine.column("centre").to_pylist()), np.float64).reshape(len(mine), dim)
    return mine.column("block").to_numpy(), centres, mine.column("radius").to_numpy(), mine


_NEAR = "q bigint, x bigint, angle double"


def _nearest(left: pa.Table, right: pa.Table) -> pa.Table:
    """The index blocks with the nearest centres, of each query block in the tile."""
    found = {"q": [], "x": [], "angle": []}
    for dim in set(left.column("dim").to_pylist()) & set(right.column("dim").to_pylist()):
        q, qc, *_ = _summary(left, dim)
        x, xc, *_ = _summary(right, dim)
        angle = _angles(qc @ xc.T)
        at = np.argsort(angle, axis=1, kind="stable")[:, :SEEDS]
        found["q"] += np.repeat(q, at.shape[1]).tolist()
        found["x"] += x[at].ravel().tolist()
        found["angle"] += np.take_along_axis(angle, at, 1).ravel().tolist()
    return pa.Table.from_pydict(found, schema=pa.schema([("q", pa.int64()), ("x", pa.int64()), ("angle", pa.float64())]))


def _reaching(left: pa.Table, right: pa.Table) -> pa.Table:
    """Pairs whose bound reaches the query block's smallest k-th best score."""
    found = {"q": [], "x": []}
    for dim in set(left.column("dim").to_pylist()) & set(right.column("dim").to_pylist()):
        q, qc, qr, mine = _summary(left, dim)
        x, xc, xr, _ = _summary(right, dim)
        least = np.maximum(0.0, _angles(qc @ xc.T) - qr[:, None] - xr[None, :])
        at = np.nonzero(np.cos(least) >= mine.column("floor").to_numpy()[:, None] - SLACK)
        found["q"] += q[at[0]].tolist()
        found["x"] += x[at[1]].tolist()
    return pa.Table.from_pydict(found, schema=pa.schema([("q", pa.int64()), ("x", pa.int64())]))


def _matrix(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["matrix"], np.float64).reshape(row["n"], row["dim"])


class Cosines:
    """The k best of each query of a band: query blocks are held, index blocks added one by one."""

    def __init__(self, k: int, threshold: float | None, skip_same_id: bool):
        self.k, self.threshold, self.skip_same_id = k, threshold, skip_same_id
        self.blocks, self.bands = {}, {}

    def hold(self, row: dict) -> None:
        self.blocks.setdefault(row["dim"], []).append(row)

    def _band(self, dim: int):
        """Blocks of one dimension as one matrix, made when the first index block comes."""
        if dim not in self.bands:
            rows = self.blocks.pop(dim, [])
            read = [_matrix(r) for r in rows]
            sizes = [len(ids) for ids, _ in read]
            ends = np.cumsum(sizes, dtype=np.int64)
            places = {r["q"]: np.arange(end - n, end) for r, n, end in zip(rows, sizes, ends)}
            floors = [np.frombuffer(r["floors"], np.float64) if r.get("floors") else np.full(n, -np.inf) for r, n in zip(rows, sizes)]
            numbers, ids, matrix, floors = (np.concatenate(c) if rows else np.zeros(0) for c in (
                [np.full(n, r["q"], np.int64) for r, n in zip(rows, sizes)], [i for i, _ in read], [m for _, m in read], floors))
            self.bands[dim] = numbers, ids, matrix, floors, places, BestMatches(len(ids), self.k)
        return self.bands[dim]

    def add(self, row: dict) -> tuple:
        _, query_ids, queries, floors, places, best = self._band(row["dim"])
        partners = [places[q] for q in row["partners"] if q in places]
        if partners:
            chosen = np.concatenate(partners)
            ids, matrix = _matrix(row)
            if row.get("centre"):
                centre = np.frombuffer(row["centre"], np.float64)
                near = np.concatenate([queries[p[0]:p[-1] + 1] @ centre for p in partners])
                near = np.cos(np.maximum(0.0, _angles(near) - row["radius"]))
                floor = floors[chosen] if self.threshold is None else np.maximum(floors[chosen], self.threshold)
                chosen = chosen[near >= np.maximum(floor, best.scores[chosen, -1]) - SLACK]
            if row.get("bits"):
                passing = np.flatnonzero(np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:len(ids)])
                ids, matrix = ids[passing], matrix[passing]
            if len(chosen):
                add_cosines(best, query_ids, queries, ids, matrix, self.threshold, self.skip_same_id, chosen, floors)
        return ()

    def finish(self) -> Iterator[pa.RecordBatch]:
        for numbers, query_ids, *_, best in self.bands.values():
            each = best.rows(np.arange(len(query_ids)))
            place = each.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(numbers[place], pa.int64()), pa.array(query_ids[place], pa.int64()),
                                              each.column(1), each.column(2)], schema=_matches())


class Pairwise:
    """``run(query block, index block)`` for each pair of a band."""

    def __init__(self, run):
        self.run, self.held = run, {}

    def hold(self, row: dict) -> None:
        self.held[row["q"]] = row

    def add(self, row: dict) -> Iterator[pa.RecordBatch]:
        for q in row["partners"]:
            yield self.run(self.held[q], row)

    def finish(self) -> tuple:
        return ()


def _matches() -> pa.Schema:
    return pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])


def _of_pairs(pairs: DataFrame, queries: DataFrame, index: DataFrame, k: int, threshold: float | None, skip_same_id: bool) -> DataFrame:
    """Stored pairs ``q, x`` scored in bands."""
    q = queries.withColumnRenamed("block", "q").select("q", "cell", "dim", "ids", "matrix", "n", "floors")
    x = index.withColumnRenamed("block", "x").select("x", "cell", "dim", "ids", "matrix", "n", "centre", "radius")
    return in_bands(pairs, q, x, lambda: Cosines(k, threshold, skip_same_id), MATCHES)


def _banded(blocks: DataFrame, key: str, band: str, n: int, total: int) -> DataFrame:
    """``key, band``: blocks in the order of their cells, cut into ``n`` bands of about equal bytes.
    There is a narrow row per block, so one task can number them."""
    before = F.coalesce(F.sum("bytes").over(Window.orderBy("cell", key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return blocks.select(key, F.least(F.floor(before / F.lit(max(1, total)) * n), F.lit(n - 1)).cast("int").alias(band))


def in_bands(pairs: DataFrame, queries: DataFrame, index: DataFrame, work, schema: str, sent: str = "matrix") -> DataFrame:
    """Stored ``pairs(q, x)`` of the blocks ``q`` of ``queries`` and ``x`` of ``index`` worked on in
    bands. Both have a ``cell``; ``matrix`` and ``sent`` are what makes their rows large.

    Both sides are cut into bands of blocks, and a task is a band of each. ``work()`` makes what
    holds its query blocks (``hold``), gets its index blocks one by one, with the query blocks they
    pair with as ``partners`` (``add``), and gives the rest of the result (``finish``). A block is
    sent once for each band of the other side that has a partner of it.
    """
    sides = [stored(side.select(key, "cell", F.octet_length(large).cast("bigint").alias("bytes")), "sizes")
             for side, key, large in ((queries, "q", "matrix"), (index, "x", sent))]
    (n_q, q_bytes), (n_x, x_bytes) = (side.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first() for side in sides)
    n_pairs, cores = pairs.count(), queries.sparkSession.sparkContext.defaultParallelism
    # Tasks enough for all cores, when few of the pairs of bands have a pair of blocks.
    tasks = min(TASKS * cores * n_q * n_x / max(1, n_pairs), 16 * TASKS * cores)
    q_bands = max(1, min(n_q, max(-(-q_bytes // HELD_BYTES), round((tasks * q_bytes / max(1, x_bytes)) ** 0.5))))
    x_bands = max(1, min(n_x, max(-(-x_bytes // SENT_BYTES), round(tasks / q_bands))))
    q_side, x_side = _banded(sides[0], "q", "qb", q_bands, q_bytes), _banded(sides[1], "x", "xb", x_bands, x_bytes)
    placed = stored(pairs.join(F.broadcast(q_side), "q").join(F.broadcast(x_side), "x").select(
        "q", "x", (F.col("qb") * x_bands + F.col("xb")).alias("task")), "placed")
    left = queries.join(F.broadcast(placed.select("q", "task").distinct()), "q")
    partners = placed.groupBy("x", "task").agg(F.collect_list("q").alias("partners"))
    partners = F.broadcast(partners) if 8 * n_pairs <= BROADCAST_BYTES else partners
    both = left.unionByName(index.join(partners, "x"), allowMissingColumns=True)
    names = both.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, current = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(at)[i].as_py() for at, c in enumerate(names)}
                if row["task"] != number:
                    if current is not None:
                        yield from current.finish()
                    number, current = row["task"], work()
                if row["x"] is None:
                    current.hold(row)
                else:
                    yield from current.add(row)
        if current is not None:
            yield from current.finish()

    dealt = both.repartitionById(q_bands * x_bands, F.col("task")).sortWithinPartitions("task", F.col("x").asc_nulls_first())
    return dealt.mapInArrow(task, schema)


def _floors(k: int, threshold: float | None):
    """Query block and its first matches -> the k-th best score of each query."""
    least = -np.inf if threshold is None else threshold
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q = left.to_pylist()[0]
        ids = np.frombuffer(q["ids"], "<i8")
        best = np.full((len(ids), k), -np.inf)
        order = np.argsort(ids, kind="stable")
        found, score = right.column("query_id").to_numpy(), right.column("score").to_numpy()
        by = np.lexsort((-score, found))
        found, score = found[by], score[by]
        place = np.arange(len(found)) - np.searchsorted(found, found)
        # Ids that come twice in a block share their scores; the k-th best is then too high.
        unique = len(np.unique(ids)) == len(ids)
        at, use = np.searchsorted(ids[order], found), (place < k) & unique
        best[order[at[use]], place[use]] = score[use]
        floors = np.maximum(best[:, -1], least)
        return pa.Table.from_pydict({"q": [q["q"]], "floors": [floors.tobytes()], "floor": [float(floors.min())]},
                                    schema=pa.schema([("q", pa.int64()), ("floors", pa.binary()), ("floor", pa.float64())]))
    return run


def block_pairs(queries: DataFrame, index: DataFrame, k: int, threshold: float | None, skip_same_id: bool):
    """``queries`` with their floors, the pairs scored first with their matches, and the pairs
    that remain."""
    summary = ["block", "dim", "centre", "radius"]
    near = _tiled(queries.select(*summary), index.select(*summary), _nearest, _NEAR)
    first = stored(near.groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("angle", "x"))), 1, SEEDS).alias("x"))
                   .select("q", F.explode("x.x").alias("x")), "first-pairs")
    none = F.lit(None).cast("binary")
    seeds = stored(_of_pairs(first, queries.withColumn("floors", none), index, k, threshold, skip_same_id), "first-matches")
    by_q = queries.select(F.col("block").alias("q"), "ids")
    floors = by_q.groupBy("q").cogroup(seeds.groupBy("q")).applyInArrow(_floors(k, threshold), "q bigint, floors binary, floor double")
    known = stored(queries.join(floors.withColumnRenamed("q", "block"), "block"), "query-blocks")
    reaching = _tiled(known.select(*summary, "floor"), index.select(*summary), _reaching, "q bigint, x bigint")
    left = stored(reaching.join(first, ["q", "x"], "left_anti"), "pairs")
    return known, first, seeds, left


def _least_bytes(total: int, block_bytes: int) -> int:
    """Small blocks grow with the side, so that pairs of blocks, a narrow row each, stay bounded."""
    return max(block_bytes, min(BLOCK_BYTES, total // BLOCKS))


def topk_blocks(q: DataFrame, x: DataFrame, k: int, threshold: float | None, skip_same_id: bool,
                block_bytes: int = BLOCK_BYTES, pivots: int = PIVOTS) -> DataFrame:
    """Candidates ``query_id, id, score`` of ``q(query_id, v)`` against ``x(id, v)``: each query's
    k best are among them, with at most k rows of each pair of blocks."""
    x = stored(x, "index")      # read for its size, the pivots and the blocks: made once
    n, longest = x.agg(F.count("*"), F.max(F.array_size("v"))).first()
    block_bytes = _least_bytes(n * 8 * (longest or 0), block_bytes)
    cells = max(1, min(pivots, -(-n * 8 * (longest or 0) // block_bytes)))
    marks = _pivots(x, cells)
    queries = blocks_of(q.withColumnRenamed("query_id", "id"), marks, block_bytes)
    index = blocks_of(x, marks, block_bytes)
    known, _, seeds, left = block_pairs(queries, index, k, threshold, skip_same_id)
    return seeds.unionByName(_of_pairs(left, known, index, k, threshold, skip_same_id)).drop("q")


def probed_blocks(q: DataFrame, x: DataFrame, k: int, threshold: float | None, skip_same_id: bool,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """As ``topk_blocks``, where each of ``q(query_id, v, cells)`` meets only its cells of ``x(id, v, cell)``."""
    n, longest = x.agg(F.count("*"), F.max(F.array_size("v"))).first()
    block_bytes = _least_bytes(n * 8 * (longest or 0), block_bytes)
    asked = q.select(F.col("query_id").alias("id"), "v", F.explode("cells").alias("cell"))
    queries = blocks_of(asked, None, block_bytes).withColumn("floors", F.lit(None).cast("binary"))
    index = blocks_of(x.filter(F.col("cell").isNotNull()).select("id", "v", F.col("cell").cast("int").alias("cell")), None, block_bytes)
    pairs = stored(queries.select(F.col("block").alias("q"), "cell").join(
        index.select(F.col("block").alias("x"), "cell"), "cell").select("q", "x"), "pairs")
    return _of_pairs(pairs, queries, index, k, threshold, skip_same_id).drop("q")
