"""Exact block search: results of the full search, with most pairs of blocks skipped."""

import numpy as np
import pytest

from pagemill.operators import bounded_search, search
from pagemill.operators.bounded_search import block_pairs, blocks_of, topk_blocks

DIM = 16


def table(spark, ids, vectors, name="id"):
    return spark.createDataFrame([(int(i), None if v is None else [float(x) for x in v]) for i, v in zip(ids, vectors)],
                                 f"{name} bigint, v array<double>")


@pytest.fixture(scope="module")
def clustered(spark):
    """Twelve tight clusters; a third of all rows are one vector."""
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(12, DIM))
    index = np.concatenate([m + rng.normal(size=(150, DIM)) * 0.02 for m in middles])
    index = np.concatenate([index, np.repeat(index[:1], 900, axis=0)])
    queries = np.concatenate([m + rng.normal(size=(10, DIM)) * 0.02 for m in middles])
    return queries, index, table(spark, range(len(queries)), queries, "query_id").cache(), table(spark, range(len(index)), index).repartition(6).cache()


def full(queries, index, k, threshold=None, skip_same_id=False):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit(queries) @ unit(index).T, 6)
    out = set()
    for q, row in enumerate(scores):
        order = [i for i in np.lexsort((np.arange(len(row)), -row)) if not (skip_same_id and i == q)]
        out |= {(q, r + 1, int(i), round(float(row[i]), 6)) for r, i in enumerate(order[:k]) if threshold is None or row[i] >= threshold}
    return out


def found(df):
    return {(r["query_id"], r["rank"], r["id"], round(r["score"], 6)) for r in df.collect()}


def close(a, b):
    a, b = sorted(a), sorted(b)
    assert [x[:2] for x in a] == [x[:2] for x in b]
    assert all(abs(x[3] - y[3]) < 2e-6 for x, y in zip(a, b))
    assert sum(x[2] != y[2] for x, y in zip(a, b)) <= len(a) // 100  # scores that differ in the last digit


@pytest.mark.parametrize("k, threshold, skip", [(1, None, False), (20, None, True), (1_000, 0.99, False)])
def test_equal_to_the_full_search(clustered, k, threshold, skip):
    queries, index, q, x = clustered
    got = search._rank(topk_blocks(q, x, k, threshold, skip, block_bytes=50 * DIM * 8), k)
    close(found(got), full(queries, index, k, threshold, skip))


def test_most_pairs_of_blocks_are_skipped(clustered):
    queries, index, q, x = clustered
    size = 50 * DIM * 8
    marks = bounded_search._pivots(x, 40)
    left, right = blocks_of(q.withColumnRenamed("query_id", "id"), marks, size), blocks_of(x, marks, size)
    n, m = left.count(), right.count()
    known, first, seeds, pairs = block_pairs(left, right, 5, None, False)
    assert right.agg({"n": "max"}).first()[0] <= 100 and right.agg({"n": "sum"}).first()[0] == len(index)
    assert m >= 54 and known.count() == n
    assert first.count() <= bounded_search.SEEDS * n
    # A query's cluster is a twelfth of the blocks, or the copies.
    assert first.count() + pairs.count() < n * m / 3


def test_a_third_of_the_rows_in_blocks_of_bounded_size(spark):
    vectors = [[1.0, 2.0, 3.0]] * 2_000
    blocks = blocks_of(table(spark, [7] * 2_000, vectors), {3: np.array([[1.0, 0, 0]])}, 100 * 24)
    sizes = [r["n"] for r in blocks.select("n").collect()]
    assert sum(sizes) == 2_000 and max(sizes) < 200 and len(sizes) > 12
    assert max(r["radius"] for r in blocks.select("radius").collect()) < 1e-6


def test_odd_vectors(spark):
    vectors = [None, [], [0.0] * 3, [float("nan"), 1, 1], [1, 0, 0], [1.0, 0.0], [0, 1, 0], [-1, 0, 0], [2, 0, 0]]
    x = table(spark, range(9), vectors)
    q = x.withColumnRenamed("id", "query_id")
    got = found(search._rank(topk_blocks(q, x, 3, None, True, block_bytes=48), 3))
    assert got == {(4, 1, 8, 1.0), (4, 2, 6, 0.0), (4, 3, 7, -1.0), (6, 1, 4, 0.0), (6, 2, 7, 0.0), (6, 3, 8, 0.0),
                   (7, 1, 6, 0.0), (7, 2, 4, -1.0), (7, 3, 8, -1.0), (8, 1, 4, 1.0), (8, 2, 6, 0.0), (8, 3, 7, -1.0)}


def test_ids_that_come_twice(spark):
    x = table(spark, [1, 1, 2, 3], [[1, 0], [0, 1], [1, 1], [1, 0.1]])
    q = table(spark, [5, 5], [[1, 0], [0, 1]], "query_id")
    small = search._rank(topk_blocks(q, x, 2, None, False, block_bytes=16), 2)
    usual = search.topk(q.withColumnRenamed("v", "embedding"), x.withColumnRenamed("v", "embedding"), 2)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, usual.collect()))


def test_no_driver_loop_over_queries(clustered, monkeypatch):
    queries, index, q, x = clustered
    taken = []
    from pyspark.sql.classic.dataframe import DataFrame
    original = DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: taken.append(self.columns) or original(self))
    search.topk(q.withColumnRenamed("v", "embedding"), x.withColumnRenamed("v", "embedding"), 3, batch_bytes=10_000).count()
    assert all("query_id" not in columns for columns in taken)


class Received:
    """Counts the blocks that a task gets."""

    def __init__(self):
        self.blocks = self.pairs = 0

    def hold(self, row):
        self.blocks += 1

    def add(self, row):
        self.blocks, self.pairs = self.blocks + 1, self.pairs + len(row["partners"])
        return ()

    def finish(self):
        import pyarrow as pa
        yield pa.RecordBatch.from_pydict({"blocks": [self.blocks], "pairs": [self.pairs]})


def test_a_block_is_sent_once_per_band_and_not_once_per_pair(spark):
    side = lambda name: spark.range(30).selectExpr(f"id AS {name}", "0 AS cell", "cast(repeat('x', 800) AS binary) AS matrix")
    q, x = side("q"), side("x")
    got = bounded_search.in_bands(q.select("q").crossJoin(x.select("x")), q, x, Received, "blocks bigint, pairs bigint").collect()
    assert sum(r["pairs"] for r in got) == 900
    assert sum(r["blocks"] for r in got) < 900 / 2      # by pairs, 1,800 were sent


def test_equal_to_double_precision(spark):
    """Scores that single precision cannot tell apart, copies, and ids that come twice."""
    from pagemill.operators.kernels import BestMatches, add_cosines, fewest_copies
    rng = np.random.default_rng(8)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    index = unit(np.concatenate([np.ones((1_500, DIM)) + rng.normal(size=(1_500, DIM)) * 2e-3, np.repeat(np.eye(DIM)[:2], 700, axis=0)]))
    queries, ids, asked = unit(np.ones((9, DIM)) + rng.normal(size=(9, DIM)) * 0.02), rng.integers(0, 900, len(index)), np.arange(9)
    scores = queries @ index.T
    scores[asked[:, None] == ids[None, :]] = -np.inf
    want, got = BestMatches(9, 12), BestMatches(9, 12)
    want.add(scores, ids)
    add_cosines(got, asked, queries, ids, index, None, True)
    assert np.array_equal(want.scores, got.scores) and np.array_equal(want.ids, got.ids)
    kept = fewest_copies(np.array([5, 5, 5, 1, 2, 3, 9]), np.array([[1.0, 0]] * 6 + [[0, 1.0]]), 2)
    assert kept.tolist() == [3, 4, 5, 6]
