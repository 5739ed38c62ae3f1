"""Quantized search: exact at full depth, and its recall at a stated share of re-ranked vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.operators import search
from pagemill.operators.product_quantizer import Quantizer, _book, coded_blocks, fit_quantizer, topk_quantized

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def given(spark):
    index = spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding").cache()
    cells = search.fit_cells(index, 16)
    quantizer = fit_quantizer(index, cells)
    indexed = search.assign_cells(index, cells)
    queries = index.filter("id % 10 = 0").withColumnRenamed("id", "query_id").cache()
    return index, quantizer, coded_blocks(indexed, quantizer, block_bytes=1 << 17).cache(), queries


def rows(df):
    return {(r["query_id"], r["id"]): round(r["score"], 5) for r in df.collect()}


def test_full_depth_is_exact(given):
    index, quantizer, blocks, queries = given
    want = rows(search.topk(queries, index, 10, skip_same_id=True))
    assert rows(topk_quantized(queries, blocks, quantizer, 10, depth=index.count(), skip_same_id=True)) == want


def test_recall_with_a_twentieth_of_the_vectors_scored(given):
    """The vectors have almost no cluster structure; cells alone would need nearly all vectors."""
    index, quantizer, blocks, queries = given
    depth = index.count() // 20
    want = rows(search.topk(queries, index, 10, skip_same_id=True))
    got = rows(topk_quantized(queries, blocks, quantizer, 10, depth=depth, skip_same_id=True))
    assert len(got) == len(want)
    assert all(want[key] == score for key, score in got.items() if key in want), "scores are exact ones"
    assert len(got.keys() & want.keys()) / len(want) >= 0.9


def test_codes_are_bytes_near_their_vectors(given):
    index, quantizer, blocks, _ = given
    for r in blocks.collect():
        matrix = np.frombuffer(r["matrix"], np.float64).reshape(r["n"], -1)
        codes = np.frombuffer(r["codes"], np.uint8).reshape(r["n"], -1)
        assert codes.shape == (r["n"], 16)
        error = np.linalg.norm(matrix - quantizer.decoded(codes, r["cell"]), axis=1)
        assert error.mean() < 0.6
        near = quantizer.scores(matrix[:5], quantizer.tables(matrix[:5]), codes, r["cell"])
        assert np.allclose(near, matrix[:5] @ quantizer.decoded(codes, r["cell"]).T)
    assert blocks.agg(F.sum("n")).first()[0] == index.count()


def test_thresholds_cells_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    vectors = [v.tolist() for v in rng.normal(size=(300, 4))] + [[1.0, 0.0, 0.0, 0.0]] * 100 + [None, [0.0] * 4, [1.0], [float("nan")] * 4]
    index = spark.createDataFrame(list(enumerate(vectors)), "id bigint, embedding array<double>")
    cells = np.eye(4)
    quantizer = fit_quantizer(index, cells, parts=2, entries=16)
    blocks = coded_blocks(search.assign_cells(index, cells), quantizer, block_bytes=50 * 32)
    assert blocks.agg(F.sum("n"), F.max("n")).first()[0] == 400
    queries = index.withColumnRenamed("id", "query_id")
    for threshold in (None, 0.95):
        want = rows(search.topk(queries.filter("query_id < 420"), index.filter("id < 400"), 3, threshold))
        assert rows(topk_quantized(queries, blocks, quantizer, 3, depth=1_000, threshold=threshold)).keys() == want.keys()
    one = rows(topk_quantized(queries, blocks, quantizer, 3, depth=40, probes=1))
    assert one and len(one) <= 3 * 400
    assert topk_quantized(queries.limit(0), blocks, quantizer, 3, depth=40).collect() == []
    empty = coded_blocks(search.assign_cells(index.limit(0), cells), fit_quantizer(index.limit(0), cells, 2, 16))
    assert topk_quantized(queries, empty, quantizer, 3).collect() == []
    with pytest.raises(ValueError, match="divide"):
        fit_quantizer(index, cells, parts=3)


def test_book_of_few_rows():
    book = _book(np.array([[1.0, 2.0], [3.0, 4.0]]), 8, np.random.default_rng(0))
    assert book.shape == (8, 2) and {tuple(r) for r in book} == {(1.0, 2.0), (3.0, 4.0)}
    assert Quantizer(np.eye(2), np.zeros((1, 4, 2))).codes(np.zeros((0, 2)), 0).shape == (0, 1)
