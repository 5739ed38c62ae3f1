import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from pagemill.operators import joins, keyword, search
from pagemill.operators.embedding import embed, hashed_words, weights
from pagemill.sources import layout
from pagemill.operators.vector_index import index_gaps, index_stats, index_upsert, model_guard

DIM = 8


def vectors(spark, matrix, name="id"):
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} bigint, embedding array<float>")


def brute(queries, index, k, threshold=None, skip=False):
    out = []
    norm = lambda v: math.sqrt(sum(float(np.float32(x)) ** 2 for x in v))
    for q, a in enumerate(queries):
        found = []
        for i, b in enumerate(index):
            if a is None or b is None or len(a) != len(b) or (skip and q == i) or not norm(a) * norm(b):
                continue
            dot = sum(float(np.float32(x)) * float(np.float32(y)) for x, y in zip(a, b))
            score = round(dot / (norm(a) * norm(b)), 6)
            if threshold is None or score >= threshold:
                found.append((-score, i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return out


def rows(df):
    return sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in df.collect())


def same(got, expected):
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in expected], abs=2e-6)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(search, "CELL_TILE", 2)


@pytest.fixture(scope="module")
def data():
    rnd = np.random.default_rng(3)
    index = [list(v) for v in rnd.integers(-3, 4, (150, DIM)).astype(float)]
    # A third of the index are copies of one vector.
    index += [[1.0, 2.0, 0, 0, 0, 0, 0, 1.0]] * 75
    index += [None, [0.0] * DIM, [1.0, 2.0]]
    queries = [list(v) for v in rnd.integers(-3, 4, (20, DIM)).astype(float)]
    queries += [[1.0, 2.0, 0, 0, 0, 0, 0, 1.0], None, [0.0] * DIM, [2.0, 4.0]]
    return queries, index


@pytest.mark.parametrize("options", [{}, {"batch_bytes": 400}])
@pytest.mark.parametrize("threshold", [None, 0.7])
def test_topk_is_exact(spark, data, small_blocks, options, threshold):
    queries, index = data
    got = search.topk(vectors(spark, queries, "query_id"), vectors(spark, index).repartition(5), 6, threshold, **options)
    same(rows(got), brute(queries, index, 6, threshold))


def test_known_answer(spark):
    index = vectors(spark, [[1, 0], [0, 1], [1, 1]])
    got = search.topk(vectors(spark, [[2, 1.9]], "query_id"), index, 1)
    assert [r[:3] for r in rows(got)] == [(0, 1, 2)]


def test_no_queries_no_index(spark, data):
    queries, index = data
    empty = vectors(spark, [])
    assert search.topk(empty.withColumnRenamed("id", "query_id"), vectors(spark, index), 3).count() == 0
    for options in ({}, {"batch_bytes": 400}):
        assert search.topk(vectors(spark, queries, "query_id"), empty, 3, **options).count() == 0


def test_any_length_of_vector(spark):
    long = vectors(spark, [[1.0] * 5000, [1.0, 0.0]])
    for options in ({}, {"batch_bytes": 50_000}):
        got = rows(search.topk(long.withColumnRenamed("id", "query_id"), long, 1, **options))
        assert [r[:3] for r in got] == [(0, 1, 0), (1, 1, 1)]


def centers(index):
    return np.array([v for v in index if v and len(v) == DIM][:5])


@pytest.mark.parametrize("options", [{}, {"batch_bytes": 400}])
def test_all_cells_equal_exact(spark, data, small_blocks, options):
    queries, index = data
    usable = lambda vs: [v if v and len(v) == DIM and any(v) else None for v in vs]
    queries, index = usable(queries), usable(index)
    cells = centers(index)
    indexed = search.assign_cells(vectors(spark, index), cells)
    got = search.topk_approx(vectors(spark, queries, "query_id"), indexed, cells, 6, len(cells), **options)
    same(rows(got), brute(queries, index, 6))
    # Fewer cells: the same answer on both paths, and only part of the matches.
    few = [rows(search.topk_approx(vectors(spark, queries, "query_id"), indexed, cells, 6, 2, **o))
           for o in ({}, {"batch_bytes": 400})]
    assert few[0] == few[1]


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_words_of_any_script_are_found(spark, options):
    words = ["ΟΔΟΣ", "İstanbul", "STRASSE", "ſ", "Ǆ", "京都"]
    docs = spark.createDataFrame([(i, f"x {w} y") for i, w in enumerate(words)], "doc_id bigint, text string")
    queries = spark.createDataFrame(list(enumerate(words)), "query_id bigint, text string")
    got = {(r["query_id"], r["id"]) for r in keyword.keyword_search(queries, docs, 1, **options).collect()}
    assert got == {(i, i) for i in range(len(words))}


def test_recall_rises_with_probes(spark):
    index = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    queries = index.withColumnRenamed("id", "query_id")
    cells = search.fit_cells(index, 8)
    indexed = search.assign_cells(index, cells).cache()
    exact = set(r[:3:2] for r in rows(search.topk(queries, index, 10)))
    recall = []
    for probes in (1, 3, 8):
        found = rows(search.topk_approx(queries, indexed, cells, 10, probes))
        recall.append(len({r[:3:2] for r in found} & exact) / len(exact))
    assert recall[0] < recall[1] < recall[2] == 1.0


def test_cells_on_disk_are_pruned(spark, data, tmp_path):
    _, index = data
    cells = centers(index)
    indexed = search.write_cells(search.assign_cells(vectors(spark, index), cells), str(tmp_path / "cells"))
    one = search.topk_approx(vectors(spark, [index[0]], "query_id"), indexed, cells, 3, 1)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan
    assert one.count() == 3


def test_metadata_may_be_missing(spark, data, monkeypatch):
    docs = spark.createDataFrame([(0, "u0", "c0", "t0")], "id bigint, url string, content string, title string")
    matches = spark.createDataFrame([(5, 1, 0, 0.9), (5, 2, 1, 0.8)], "query_id bigint, rank bigint, id bigint, score double")
    for limit in (10, 0):
        monkeypatch.setattr(layout.checked_broadcast, "__defaults__", (limit,))
        got = [(r["rank"], r["url"]) for r in search.with_metadata(matches, docs).orderBy("rank").collect()]
        assert got == [(1, "u0"), (2, None)]


def bm25(queries, docs, k):
    words = lambda t: regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
    bags = [Counter(words(d)) for d in docs]
    lengths = [sum(b.values()) for b in bags]
    mean = sum(lengths) / len(docs)
    out = []
    for q, text in enumerate(queries):
        found = []
        for i, bag in enumerate(bags):
            terms = [(t, n) for t, n in Counter(words(text)).items() if t in bag]
            if terms:
                idf = lambda t: math.log(1 + (len(docs) - sum(t in b for b in bags) + .5) / (sum(t in b for b in bags) + .5))
                s = sum(n * idf(t) * bag[t] * 2.2 / (bag[t] + 1.2 * (.25 + .75 * lengths[i] / mean)) for t, n in terms)
                found.append((-round(s, 6), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_keyword_search(spark, options, monkeypatch):
    monkeypatch.setattr(keyword, "TILE_CELLS", 50)
    monkeypatch.setattr(keyword, "DOC_BLOCK", 30)
    monkeypatch.setattr(keyword, "TERM_BLOCK", 10)
    rnd = random.Random(5)
    vocabulary = ["the"] * 30 + [f"Wört{i}" for i in range(40)]
    docs = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 30))) for _ in range(90)] + ["", "…", None]
    docs += ["the copy"] * 45
    queries = [" ".join(rnd.choice(vocabulary) for _ in range(6)) for _ in range(8)] + ["the the", "absent", ""]
    q = spark.createDataFrame(list(enumerate(queries)), "query_id bigint, text string")
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    same(rows(keyword.keyword_search(q, d, 5, **options)), bm25(queries, docs, 5))


def test_passages_find_their_documents(spark):
    d = "/root/testdata/sf0.01"
    passages, docs = spark.read.parquet(f"{d}/benchmark.parquet"), spark.read.parquet(f"{d}/documents.parquet")
    passages_rows, docs_rows = passages.collect(), docs.collect()
    holding = {(p["item_id"], t["doc_id"]) for t in docs_rows for p in passages_rows if p["text"] in t["text"]}
    top = {(r[0], r[2]) for r in rows(keyword.keyword_search(passages, docs, 10, query_id="item_id"))}
    assert len(holding) > 20 and len(holding & top) / len(holding) > 0.9


def test_embedding(spark):
    df = spark.createDataFrame([(0, "test sentence"), (1, ""), (2, None), (3, "Test, SENTENCE!")], "id int, text string")
    got = {r["id"]: r["embedding"] for r in embed(df, "text", model=hashed_words(32)).collect()}
    assert all(len(v) == 32 for v in got.values())
    assert got[0] == got[3] and abs(sum(x * x for x in got[0]) - 1) < 1e-6
    assert not any(got[1]) and not any(got[2])
    assert weights(embed(df, "text"), "id").filter("id in (1, 2)").count() == 0


def test_embedding_model_is_set_up_per_task(spark):
    def setup():
        def lengths(texts: pa.Array):
            return np.array([[len(t or "")] * 3 for t in texts.to_pylist()], dtype=float)
        return lengths

    df = spark.createDataFrame([("abc",), ("",)], "text string")
    got = sorted(tuple(r["embedding"]) for r in embed(df, "text", model=setup).collect())
    assert got == [(0.0,) * 3, (3.0,) * 3]


def test_index_state(spark, data):
    index = vectors(spark, data[1])
    stats = index_stats(index).first()
    assert (stats["n_rows"], stats["n_null"], stats["n_zero"], stats["min_dim"], stats["max_dim"]) == (228, 1, 1, 2, DIM)
    guard = model_guard(index.withColumn("model", F.lit("m")), "m", DIM).collect()
    assert sum(r["n_rows"] for r in guard if r["usable"]) == 226
    gaps = index_gaps(spark.range(2, 230).union(spark.range(5, 7)), index).collect()
    assert sorted((r["id"], r["gap"]) for r in gaps) == [
        (0, "no chunk"), (1, "no chunk"), (228, "no vector"), (229, "no vector")]


def test_upsert(spark):
    index = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    updates = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "id bigint, v string, version int")
    merged = index_upsert(index, updates, version="version")
    assert sorted(map(tuple, merged.collect())) == [(1, "a"), (2, "y"), (3, "z")]
    again = index_upsert(merged, updates, version="version")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_skew_join(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        plain = left.join(right, "k", how).select("id", "k", "v")
        hot = joins.skew_join(left, right, "k", "id", how, hot_rows=100, salts=8)
        assert sorted(map(tuple, hot.select("id", "k", "v").na.fill(-1).collect())) == sorted(
            map(tuple, plain.na.fill(-1).collect()))


@pytest.mark.parametrize("batch_bytes", [1 << 20, 64])
def test_vectors_of_queries_are_made_once(spark, tmp_path, batch_bytes):
    seen = f"{tmp_path}/seen"

    def counting():
        from pagemill.operators.kernels import HashedWords
        run = HashedWords(16)

        def vectors(texts):
            with open(seen, "a") as out:
                out.write("x" * len(texts))
            return run(texts)
        return vectors

    texts = lambda n: spark.range(n).select("id", F.concat(F.lit("word"), F.col("id").cast("string")).alias("text"))
    index = embed(texts(30), "text").select("id", F.slice("embedding", 1, 16).alias("embedding"))
    queries = embed(texts(20), "text", model=counting).withColumnRenamed("id", "query_id")
    assert search.topk(queries, index, 2, batch_bytes=batch_bytes).count() == 40
    assert len(open(seen).read()) == 20
