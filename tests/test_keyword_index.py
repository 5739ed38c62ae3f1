"""The stored keyword index against the scan of whole texts."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagemill.operators import keyword_index
from pagemill.operators.kernels import BestMatches
from pagemill.operators.keyword import keyword_search
from pagemill.operators.keyword_index import KeywordIndex, Segment, append_keyword_index, build_keyword_index
from pagemill.session import new_dir

WORDS = [f"w{i}" for i in range(400)]


def texts(n, seed=0):
    """Zipf words; one word in a third of all texts, copies, nulls, empty and long texts."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = rng.choices(WORDS, [1 / (k + 1) for k in range(len(WORDS))], k=rng.randint(1, 60))
        if i % 3 == 0:
            words += ["hot"] * rng.randint(1, 4)
        rows.append((i, " ".join(words)))
    return rows + [(n, None), (n + 1, ""), (n + 2, "Ünï ünï, w1-w2!"), (n + 3, rows[0][1]), (n + 4, "w3 " * 70_000), (n + 5, rows[0][1])]


def questions(n, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choices([*WORDS, "hot", "nowhere"], k=rng.randint(1, 12)))) for i in range(n)]
    return rows + [(n, "hot hot hot"), (n + 1, None), (n + 2, ""), (n + 3, "absent"), (n + 4, "ünï"), (n + 5, "w0 w1 w2 hot")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts(3_000), "doc_id bigint, text string").repartition(5).cache()


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(questions(40), "query_id bigint, text string")


@pytest.fixture(scope="module")
def index(spark, docs):
    return build_keyword_index(docs, new_dir(spark, "index"), segment_docs=512, range_rows=500)


def same(a, b):
    rows = [sorted(map(tuple, df.collect())) for df in (a, b)]
    assert len(rows[0]) == len(rows[1])
    for x, y in zip(*rows):
        assert x[:3] == y[:3] and abs(x[3] - y[3]) < 2e-6


@pytest.mark.parametrize("k", [1, 10, 5_000])
@pytest.mark.parametrize("broadcast_bytes", [32 << 20, 0])
def test_search_equals_scan(index, docs, asked, k, broadcast_bytes):
    same(index.search(asked, k, broadcast_bytes=broadcast_bytes), keyword_search(asked, docs, k))


def test_blocks_of_queries(index, docs, asked, monkeypatch):
    monkeypatch.setattr(keyword_index, "TERM_BLOCK", 40)
    same(index.search(asked, 7, broadcast_bytes=0), keyword_search(asked, docs, 7))


def test_statistics(index, docs):
    found = {r["term"]: r for r in index.statistics().collect()}
    counts = {}
    for _, text in texts(3_000):
        words = (text or "").lower().replace(",", " ").replace("-", " ").replace("!", " ").split()
        for w in set(words):
            df, hits = counts.get(w, (0, 0))
            counts[w] = df + 1, hits + words.count(w)
    assert {t: (r["df"], r["hits"]) for t, r in found.items()} == counts
    n, hits = index.totals()
    assert (n, hits) == (3_006, sum(h for _, h in counts.values()))


def test_terms_of_all_segments_lie_in_ranges(index):
    rows = index.rows.groupBy("range").agg(F.min("term").alias("first"), F.max("term").alias("last")).orderBy("range").collect()
    assert len(rows) > 2 and all(a["last"] <= b["first"] for a, b in zip(rows, rows[1:]))
    # A word opens the ranges that may hold it only; the hot word has a row in every segment.
    plan = index.with_terms(["w17"])
    assert plan.select("range").distinct().count() <= 2 < len(rows)
    assert re.search(r"PartitionFilters: \[[^\]]*range#\d+ (IN|=)", plan._jdf.queryExecution().executedPlan().toString())
    assert index.with_terms(["hot"]).count() == index.with_terms([""]).count() > 5


def _segment(docs, mean):
    made = keyword_index.Inverted()
    made.add(pa.array([i for i, _ in docs]), pa.array([t for _, t in docs]))
    return Segment(pa.Table.from_batches([made.closed(0)]), mean)


def test_blocks_are_skipped():
    """A rare word decides, so most slots of a frequent one are neither visited nor decoded."""
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choices(WORDS, k=30)) + (" hot" if i % 2 else "") + (" rare rare" if i in (700, 3000, 3001) else "")) for i in range(8_192)]
    segment = _segment(docs, 30.0)
    best = BestMatches(1, 3)
    segment.search([("hot", 0.7), ("rare", 8.0)], best, 0)
    assert sorted(best.ids[0].tolist()) == [700, 3000, 3001]
    blocks = sum(len(where) for where, *_ in segment.rows.values() if where)
    assert segment.slots == 64 and len(segment.rows["hot"][0]) == 64
    assert segment.decoded < 64 / 3 < blocks
    # All documents in the result: nothing can be skipped.
    everything = _segment(docs, 30.0)
    everything.search([("hot", 0.7), ("rare", 8.0)], BestMatches(1, 8_192), 0)
    assert everything.decoded == 64 + 2


def test_words_that_cannot_decide_are_not_looked_up():
    docs = [(i, "common " * 3 + ("strong " * 4 if i < 64 else "x")) for i in range(256)]
    segment = _segment(docs, 4.0)
    best = BestMatches(1, 2)
    segment.search([("common", 0.01), ("strong", 5.0)], best, 0)
    assert ("common", 0) in segment.kept and ("common", 1) not in segment.kept


@pytest.mark.parametrize("seed", range(5))
def test_slots_bound_what_is_in_them(seed):
    docs = [(i, t or "") for i, t in texts(900, seed)]
    segment = _segment(docs, 25.0)
    for term in segment.rows:
        for slot in segment.rows[term][0]:
            _, share = segment.block(term, slot)
            assert abs(segment.bounds[term][slot] - share.max()) < 1e-12


def test_batches_are_added_and_replaced(spark, docs, asked):
    path = new_dir(spark, "index")
    first, second = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    append_keyword_index(first, path, 0)
    append_keyword_index(first, path, 1)
    append_keyword_index(second, path, 1)
    same(KeywordIndex(spark, path).search(asked, 10), keyword_search(asked, docs, 10))


def test_nothing_to_find(spark, docs, asked):
    empty = build_keyword_index(docs.limit(0), new_dir(spark, "index"))
    assert empty.search(asked).collect() == [] and empty.totals() == (0, 0) and empty.statistics().collect() == []
    wordless = build_keyword_index(docs.select("doc_id", F.lit("?!").alias("text")), new_dir(spark, "index"))
    assert wordless.search(asked).collect() == [] and wordless.totals() == (3_006, 0)
    some = build_keyword_index(docs.withColumn("doc_id", F.when(F.col("doc_id") < 100, F.col("doc_id"))), new_dir(spark, "index"))
    assert some.totals()[0] == 100
    assert some.search(asked.limit(0)).collect() == []


def test_texts_are_cut_into_words_in_pieces_of_bounded_bytes(monkeypatch):
    """A batch of long texts is worked on in pieces, and every text is in one."""
    from pagemill.operators import kernels
    monkeypatch.setattr(kernels, "PIECE_BYTES", 1_000)
    texts = pa.array(["x" * 300] * 10 + [None, "", "y" * 5_000, "z"])
    got = kernels.pieces(texts)
    assert [lo for lo, _ in got] == [0, *(sum(n for _, n in got[:i + 1]) for i in range(len(got) - 1))]
    assert sum(n for _, n in got) == len(texts)
    size = lambda lo, n: sum(len(t or "") for t in texts.slice(lo, n).to_pylist())
    assert all(size(lo, n) <= 1_000 or n == 1 for lo, n in got)
    assert max(n for _, n in kernels.pieces(texts, 2)) <= 2
    assert kernels.pieces(texts[:0]) == []
