import hashlib

import pytest
from pyspark.sql import functions as F

from pagemill.llm.fingerprint_queries import with_next
from pagemill.llm.fingerprints import containment, likeness, merged, sketch, written
from tests.llm.conftest import prose


def test_next_in_ascending_order(spark):
    ids = [5, 900, 7, 7, None, 10**12, 2, None, 3]
    df = spark.createDataFrame([(i, f"t{n}") for n, i in enumerate(ids)], "doc_id bigint, text string")
    rows = with_next(df).collect()
    assert len(rows) == len(ids)
    follow = {r["text"]: r["next_text"] for r in rows}
    order, at = [], "t6"
    for _ in ids:
        order.append(ids[int(at[1:])])
        at = follow[at]
    assert at == "t6" and order == [2, 3, 5, 7, 7, 900, 10**12, None, None]


def test_edited_texts(spark):
    from pagemill.llm.registry import QUERIES
    d = "/root/testdata/sf0.001"
    docs = sorted(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in QUERIES["op7_document_fingerprints"](spark, d).collect()}
    shingles = lambda t: (lambda w: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))})(t.split())
    off, same = [], {}
    for (id, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        n = len(text) // 4
        edited = text[:len(text) - n] + after[:n]
        r = got[id]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingles(text), shingles(edited)
        off.append(abs(r["near_edited"] - len(a & b) / min(len(a), len(b))))
        assert 0 <= r["near_next"] <= 1
        assert same.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert len(off) == len(got) and sum(off) / len(off) < 0.06
    assert len(set(same.values())) == len(same)


def _one(spark, column, *texts):
    names = [f"t{i}" for i in range(len(texts))]
    df = spark.createDataFrame([texts], ", ".join(f"{n} string" for n in names))
    return df.select(column(*[sketch(F.col(n)) for n in names])).first()[0]


def test_short_texts_are_exact(spark):
    a, b = "a b c d e f g h i j", "a b c d e f g h x y"
    assert _one(spark, likeness, a, b) == pytest.approx(4 / 6)
    assert _one(spark, likeness, "a b", "a b") == 1 and _one(spark, likeness, "a b", "a c") == 0
    assert _one(spark, likeness, "", " \n") == 1 and _one(spark, likeness, "", "a") == 0


def test_part_in_a_very_long_text(spark):
    part, rest = prose(1, 2000), prose(2, 40_000)
    assert _one(spark, containment, part, rest + " " + part) > 0.97
    assert _one(spark, containment, part, rest) < 0.03
    assert _one(spark, containment, prose(3, 20), rest) == 0


def test_a_short_text_in_a_long_one_is_found_or_not_known(spark):
    """Eight words of a long text: 1, or null where none of its hashes is in the kept range."""
    words = prose(8, 3_000).split()
    parts = [" ".join(words[i:i + 8]) for i in range(0, 2_000, 50)]
    df = spark.createDataFrame([(p, " ".join(words)) for p in parts], "a string, b string")
    for compare in (containment, likeness):
        found = [r[0] for r in df.select(compare(sketch(F.col("a")), sketch(F.col("b")))).collect()]
        assert set(found) == {1.0, None} and found.count(None) < len(found) / 2
    strange = spark.createDataFrame([(prose(9_000 + i, 8), " ".join(words)) for i in range(40)], "a string, b string")
    assert {r[0] for r in strange.select(likeness(sketch(F.col("a")), sketch(F.col("b")))).collect()} == {0.0, None}


def test_merged_sketches(spark):
    a, b = prose(4, 3000), prose(5, 3000)
    both = _one(spark, lambda x, y: merged(x, y), a, b)
    whole = _one(spark, lambda x: x, a + "\n" + b)
    assert len(set(whole) ^ set(both)) <= 4  # the runs across the seam


def test_odd_rows(docs, empty, plain):
    assert with_next(docs).select(written("sketch")).count() == len(plain)
    assert with_next(empty).collect() == []
